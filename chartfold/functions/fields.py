"""Column helpers for nested clinical resources.

All of them return NULL, rather than raise, on absent parents, empty arrays
and malformed references, also under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first(array: Column | str) -> Column:
    """First element, NULL for a NULL or empty array."""
    return F.get(_col(array), F.lit(0))


def first_coding(concept: Column | str) -> Column:
    """First coding of a codeable concept (a struct with a `coding` array)."""
    return first(_col(concept)["coding"])


def first_code(concept: Column | str) -> Column:
    return first_coding(concept)["code"]


def first_display(concept: Column | str) -> Column:
    return first_coding(concept)["display"]


def ref_id(reference: Column | str, absolute: bool = False) -> Column:
    """Id inside a `Type/id` reference.

    By default this is the second `/`-part; NULL when there is none. With
    `absolute=True` it is the last part, which also serves full URLs.
    """
    parts = F.split(_col(reference), "/")
    return F.element_at(parts, -1) if absolute else F.get(parts, F.lit(1))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """`part / whole` in percent, 0 for an empty whole."""
    ratio = F.try_divide(part * F.lit(100.0).cast("double"), whole)
    return F.round(F.coalesce(ratio, F.lit(0.0)), digits)
