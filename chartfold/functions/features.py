"""Per-patient features."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartfold.functions.fields import _col


def strict_date(text: Column | str) -> Column:
    """Parse a full year-month-day date; partial dates and other text give NULL."""
    return F.try_to_date(_col(text), "yyyy-M-d")


def age_years(
    birth_date: Column | str, as_of: Column | datetime.date | str | None = None
) -> Column:
    """Completed years on `as_of` (default: the current date).

    A person born on Feb 29 has their birthday on Mar 1 in other years, so
    this compares month and day; a month difference would be wrong there.
    """
    if as_of is None:
        day = F.current_date()
    elif isinstance(as_of, Column):
        day = as_of
    else:
        day = F.lit(str(as_of)).cast("date")
    born = strict_date(birth_date)
    early = F.month(day) * 100 + F.day(day) < F.month(born) * 100 + F.day(born)
    return F.year(day) - F.year(born) - early.cast("int")


def has_condition(conditions: Column | str, name: str) -> Column:
    """1 if a list of condition structs has one with exactly this name, else 0."""
    found = F.exists(_col(conditions), lambda c: c["condition_name"].eqNullSafe(F.lit(name)))
    return F.coalesce(found, F.lit(False)).cast("int")


def clamp_unit(x: Column) -> Column:
    """Limit a probability to [0, 1]; NULL stays NULL."""
    limited = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return F.when(x.isNotNull(), limited)
