"""What types the fields of JSON records have, path by path.

Records are parsed as VARIANT, so nothing has to be pinned, and nothing that
does not fit is lost. Spark's aggregate of variant schemas tells which paths
there are; one more pass counts the types of the values on each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructType,
    VariantType,
)

# Beside the types of Spark's variants.
ABSENT, CORRUPT_LINE = "ABSENT", "CORRUPT"
# The types of values that reading with a pinned type keeps; any fits a string.
_KEPT = {
    BooleanType: {"BOOLEAN"},
    LongType: {"BIGINT"},
    DoubleType: {"BIGINT", "DECIMAL", "DOUBLE"},
    StructType: {"OBJECT"},
    ArrayType: {"ARRAY"},
}


@dataclass
class _Node:
    """A path: its fields, and its elements where it holds lists."""

    fields: dict[str, _Node] = field(default_factory=dict)
    element: _Node | None = None
    mixed: bool = False

    def add(self, seen: DataType) -> None:
        if isinstance(seen, StructType):
            for f in seen:
                self.fields.setdefault(f.name, _Node()).add(f.dataType)
        elif isinstance(seen, ArrayType):
            self.element = self.element or _Node()
            self.element.add(seen.elementType)
        elif isinstance(seen, VariantType):
            self.mixed = True


def variants(lines: DataFrame, column: str) -> DataFrame:
    """(record, line): each non-blank JSON line as a VARIANT, NULL if it is no
    JSON object."""
    # Text that parses and starts so is an object; other lines are not parsed.
    record = F.when(F.col(column).rlike(r"^[ \t\r\n]*\{"), F.try_parse_json(column))
    return lines.where(F.trim(F.col(column)) != "").select(record.alias("record"), F.col(column).alias("line"))


def path_types(lines: DataFrame, column: str, pinned: str | None = None) -> DataFrame:
    """(path, type, n, pinned, lost) of JSON lines.

    Paths are like `code.coding[].code`. `type` is that of the variant's value
    (`VOID` is JSON's null); `ABSENT` counts parents without the field, and
    lines that are no object count as `CORRUPT` on the empty path. `pinned` is
    the type that the schema `pinned` has there, and `lost` tells whether values
    of this type become NULL, or lose fields, when read with it.

    Where a path has objects in one record and lists or values in another, all
    are followed. An empty table has no paths.
    """
    records = variants(lines, column)
    parsed = records.where(F.col("record").isNotNull()).select("record")
    tree = _tree(parsed)
    known = _pinned_types(StructType.fromDDL(pinned)) if pinned else {}
    staged, kinds = _staged(records, tree)
    corrupt = F.when(F.col("bad"), F.array(F.struct(F.lit("").alias("path"), F.lit(CORRUPT_LINE).alias("type"))))
    told = [F.coalesce(corrupt, F.array().cast("array<struct<path:string,type:string>>"))]
    told += [_typed(path, kind) for path, kind in kinds.items() if path]
    counted = staged.select(F.inline(F.concat(*told))).groupBy("path", "type").agg(F.count("*").alias("n"))
    return counted.select("path", "type", "n", *_compared(known, bool(pinned)))


def _tree(parsed: DataFrame) -> _Node:
    tree = _Node()
    tree.add(_schemas(parsed, [F.col("record")])[0])
    done: set[str] = set()
    while todo := [(p, v, n) for p, v, n in _nodes(tree, "", F.array("record")) if n.mixed and p not in done]:
        # Objects and lists on one path have no common type; each kind alone has.
        for path, values, node in todo:
            done.add(path)
            there = parsed.select(F.explode(values).alias("value")).select("value", _head(F.col("value")).alias("kind"))
            kinds = [F.when(F.col("kind") == kind, F.col("value")) for kind in ("OBJECT", "ARRAY")]
            for seen in _schemas(there, kinds):
                node.add(seen)
    return tree


def _schemas(df: DataFrame, columns: list[Column]) -> list[DataType]:
    """The common type of each column's variants, from one pass; one short text
    for each reaches the driver."""
    return [_type(text or "VOID") for text in df.agg(*(F.schema_of_variant_agg(c) for c in columns)).first()]


def _type(text: str) -> DataType:
    # Names are quoted where they are unusual; what is outside quotes is type.
    parts = text.split("`")
    parts[::2] = [re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts[::2]]
    return DataType.fromDDL("`".join(parts)) if text != "VOID" else NullType()


def _head(value: Column) -> Column:
    # What stands before the fields of an object and the digits of a decimal.
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def _nodes(node: _Node, path: str, values: Column):
    yield path, values, node
    there = F.filter(values, lambda v: v.isNotNull())
    for name, child in node.fields.items():
        step = "$['" + name + "']" if "'" not in name else '$["' + name + '"]'
        # The records themselves are objects; a field of anything else is NULL.
        inner = F.transform(F.filter(there, lambda v: _head(v) == "OBJECT") if path else there, _field(step))
        yield from _nodes(child, f"{path}.{name}" if path else name, inner)
    if node.element is not None:
        empty = F.array().cast("array<variant>")
        inner = F.flatten(
            F.transform(there, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), empty))
        )
        yield from _nodes(node.element, f"{path}[]", inner)


def _staged(records: DataFrame, tree: _Node) -> tuple[DataFrame, dict[str, str]]:
    """The values on each path as columns that are computed once, level by level,
    and the column of the values' types for each path; `bad` tells lines that
    are no object."""
    empty = F.array().cast("array<variant>")
    bad = F.col("record").isNull()
    df, kinds = records.select(bad.alias("bad"), F.when(bad, empty).otherwise(F.array("record")).alias("v")), {}
    level, count = [("", "v", None, tree)], 0
    while level:
        below, made, kept = [], {}, ["bad", *kinds.values()]
        for path, values, kind, node in level:
            if node.fields:
                # The records themselves are objects.
                made[f"o{count}"] = F.col(values) if kind is None else _of_kind(values, kind, "OBJECT")
                for name, child in node.fields.items():
                    step = "$['" + name + "']" if "'" not in name else '$["' + name + '"]'
                    below.append((f"{path}.{name}" if path else name, f"o{count}", _field(step), child))
            if node.element is not None:
                made[f"a{count}"] = F.flatten(
                    F.transform(
                        _of_kind(values, kind, "ARRAY"),
                        lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), empty),
                    )
                )
                below.append((f"{path}[]", f"a{count}", None, node.element))
            count += 1
        df = df.select(*kept, *(c.alias(n) for n, c in made.items()))
        found, level = {}, []
        for path, source, step, child in below:
            found[f"v{count}"] = F.col(source) if step is None else F.transform(source, step)
            level.append((path, f"v{count}", f"k{count}", child))
            kinds[path] = f"k{count}"
            count += 1
        df = df.select(*kept, *(c.alias(n) for n, c in found.items()))
        heads = (F.transform(v, lambda x: F.coalesce(_head(x), F.lit(ABSENT))).alias(k) for _, v, k, _ in level)
        df = df.select(*kept, *found, *heads)
    return df, kinds


def _of_kind(values: str, kinds: str, kind: str) -> Column:
    return F.filter(values, lambda _, i: F.get(F.col(kinds), i) == kind)


def _field(step: str):
    return lambda v: F.try_variant_get(v, step, "variant")


def _typed(path: str, kinds: str) -> Column:
    return F.transform(kinds, lambda k: F.struct(F.lit(path).alias("path"), k.alias("type")))


def _pinned_types(schema: DataType, path: str = "") -> dict[str, DataType]:
    found = {path: schema} if path else {}
    if isinstance(schema, StructType):
        for f in schema:
            found |= _pinned_types(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(schema, ArrayType):
        found |= _pinned_types(schema.elementType, f"{path}[]")
    return found


def _compared(known: dict[str, DataType], is_pinned: bool) -> list[Column]:
    name, lost = F.lit(None).cast("string"), F.lit(is_pinned)
    for path, kind in known.items():
        here = F.col("path") == path
        name = F.when(here, F.lit(kind.typeName())).otherwise(name)
        if isinstance(kind, StringType):
            fits = F.lit(True)
        else:
            fits = F.col("type").isin(sorted(_KEPT.get(type(kind), set())))
        lost = F.when(here, ~fits).otherwise(lost)
    nothing = F.col("type").isin("VOID", ABSENT)
    return [name.alias("pinned"), (lost & ~nothing).alias("lost")]
