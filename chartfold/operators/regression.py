"""Simple linear regression of several measures on one x, in a single pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.functions.features import clamp_unit
from chartfold.functions.student import two_sided_p_sql

_MOMENTS = {
    "n": "regr_count",
    "mean_x": "regr_avgx",
    "mean_y": "regr_avgy",
    "sxx": "regr_sxx",
    "syy": "regr_syy",
    "sxy": "regr_sxy",
}


def fit_lines(
    df: DataFrame,
    x: str,
    measures: Mapping[str, str],
    by: Sequence[str] = (),
    fill_zero: bool = False,
    alpha: float = 0.05,
) -> DataFrame:
    """Fit `y = slope * x + intercept` for each measure, overall or per group.

    `measures` maps a measure's name to its y column. One aggregation computes
    the moments of every measure side by side (no row is copied per measure),
    map-side combined, so a hot group costs no more than any other.

    Pairs with a NULL are dropped, or y counts as 0 with `fill_zero`. `x_min`
    and `x_max` span all non-NULL x, also those without a y. A constant x has
    no slope; a constant y has slope 0 and no r; below 3 pairs there is no
    standard error, t or p.
    """
    xs = _name(x)
    aggs = [f"min({xs}) as x_min", f"max({xs}) as x_max"]
    rows = []
    for i, (measure, column) in enumerate(measures.items()):
        y = f"cast({_name(column)} as double)"
        pair = f"{f'coalesce({y}, 0D)' if fill_zero else y}, cast({xs} as double)"
        aggs += [f"{fn}({pair}) as {stat}_{i}" for stat, fn in _MOMENTS.items()]
        stats = ", ".join(f"'{stat}', {stat}_{i}" for stat in _MOMENTS)
        rows.append(f"named_struct('measure', {_text(measure)}, {stats})")
    wide = df.groupBy(*by).agg(*[F.expr(a) for a in aggs])
    by = [_name(c) for c in by]
    moments = wide.selectExpr(*by, "x_min", "x_max", f"inline(array({', '.join(rows)}))")
    # Each line may use the columns named before it in the same select.
    return moments.selectExpr(
        *by,
        "measure",
        "n",
        "case when sxx > 0 then sxy / sxx end as slope",
        "mean_y - slope * mean_x as intercept",
        "case when sxx > 0 and syy > 0 then least(1D, sxy * sxy / (sxx * syy)) end as r2",
        "sign(sxy) * sqrt(r2) as r",
        "case when n >= 3 then n - 2 end as df",
        "case when sxx > 0 then sqrt((1 - coalesce(r2, 0D)) * syy / sxx / df) end as stderr",
        "case when r2 < 1 then r * sqrt(df / (1 - r2)) end as t",
        f"case when r2 = 1 and df >= 1 then 0D else {two_sided_p_sql('t', 'df')} end as p",
        f"p < {alpha} as significant",
        "x_min",
        "x_max",
    ).drop("df")


def predict(fits: DataFrame, xs: Sequence[float], unit_measures: Sequence[str] = ()) -> DataFrame:
    """Predict every fitted measure at the given x values: (measure, x, predicted).

    Measures named in `unit_measures` are probabilities and limited to [0, 1].
    """
    points = F.array(*[F.lit(float(v)) for v in xs])
    value = F.col("slope") * F.col("x") + F.col("intercept")
    return _limit_unit(
        fits.withColumn("x", F.explode(points)).withColumn("predicted", value), unit_measures
    ).select(*_group_columns(fits), "measure", "x", "predicted")


def predict_rows(
    df: DataFrame, x: str, fits: DataFrame, measures: Sequence[str], unit_measures: Sequence[str] = ()
) -> DataFrame:
    """Add `measure` and `predicted` to each row of `df`, one row per measure.

    `fits` must be ungrouped. It is broadcast: it holds one row per name in
    `measures`, whatever the size of the fitted data.
    """
    wanted = fits.where(F.col("measure").isin(list(measures))).select("measure", "slope", "intercept")
    long = df.withColumn("measure", F.explode(F.array(*[F.lit(m) for m in measures])))
    joined = long.join(F.broadcast(wanted), "measure").withColumn(
        "predicted", F.col("slope") * F.col(x) + F.col("intercept")
    )
    return _limit_unit(joined, unit_measures).select(*df.columns, "measure", "predicted")


def line_points(fits: DataFrame, points: int = 100) -> DataFrame:
    """Evenly spaced points of each fitted line, from `x_min` to `x_max` inclusive."""
    x = F.col("x_min") + F.col("i") * (F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1))
    return (
        fits.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .withColumn("y", F.col("slope") * F.col("x") + F.col("intercept"))
        .select(*_group_columns(fits), "measure", "i", "x", "y")
    )


def scatter_counts(df: DataFrame, x: str, measures: Mapping[str, str]) -> DataFrame:
    """(measure, x, y, n): how many rows lie on each point, instead of the rows."""
    rows = [
        F.struct(F.lit(name).alias("measure"), F.col(c).cast("double").alias("y"))
        for name, c in measures.items()
    ]
    # Counting the distinct combinations first keeps the copy per measure small.
    distinct_points = df.groupBy(x, *dict.fromkeys(measures.values())).agg(F.count("*").alias("n"))
    long = distinct_points.select(x, "n", F.inline(F.array(*rows)))
    return (
        long.where(F.col(x).isNotNull() & F.col("y").isNotNull())
        .groupBy("measure", x, "y")
        .agg(F.sum("n").alias("n"))
        .select("measure", F.col(x).alias("x"), "y", "n")
    )


def _limit_unit(df: DataFrame, unit_measures: Sequence[str]) -> DataFrame:
    limited = F.when(F.col("measure").isin(list(unit_measures)), clamp_unit(F.col("predicted")))
    return df.withColumn("predicted", limited.otherwise(F.col("predicted"))) if unit_measures else df


def _group_columns(fits: DataFrame) -> list[str]:
    return fits.columns[: fits.columns.index("measure")]


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
