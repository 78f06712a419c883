import math

import pytest

from chartfold.functions.student import two_sided_p
from chartfold.operators.regression import fit_lines, line_points, predict, predict_rows, scatter_counts


def fit(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "x double, y double")
    return fit_lines(df, "x", {"m": "y"}, **kw).collect()[0]


def test_p_against_closed_forms(spark):
    ts = [0.0, 0.1, 1.0, 1.7, 1.74, 1.96, 3.0, 8.0, 20.0]
    df = spark.createDataFrame([(t, d) for t in ts for d in (1, 2, 4, 10**9)], "t double, df long")
    for row in df.select("t", "df", two_sided_p("t", "df").alias("p")).collect():
        t = row.t
        expected = {
            1: 1 - 2 / math.pi * math.atan(t),
            2: 1 - t / math.sqrt(2 + t * t),
            4: 1 - (t / math.sqrt(4 + t * t)) * (1 + 2 / (4 + t * t)),
            10**9: math.erfc(t / math.sqrt(2)),
        }[row.df]
        assert row.p == pytest.approx(expected, abs=1e-8), row


def test_known_line(spark):
    # Worked by hand: sxx 10, sxy 6, syy 6.
    r = fit(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 5.0), (4.0, 4.0), (5.0, 5.0)])
    assert (r.n, r.x_min, r.x_max) == (5, 1.0, 5.0)
    assert r.slope == pytest.approx(0.6)
    assert r.intercept == pytest.approx(2.2)
    assert r.r2 == pytest.approx(0.6)
    assert r.stderr == pytest.approx(math.sqrt(0.4 * 6 / 10 / 3))
    assert r.t == pytest.approx(0.6 / r.stderr)
    th = math.atan(r.t / math.sqrt(3))
    assert r.p == pytest.approx(1 - 2 / math.pi * (th + math.sin(th) * math.cos(th)), abs=1e-10)
    assert r.significant is False


def test_degenerate_inputs(spark):
    constant_x = fit(spark, [(1.0, 2.0), (1.0, 4.0), (1.0, 5.0)])
    assert constant_x.slope is None and constant_x.r is None and constant_x.p is None
    constant_y = fit(spark, [(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)])
    assert constant_y.slope == 0 and constant_y.r2 is None and constant_y.p is None
    assert fit(spark, [(1.0, 3.0)]).slope is None
    two = fit(spark, [(1.0, 3.0), (2.0, 5.0)])
    assert two.slope == pytest.approx(2) and two.p is None and two.stderr is None
    perfect = fit(spark, [(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)])
    assert perfect.r2 == 1 and perfect.p == 0 and perfect.significant is True
    falling = fit(spark, [(1.0, 7.0), (2.0, 5.0), (3.0, 3.0)])
    assert falling.r == -1


def test_null_pairs_dropped_or_zero(spark):
    pairs = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 9.0), (4.0, 4.0)]
    dropped, filled = fit(spark, pairs), fit(spark, pairs, fill_zero=True)
    assert (dropped.n, filled.n) == (3, 4)
    assert filled.slope == pytest.approx(1.1)


def test_empty_input(spark):
    r = fit(spark, [])
    assert r.n == 0 and r.slope is None and r.p is None


def test_groups_measures_predictions(spark):
    df = spark.createDataFrame(
        [("a", x, 2.0 * x + 1, 0.3 * x) for x in range(4)] + [("b", x, -x + 1.0, 0.0) for x in range(4)],
        "g string, x int, y double, z double",
    )
    fits = fit_lines(df, "x", {"y": "y", "z": "z"}, by=["g"])
    got = {(r.g, r.measure): r.slope for r in fits.collect()}
    assert got[("a", "y")] == pytest.approx(2) and got[("b", "y")] == pytest.approx(-1)
    at = {(r.g, r.measure): r.predicted for r in predict(fits, [10], unit_measures=["z"]).collect()}
    assert at[("a", "y")] == pytest.approx(21) and at[("a", "z")] == 1.0 and at[("b", "z")] == 0.0

    overall = fit_lines(df.where("g = 'a'"), "x", {"y": "y", "z": "z"})
    rows = predict_rows(df.where("g = 'a'").select("x"), "x", overall, ["y"]).collect()
    assert sorted(r.predicted for r in rows) == pytest.approx([1, 3, 5, 7])
    points = line_points(overall, 4).where("measure = 'y'").orderBy("i").collect()
    assert [p.y for p in points] == pytest.approx([1, 3, 5, 7])
    scatter = scatter_counts(df, "x", {"z": "z"}).where("x = 0").collect()
    assert [(s.y, s.n) for s in scatter] == [(0.0, 2)]
