"""Exact quantiles by selection against numpy (linear interpolation)."""

import numpy as np
import pytest

from voltgrid.functions.quantiles import exact_quantile, exact_quantiles


def _frame(spark, vals):
    return spark.createDataFrame([(None if v is None else float(v),) for v in vals], "v double").repartition(7)


@pytest.mark.parametrize("q", [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0])
def test_matches_numpy_with_duplicates_and_nulls(spark, q):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 0.5), rng.integers(0, 5, 1000)])
    df = _frame(spark, [*vals, *[None] * 17])
    want = float(np.quantile(vals, q))
    # many rounds of few cells, one round, none at all: always the same value
    for cells, levels in ((65536, 2), (4, 4), (2, 0)):
        got = exact_quantile(df, "v", q, cells=cells, levels=levels).collect()[0].threshold
        assert got == pytest.approx(want, rel=1e-12, abs=1e-12), (cells, levels)


@pytest.mark.parametrize("name,vals", [
    ("spread", [-1e300, -5e-324, 0.0, 5e-324, 1e-300, 1e300, 3.0, 3.0000000000000004]),
    ("outlier", [*range(1000), 1e18]), ("equal", [7.25] * 50), ("near", 2e7 + np.arange(200) * 1e-8),
    ("negative", [-3, -3, -2, -1, -0.0, 0.0]), ("overflow", [-1.7e308, 1.7e308, 0.0, 1.0, 2.0])])
def test_awkward_values(spark, name, vals):
    df = _frame(spark, vals)
    r = exact_quantiles(df, [("v", q, f"q{i}") for i, q in enumerate((0.0, 0.3, 0.5, 0.8, 1.0))], cells=8, levels=2).collect()[0]
    for i, q in enumerate((0.0, 0.3, 0.5, 0.8, 1.0)):
        got, below = r[f"q{i}"], r[f"q{i}_below"]
        assert below == sum(v < got for v in vals), (name, q)
        lo, hi = np.quantile(vals, q, method="lower"), np.quantile(vals, q, method="higher")
        f = q * (len(vals) - 1) % 1
        assert got == pytest.approx(lo + (hi - lo) * f if np.isfinite(hi - lo) and f else lo, rel=1e-12) or f and lo <= got <= hi


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 20, 101, 250])
def test_small_and_boundary_sizes(spark, n):
    vals = np.random.default_rng(n).integers(0, 50, n).astype(float)
    r = exact_quantiles(_frame(spark, vals), [("v", 0.25, "low"), ("v", 0.75, "high")], cells=4, levels=1).collect()[0]
    assert (r.low_below, r.high_below) == ((vals < r.low).sum(), (vals < r.high).sum())
    assert (r.low, r.high) == pytest.approx((np.quantile(vals, 0.25), np.quantile(vals, 0.75)), rel=1e-12, abs=1e-12)


def test_empty_and_single(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.25).collect()[0].threshold is None
    assert exact_quantile(_frame(spark, [4.0]), "v", 0.25).collect()[0].threshold == 4.0


def test_several_specs_in_one_pass(spark):
    rng = np.random.default_rng(11)
    a = rng.integers(0, 40, 3000).astype(float)
    b = rng.normal(5, 2, 3000)
    df = spark.createDataFrame([(float(x), float(y) if i % 9 else None) for i, (x, y) in enumerate(zip(a, b))],
                               "a double, b double")
    bb = np.array([float(y) for i, y in enumerate(b) if i % 9])
    r = exact_quantiles(df, [("a", 0.25, "a25"), ("a", 0.75, "a75"), ("b", 0.1, "b10")]).collect()[0]
    assert r.a25 == pytest.approx(float(np.quantile(a, 0.25)), rel=1e-12)
    assert r.a75 == pytest.approx(float(np.quantile(a, 0.75)), rel=1e-12)
    assert r.b10 == pytest.approx(float(np.quantile(bb, 0.1)), rel=1e-12)


def test_no_task_orders_a_whole_column(spark):
    """Every window runs over the cells of a round or over what the last round
    has left; the counted values are shuffled once."""
    rng = np.random.default_rng(5)
    df = exact_quantile(_frame(spark, rng.normal(0, 1, 20_000)), "v", 0.3, cells=64, levels=2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2
    rows = [line for line in plan.split("\n") if "Scan ExistingRDD" in line or "LocalTableScan" in line]
    assert len(rows) <= 1, plan
