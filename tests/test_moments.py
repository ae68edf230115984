"""Correlations from merged moments (R02–R08) against numpy."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltgrid.operators import correlations as corr

START = dt.datetime(2024, 1, 1)


def _tables(spark, hours):
    """Frames from [(station, hour, [(temperature, condition)], [(density, speed)], sessions)]."""
    w, t, u = [], [], []
    for station, h, weather, traffic, sessions in hours:
        at = START + dt.timedelta(hours=h)
        w += [(station, at, x, c) for x, c in weather]
        t += [(station, at, x, y) for x, y in traffic]
        u += [(station, at, len(u) + i, 1.0) for i in range(sessions)]
    return (spark.createDataFrame(w, "station_id string, timestamp timestamp_ntz, temperature_celsius double, weather_condition string")
            .withColumn("precipitation_mm", F.col("temperature_celsius") * 0),
            spark.createDataFrame(t, "station_id string, timestamp timestamp_ntz, traffic_density double, average_speed_kmh double")
            .withColumn("congestion_level", F.lit("light")),
            spark.createDataFrame(u, "station_id string, session_start timestamp_ntz, id long, energy_consumed_kwh double"))


def _r(x, y):
    x, y = np.asarray(x, float), np.asarray(y, float)
    x, y = x - x.mean(), y - y.mean()
    d = np.sqrt((x * x).sum() * (y * y).sum())
    return round(float((x * y).sum() / d), 6) if d else 0.0


def test_large_mean_small_spread(spark):
    """Values around 20,000,000 with a spread of 0.03."""
    rng = np.random.default_rng(1)
    sessions = rng.integers(1, 9, 600)
    x = 2e7 + 0.01 * sessions + rng.normal(0, 0.03, 600)
    w, _, u = _tables(spark, [("1", h, [(float(v), "Rain")], [], int(s)) for h, (v, s) in enumerate(zip(x, sessions))])
    for by in ([], ["station_id"]):
        r = corr.weather_usage_correlation(w, u, by=by).collect()[0]
        assert r.temperature_vs_sessions == pytest.approx(_r(x, sessions), abs=2e-6) and abs(r.temperature_vs_sessions) > 0.2
        assert r.precipitation_vs_sessions == 0.0 and r.data_points == 600


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(-3, 3), st.integers(0, 2), st.integers(1, 4)),
                min_size=2, max_size=25), st.sampled_from([0.0, 1e6, -3e7]))
def test_three_way_match_against_pairs(spark, rows, offset):
    """R02, R04 and R06 equal Pearson over the pairs themselves, whatever the
    offset, with several observations an hour and stations that are constant."""
    hours = {}
    for station, h, x, n, s in rows:
        weather, traffic, _ = hours.get((station, h), ([], [], 0))
        hours[station, h] = (weather + [(offset + x / 8, "ab"[x % 2])], traffic + [(offset - x / 4, 30.0 + x)] * n, s)
    w, t, u = _tables(spark, [(str(k), h, a, b, s) for (k, h), (a, b, s) in hours.items()])
    got = corr.combined_correlation(w, t, u).collect()[0]
    pairs = [(a[0], b[0], b[1], s) for a_, b_, s in hours.values() for a in a_ for b in b_]
    assert got.data_points == len(pairs)
    for i, c in ((0, "temperature"), (1, "traffic_density"), (2, "average_speed")):
        want = _r([p[i] for p in pairs], [p[3] for p in pairs]) if pairs else 0.0
        assert got[c] == pytest.approx(want, abs=2e-6), c
    two = [(a[0], s) for a_, _, s in hours.values() for a in a_]
    assert corr.weather_usage_correlation(w, u).collect()[0].temperature_vs_sessions == pytest.approx(
        _r(*zip(*two)), abs=2e-6)


def test_merged_is_the_moments_of_all(spark):
    """Any split of the rows merges to the same moments."""
    rng = np.random.default_rng(2)
    x, y = rng.normal(1e8, 1, 90), rng.normal(-5, 2, 90)
    parts = []
    for cut in np.split(np.arange(90), [1, 7, 40]):
        a, b = x[cut], y[cut]
        parts.append((float(len(cut)), float(a.mean()), float(b.mean()), float(((a - a.mean()) ** 2).sum()),
                      float(((a - a.mean()) * (b - b.mean())).sum()), float(((b - b.mean()) ** 2).sum())))
    parts.append((0.0, 1.0, 1.0, 0.0, 0.0, 0.0))
    df = spark.createDataFrame([(parts,)], "p array<struct<n: double, x: double, s: double, xx: double, xs: double, ss: double>>")
    m = df.select(corr.merged(F.col("p"), "xs").alias("m")).first().m
    assert m.n == 90 and m.x == pytest.approx(x.mean(), rel=1e-15) and m.s == pytest.approx(y.mean())
    assert m.xx == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6)
    assert m.xs == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), rel=1e-5)


def test_no_match_gives_zero_and_no_row(spark):
    w, t, u = _tables(spark, [("1", 1, [(1.0, "Rain")], [(5.0, 30.0)], 2)])
    late = u.withColumn("station_id", F.lit("2"))
    r = corr.combined_correlation(w, t, late).collect()
    assert [(x.temperature, x.data_points) for x in r] == [(0.0, 0)]
    assert corr.weather_usage_correlation(w, late, by=["station_id"]).collect() == []
    assert corr.correlation_insights(w, t, late).collect() == []
