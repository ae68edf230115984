"""Weather / traffic versus usage.

All correlations are Pearson over the rows of a same-hour match, with the
pandas rules: pairs with a NULL are dropped, an undefined r (constant side,
< 2 points) is 0 (as ``voltgrid.functions.columns.pearson`` has it).

``by=[]`` gives the network-wide figure, ``by=["station_id"]`` one figure per
station in the same job.

Scale notes
- Usage and observations are both reduced to (station, hour) cells by partial
  hash aggregates before they meet, so the join sees one row per side and cell
  however many rows a station or an hour holds. R02–R08 are derived from one
  table of matched cells, with one scan of each source.
- The combined analysis (R06) correlates over every weather × traffic pair of
  a station-hour. Materialising those pairs grows quadratically with a hot
  cell, so R06 never does: a cell counts as often as it has pairs.
- Moments are centred everywhere (count, means, sums of squared deviations,
  co-moment) and merged pairwise, so a mean that is large against the spread
  loses no digits. Cells of equal weight go through the built-in central
  aggregates, which merge that way in partial aggregation; what is left, one
  entry for each distinct weight of a group, is merged by ``merged``. The
  distinct weights of a group are few: their sum is at most its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltgrid.functions.columns import hour_floor
from voltgrid.functions.groupstats import group_stats

# Fixed values of the insight rules.
INSIGHT_R = 0.3     # |r| above this → a sentence
STRONG_R = 0.5      # combined analysis: |r| above this → "strong"
TOP_N = 3           # conditions / congestion levels reported


def hourly_usage(usage: DataFrame) -> DataFrame:
    """Sessions (non-null ids) and energy per station × hour."""
    u = usage.where(F.col("station_id").isNotNull() & F.col("session_start").isNotNull())
    return u.groupBy("station_id", hour_floor("session_start").alias("hour")).agg(
        F.count("id").alias("session_count"),
        F.sum("energy_consumed_kwh").alias("total_energy"))


WEATHER_FEATURES = {"temperature": "temperature_celsius", "precipitation": "precipitation_mm"}
TRAFFIC_FEATURES = {"traffic_density": "traffic_density", "average_speed": "average_speed_kmh"}
CELL = ["station_id", "hour"]


def merged(parts: Column, sides: str = "x") -> Column:
    """One struct of moments from an array of them: ``n`` (the weight), the
    mean of each side, and for each pair of sides the sum of products of
    deviations (``xx``, ``xs``, ``ss``). Two sets of moments join by the
    distance of their means (the parallel form of Welford's update). Entries
    without weight are passed over."""
    pairs = [a + b for i, a in enumerate(sides) for b in sides[i:]]
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("n", *sides, *pairs)])

    def join(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = {k: b[k] - a[k] for k in sides}
        return F.struct(
            n.alias("n"), *[(a[k] + apart[k] * b["n"] / n).alias(k) for k in sides],
            *[(a[k] + b[k] + apart[k[0]] * apart[k[1]] * (a["n"] * b["n"] / n)).alias(k) for k in pairs])

    some = F.filter(parts, lambda p: p["n"] > 0)
    only = F.struct(*[F.get(some, F.lit(0))[k].alias(k) for k in ("n", *sides, *pairs)])
    return F.when(F.size(some) == 1, only).otherwise(F.aggregate(F.sort_array(some), zero, join))


def _cells(obs: DataFrame, side: str, features: dict[str, str], category: str) -> DataFrame:
    """J05's left side, merged before any join: per station and hour the
    number of observations, the moments of each feature with its least and
    greatest value, and the count of each category. Equal observations combine
    map-side, so a cell that holds a third of all rows costs a partial row per
    task and category."""
    parts, feature = [F.count(F.lit(1)).alias(f"n_{side}")], []
    for name, c in features.items():
        x = F.col(c).cast("double")
        parts += [F.count(x).cast("double").alias(f"{name}_n"), F.avg(x).alias(f"{name}_x"),
                  (F.var_pop(x) * F.count(x)).alias(f"{name}_xx"), F.min(x).alias(f"{name}_lo"),
                  F.max(x).alias(f"{name}_hi")]
        feature.append(F.struct(*[F.col(f"{name}_{k}").alias(k) for k in ("n", "x", "xx", "lo", "hi")]))
    # as many entries as the hour has categories
    per = (obs.where(F.col("station_id").isNotNull() & F.col("timestamp").isNotNull())
           .groupBy("station_id", hour_floor("timestamp").alias("hour"), category).agg(*parts)
           .groupBy(*CELL).agg(
               F.sum(f"n_{side}").alias(f"n_{side}"),
               F.collect_list(F.struct(F.col(category).alias("name"), F.col(f"n_{side}").alias("n"),
                                       F.array(*feature).alias("f"))).alias("parts")))

    def whole(i: Column) -> Column:
        of_feature = F.transform("parts", lambda p: F.get(p["f"], i))
        return F.struct(merged(of_feature).alias("m"), F.array_min(F.transform(of_feature, lambda f: f["lo"])).alias("lo"),
                        F.array_max(F.transform(of_feature, lambda f: f["hi"])).alias("hi"))

    per = per.withColumn("whole", F.transform(F.sequence(F.lit(0), F.lit(len(features) - 1)), whole))
    of = lambda i, k: F.get(F.col("whole"), F.lit(i))[k]
    return per.select(
        *CELL, f"n_{side}",
        F.transform(F.filter("parts", lambda p: p["name"].isNotNull()),
                    lambda p: F.struct(p["name"].alias("name"), p["n"].alias("n"))).alias(f"kinds_{side}"),
        *[of(i, "m").alias(k) for i, k in enumerate(features)],
        *[of(i, b).alias(f"{k}_{b}") for i, k in enumerate(features) for b in ("lo", "hi")])


def weather_cells(weather: DataFrame) -> DataFrame:
    return _cells(weather, "w", WEATHER_FEATURES, "weather_condition")


def traffic_cells(traffic: DataFrame) -> DataFrame:
    return _cells(traffic, "t", TRAFFIC_FEATURES, "congestion_level")


def matched_cells(usage: DataFrame, weather: DataFrame | None = None, traffic: DataFrame | None = None) -> DataFrame:
    """Hourly usage with the observations of the same station and hour (NULL
    where there are none): one scan of each table, one row per cell."""
    out = hourly_usage(usage)
    if weather is not None:
        out = out.join(weather_cells(weather), CELL, "left")
    if traffic is not None:
        out = out.join(traffic_cells(traffic), CELL, "left")
    return out


Metric = tuple[str, str, Column, Column]      # name, feature, times that a cell counts, its data points

# entries of a cell: a feature with its weight, or a category
ENTRY = "metric string, name string, w double, x double, m2 double, lo double, hi double, points bigint"


def _entries(metrics: list[Metric], kinds: dict[str, str]) -> Column:
    """What a cell gives to its group: an entry for each metric that it has
    data points for, and one for each of its categories."""
    kind = lambda **c: F.struct(*[c[f.split()[0]].cast(f.split()[1]).alias(f.split()[0]) for f in ENTRY.split(", ")])
    none = F.lit(None)
    category = lambda m: lambda k: kind(
        metric=F.lit(m), name=k["name"], w=F.lit(0.0), x=none, m2=none, lo=none, hi=none, points=k["n"])
    arrays = [F.when(points > 0, F.array(kind(
        metric=F.lit(m), name=none, w=F.col(f)["n"] * times, x=F.col(f)["x"], m2=F.col(f)["xx"] * times,
        lo=F.col(f"{f}_lo"), hi=F.col(f"{f}_hi"), points=points))).otherwise(F.array())
        for m, f, times, points in metrics]
    arrays += [F.transform(F.coalesce(c, F.array()), category(m)) for m, c in kinds.items()]
    return F.concat(*arrays)


def _grouped(cells: DataFrame, by: list[str], metrics: list[Metric], kinds: dict[str, str] | None = None) -> DataFrame:
    """One row per group (or exactly one): r and data points (``…__points``)
    of each metric; for each kind an array of its categories, the highest mean
    of sessions first."""
    kinds = kinds or {}
    rows = cells.select(*by, F.col("session_count").cast("double").alias("s"), F.col("session_count").alias("k"),
                        F.inline(_entries(metrics, kinds)))
    n = F.count(F.lit(1)) * F.col("w")
    # a weight of 0 has no value of the feature
    per = rows.groupBy(*by, "metric", "name", "w").agg(
        n.alias("n"), F.avg("x").alias("x"), F.avg("s").alias("s"),
        (n * F.var_pop("x") + F.sum("m2")).alias("xx"), (n * F.covar_pop("x", "s")).alias("xs"),
        (n * F.var_pop("s")).alias("ss"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("s").alias("s_lo"), F.max("s").alias("s_hi"), F.sum("points").alias("points"),
        F.round(F.try_divide(F.sum(F.col("points") * F.col("k")).cast("double"),
                             F.sum("points").cast("double")), 6).alias("mean_sessions"))
    part = F.struct("n", "x", "s", "xx", "xs", "ss", "lo", "hi", "s_lo", "s_hi", "points")
    category = F.struct((-F.col("mean_sessions")).alias("o"), "name", F.col("mean_sessions").alias("m"))
    mine = lambda m, entry: F.collect_list(F.when(F.col("metric") == m, entry))
    g = group_stats(per, by, **{m: mine(m, part) for m, *_ in metrics},
                    **{m: F.sort_array(mine(m, category)) for m in kinds})
    # one expression over the array of metrics, not one for each
    g = g.select(*by, *kinds, F.transform(F.array(*[F.col(m) for m, *_ in metrics]), _pearson).alias("r_and_points"))
    at = lambda i, k: F.get(F.col("r_and_points"), F.lit(i))[k]
    return g.select(*by, *kinds, *[at(i, "r").alias(m) for i, (m, *_) in enumerate(metrics)],
                    *[at(i, "points").alias(f"{m}__points") for i, (m, *_) in enumerate(metrics)])


def _pearson(all_parts: Column) -> Column:
    """Pearson's r of a metric and its data points; a constant side, or
    nothing at all, gives 0."""
    some = F.filter(all_parts, lambda p: p["n"] > 0)

    def r_of(parts: Column) -> Column:
        each = lambda k: F.transform(parts, lambda p: p[k])
        flat = lambda lo, hi: F.array_min(each(lo)) == F.array_max(each(hi))
        # an array of one, so that the moments are an element and merged once
        r = F.get(F.transform(F.array(merged(parts, "xs")),
                              lambda m: F.try_divide(m["xs"], F.sqrt(m["xx"]) * F.sqrt(m["ss"]))), F.lit(0))
        return F.round(F.when((F.size(parts) == 0) | flat("lo", "hi") | flat("s_lo", "s_hi"), F.lit(0.0))
                       .otherwise(F.coalesce(r, F.lit(0.0))), 6)

    return F.struct(F.get(F.transform(F.array(some), r_of), F.lit(0)).alias("r"),
                    F.aggregate(all_parts, F.lit(0).cast("bigint"), lambda a, p: a + p["points"]).alias("points"))


def _side(cells: DataFrame, by: list[str], features: dict[str, str], side: str, named: dict[str, str]) -> DataFrame:
    once, points = F.lit(1), F.coalesce(F.col(f"n_{side}"), F.lit(0))
    g = _grouped(cells, by, [(f, f, once, points) for f in features])
    return g.select(*by, *[F.col(f).alias(out) for f, out in named.items()],
                    F.col(f"{next(iter(features))}__points").alias("data_points"))


def weather_usage_correlation(weather: DataFrame, usage: DataFrame, by=()) -> DataFrame:
    """Temperature and precipitation against the same-hour session count."""
    return _side(matched_cells(usage, weather), list(by), WEATHER_FEATURES, "w", WEATHER_NAMES)


def traffic_usage_correlation(traffic: DataFrame, usage: DataFrame, by=()) -> DataFrame:
    """Traffic density and average speed against the session count."""
    return _side(matched_cells(usage, traffic=traffic), list(by), TRAFFIC_FEATURES, "t", TRAFFIC_NAMES)


WEATHER_NAMES = {"temperature": "temperature_vs_sessions", "precipitation": "precipitation_vs_sessions"}
TRAFFIC_NAMES = {"traffic_density": "traffic_density_vs_sessions", "average_speed": "average_speed_vs_sessions"}


def _impact(cells: DataFrame, side: str, col: str, by, n: int) -> DataFrame:
    by = list(by)
    kinds = cells.select(*by, "session_count", F.explode(f"kinds_{side}").alias("k"))
    mean = F.try_divide(F.sum(F.col("k.n") * F.col("session_count")).cast("double"), F.sum("k.n").cast("double"))
    g = kinds.groupBy(*by, F.col("k.name").alias(col)).agg(F.round(mean, 6).alias("mean_sessions"))
    order = [F.col("mean_sessions").desc(), F.col(col).asc()]
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    # network-wide: a top-n (TakeOrderedAndProject), not a global window
    top = g.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def condition_impact(weather: DataFrame, usage: DataFrame, by=(), n: int = TOP_N) -> DataFrame:
    """Mean session count per weather condition, top ``n``."""
    return _impact(matched_cells(usage, weather), "w", "weather_condition", by, n)


def congestion_impact(traffic: DataFrame, usage: DataFrame, by=(), n: int = TOP_N) -> DataFrame:
    """Mean session count per congestion level, top ``n``."""
    return _impact(matched_cells(usage, traffic=traffic), "t", "congestion_level", by, n)


# ------------------------------------------------------------------ R06

COMBINED = [*WEATHER_FEATURES, *TRAFFIC_FEATURES]


def _combined_metrics(prefix: str = "") -> list[Metric]:
    """The three-way match keeps the weather × traffic multiplicity of the
    merge without making its pairs."""
    n_w, n_t = F.coalesce("n_w", F.lit(0)), F.coalesce("n_t", F.lit(0))
    return [*[(prefix + f, f, n_t, n_w * n_t) for f in WEATHER_FEATURES],
            *[(prefix + f, f, n_w, n_w * n_t) for f in TRAFFIC_FEATURES]]


def _all_metrics() -> list[Metric]:
    """R02, R04 and R06 in one aggregate: w_ and t_ for the two-way matches,
    c_ for the three-way match."""
    once = F.lit(1)
    return [*[(f"w_{f}", f, once, F.coalesce("n_w", F.lit(0))) for f in WEATHER_FEATURES],
            *[(f"t_{f}", f, once, F.coalesce("n_t", F.lit(0))) for f in TRAFFIC_FEATURES], *_combined_metrics("c_")]


def combined_correlation(weather: DataFrame, traffic: DataFrame, usage: DataFrame, by=()) -> DataFrame:
    """Temperature, precipitation, density and speed against sessions
    over the three-way same-hour match."""
    by = list(by)
    g = _grouped(matched_cells(usage, weather, traffic), by, _combined_metrics())
    return g.select(*by, *COMBINED, F.col(f"{COMBINED[0]}__points").alias("data_points"))


# ------------------------------------------------------------------ R07 / R08

# The sentences.
SENTENCE = "%s shows %s correlation (%.2f) with session count"
CONDITION_TEXT = "Weather conditions with highest usage: "
CONGESTION_TEXT = "Congestion levels with highest usage: "
STRONG_TEXT = "Strong correlations found: "


def _sentence(label: str, r: Column) -> Column:
    return F.when(F.abs(r) > INSIGHT_R, F.format_string(
        SENTENCE, F.lit(label), F.when(r > 0, F.lit("positive")).otherwise(F.lit("negative")), r))


def correlation_insights(weather: DataFrame, traffic: DataFrame, usage: DataFrame, by=()) -> DataFrame:
    """The insight sentences — temperature, precipitation and density
    with |r| > 0.3 (speed has none), the top conditions / congestion levels,
    and the combined analysis' strong (|r| > 0.5) correlations.

    One pass over the cells: each gives an entry for each metric and each of
    its categories; these are added up per group and category, then per group,
    where a list has as many entries as there are categories."""
    by = list(by)
    cells = matched_cells(usage, weather, traffic)
    one = _grouped(cells, by, _all_metrics(), {"kind_w": "kinds_w", "kind_t": "kinds_t"}).withColumns(
        {"top_w": F.slice("kind_w", 1, TOP_N), "top_t": F.slice("kind_t", 1, TOP_N)})

    def listed(col, section, text):
        items = F.array_join(F.transform(col, lambda x: F.format_string(
            "'%s': %s", x["name"], x["m"].cast("string"))), ", ")
        line = F.concat(F.lit(text + "{"), items, F.lit("}"))
        return item(section, F.when(F.size(col) > 0, line))

    def item(section, text):
        return F.struct(F.lit(section).alias("section"), text.alias("insight"))

    strong = F.array_compact(F.array(*[F.when(F.abs(F.col(f"c_{k}")) > STRONG_R, F.format_string(
        f"'{k}': %s", F.col(f"c_{k}").cast("string"))) for k in COMBINED]))
    items = F.array(
        item("weather_correlation", _sentence("Temperature", F.col("w_temperature"))),
        item("weather_correlation", _sentence("Precipitation", F.col("w_precipitation"))),
        listed(F.col("top_w"), "weather_correlation", CONDITION_TEXT),
        item("traffic_correlation", _sentence("Traffic density", F.col("t_traffic_density"))),
        listed(F.col("top_t"), "traffic_correlation", CONGESTION_TEXT),
        item("combined_correlation", F.when(F.size(strong) > 0, F.concat(
            F.lit(STRONG_TEXT + "{"), F.array_join(strong, ", "), F.lit("}")))))
    return (one.select(*by, F.explode(items).alias("i")).select(*by, "i.section", "i.insight")
            .where(F.col("insight").isNotNull()))


def correlation_report(weather: DataFrame, traffic: DataFrame, usage: DataFrame, by=()) -> DataFrame:
    """R02 + R04 + R06 and the three point counts in long form
    (section, metric, value), from one aggregate over the cells; a group has
    the sections it has data points for."""
    by = list(by)
    one = _grouped(matched_cells(usage, weather, traffic), by, _all_metrics())

    def section(name, prefix, metrics, summary):
        points = F.col(f"{prefix}_{next(iter(metrics))}__points").cast("double")
        entry = lambda s, m, v: F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.alias("value"))
        items = F.array(*[entry(name, out, F.col(f"{prefix}_{f}")) for f, out in metrics.items()],
                        entry(name, "data_points", points), entry("summary", summary, points))
        return items if not by else F.when(points > 0, items).otherwise(F.slice(items, 1, 0))

    items = F.concat(section("weather_correlation", "w", WEATHER_NAMES, "weather_data_points"),
                     section("traffic_correlation", "t", TRAFFIC_NAMES, "traffic_data_points"),
                     section("combined_correlation", "c", {f: f for f in COMBINED}, "combined_data_points"))
    return one.select(*by, F.explode(items).alias("kv")).select(*by, "kv.section", "kv.metric", "kv.value")
