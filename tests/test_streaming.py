"""T01–T08 on landing data derived from the test tables (availableNow
triggers, memory / foreachBatch sinks, checkpoints in the scratch folder)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import AS_OF, SF001
from voltgrid.operators import correlations
from voltgrid.sinks.tables import read_upserted
from voltgrid.sources import documents, ingest
from voltgrid.sources.testdata import adapter_tables
from voltgrid.streaming import jobs


def _land(df, path):
    df.write.mode("overwrite").text(path)
    return path


def test_t04_hourly_stream_complete_equals_batch(spark, scratch):
    t = adapter_tables(spark, SF001)
    src = scratch + "/usage_parquet"
    t.usage.write.parquet(src)
    stream = spark.readStream.schema(t.usage.schema).parquet(src)
    q = jobs.hourly_usage_stream(stream)
    run = jobs.run_available_now(q, "t04_hourly", "memory", checkpoint=scratch + "/ck", output_mode="complete")
    got = sorted((r.station_id, r.hour, r.session_count, float(r.total_energy))
                 for r in spark.table("t04_hourly").collect())
    want = sorted((r.station_id, r.hour, r.session_count, float(r.total_energy))
                  for r in correlations.hourly_usage(t.usage).collect())
    assert got == want
    assert run.lastProgress is not None


def test_t01_t06_t02_landing_to_upserted_table(spark, scratch):
    t = adapter_tables(spark, SF001)
    land = _land(documents.station_documents(t.stations), scratch + "/land/stations")
    stream = jobs.landing_stream(spark, land, "stations")
    cleaned = jobs.cleaned_stream(stream, "stations", AS_OF)
    sink = jobs.upsert_sink(scratch + "/store", "charging_stations", ["id"], ["updated_at"])
    jobs.run_available_now(cleaned, "t02_stations", sink, checkpoint=scratch + "/ck2")
    stored = read_upserted(spark, scratch + "/store", "charging_stations")
    assert stored.count() == t.stations.count()
    # an empty batch changes nothing
    sink(cleaned.sparkSession.createDataFrame([], stored.schema), 0)
    assert read_upserted(spark, scratch + "/store", "charging_stations").count() == t.stations.count()


def test_t02_batches_of_two_queries_and_redelivery(spark, scratch):
    """Two queries on one table, as after a lost checkpoint: both start at
    batch 0, and neither's is dropped; a batch delivered again changes
    nothing, also after a crash that lost some of its buckets."""
    from voltgrid.schemas import schema
    row = lambda i, name, day: (i, name, *[None] * 13, dt.datetime(2024, 1, day))
    frame = lambda *rows: spark.createDataFrame(list(rows), schema("charging_stations"))
    make = lambda q: jobs.upsert_sink(scratch, "charging_stations", ["id"], ["updated_at"], query=q)
    one, two = make("q1"), make("q2")
    one(frame(row("1", "a", 1)), 0)
    two(frame(row("9", "b", 1)), 0)
    one(frame(row("2", "c", 2)), 1)
    one(frame(row("1", "late", 3)), 0)          # batch 0 of q1 again: committed before
    got = {r.id: r.name for r in read_upserted(spark, scratch, "charging_stations").collect()}
    assert got == {"1": "a", "9": "b", "2": "c"}
    two(frame(row("1", "d", 3), row("5", "e", 1)), 1)
    one(frame(row("1", "a", 1)), 0)             # an old batch again: the later row stays
    two(frame(row("1", "d", 3), row("5", "e", 1), row("6", "lost", 1)), 1)      # again, whole this time
    make("q1-new")(frame(row("1", "f", 4)), 0)  # a new checkpoint starts at 0
    got = {r.id: r.name for r in read_upserted(spark, scratch, "charging_stations").collect()}
    assert got == {"1": "f", "9": "b", "2": "c", "5": "e", "6": "lost"}


def test_t05_stream_stream_join(spark, scratch):
    t = adapter_tables(spark, SF001)
    for n, df in (("w", t.weather), ("u", t.usage)):
        df.repartition(2).write.parquet(f"{scratch}/{n}")
    read = lambda n, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/{n}")
    # a long delay: nothing of these files is late
    joined = jobs.weather_usage_stream(read("w", t.weather), read("u", t.usage), delay="400 days")
    assert {"hour", "session_count", "total_energy", "station_id"} <= set(joined.columns)
    jobs.run_available_now(joined, "t05_streams", "memory", checkpoint=scratch + "/ck5")
    # hours are emitted once the watermark has passed them: none with this delay
    assert spark.table("t05_streams").count() == 0
    late = spark.createDataFrame([(10 ** 9, "none", dt.datetime(2100, 1, 1))], "id long, station_id string, at timestamp_ntz")
    from voltgrid.schemas import conform
    conform(late.withColumnRenamed("at", "timestamp"), "weather_data").write.mode("append").parquet(f"{scratch}/w")
    conform(late.withColumnRenamed("at", "session_start"), "usage_data").write.mode("append").parquet(f"{scratch}/u")
    jobs.run_available_now(joined, "t05_streams2", _collected(scratch), checkpoint=scratch + "/ck5")
    from voltgrid.functions.columns import hour_floor
    hourly = t.usage.groupBy("station_id", hour_floor("session_start").alias("hour")).count()
    want = t.weather.withColumn("hour", hour_floor("timestamp")).join(hourly, ["station_id", "hour"]).count()
    assert spark.read.parquet(f"{scratch}/t05").count() == want > 0


def _collected(scratch):
    return lambda batch, batch_id: batch.write.mode("append").parquet(f"{scratch}/t05")


def test_t08_monthly_quota(spark, scratch):
    t = adapter_tables(spark, SF001)
    from voltgrid.operators import derived
    quotas = {"1-URGENT": ("month", 3), "2-HIGH": ("day", 1)}
    t.log.write.parquet(scratch + "/log")
    stream = spark.readStream.schema(t.log.schema).parquet(scratch + "/log")
    jobs.run_available_now(jobs.quota_usage_stream(stream, quotas), "t08_quota", "memory",
                           checkpoint=scratch + "/ck8m", output_mode="complete")
    assert sorted(map(tuple, spark.table("t08_quota").collect())) == sorted(
        map(tuple, derived.quota_usage(t.log, quotas).collect()))


def test_t03_dedupe_within_watermark(spark, scratch):
    t = adapter_tables(spark, SF001)
    src = scratch + "/dup"
    t.usage.unionByName(t.usage).write.parquet(src)     # every record delivered twice
    stream = spark.readStream.schema(t.usage.schema).parquet(src)
    jobs.run_available_now(jobs.dedupe_stream(stream, "session_start", ["id"]), "t03_dedupe", "memory",
                           checkpoint=scratch + "/ck3")
    assert spark.table("t03_dedupe").count() == t.usage.count()


def test_t05_weather_joined_to_hourly_table(spark, scratch):
    t = adapter_tables(spark, SF001)
    hourly = correlations.hourly_usage(t.usage)
    land = _land(documents.weather_documents(t.weather), scratch + "/land/weather")
    stream = jobs.landing_stream(spark, land, "weather")
    out = jobs.weather_with_stored_usage(stream, hourly)
    jobs.run_available_now(out, "t05_weather", "memory", checkpoint=scratch + "/ck5")
    batch = correlations.weather_usage_correlation(t.weather, t.usage).collect()[0].data_points
    assert spark.table("t05_weather").count() == batch


def test_t08_quota_counter(spark, scratch):
    t = adapter_tables(spark, SF001)
    src = scratch + "/log"
    t.log.write.parquet(src)
    stream = spark.readStream.schema(t.log.schema).parquet(src)
    jobs.run_available_now(jobs.quota_counter_stream(stream), "t08_quota", "memory",
                           checkpoint=scratch + "/ck8", output_mode="complete")
    total = spark.table("t08_quota").agg(F.sum("calls")).collect()[0][0]
    assert total == t.log.count()


def test_checkpoint_location_uses_session_setting(spark):
    loc = jobs.checkpoint_location(spark, "q")
    assert loc.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert os.path.basename(loc) == "q"


def test_t07_scores_a_stream_like_batch(spark, scratch):
    from voltgrid.operators import isolation_forest as IF
    from voltgrid.operators.features import usage_features
    t = adapter_tables(spark, SF001)
    feats = usage_features(t.stations, t.usage, t.weather, t.traffic, AS_OF)
    src = scratch + "/features"
    feats.write.parquet(src)
    model = IF.fit(spark.read.parquet(src), n_trees=10)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    jobs.run_available_now(jobs.score_stream(stream, model), "t07_scores", "memory", checkpoint=scratch + "/ck7")
    got = sorted((r.station_id, round(r.score, 12)) for r in spark.table("t07_scores").collect())
    want = sorted((r.station_id, round(r.score, 12)) for r in IF.score(model, spark.read.parquet(src)).collect())
    assert got == want


def test_weather_landing_stream_appends_with_audit(spark, scratch):
    t = adapter_tables(spark, SF001)
    land = _land(documents.weather_documents(t.weather), scratch + "/land/weather")
    cleaned = jobs.cleaned_stream(jobs.landing_stream(spark, land, "weather"), "weather", AS_OF)
    sink = jobs.append_sink(scratch + "/store", "weather_data", "date", audit=("OpenWeatherMap", "weather_data"))
    jobs.run_available_now(cleaned, "t01_weather", sink, checkpoint=scratch + "/ckw")
    stored = spark.read.parquet(scratch + "/store/weather_data")
    assert stored.count() == t.weather.count() and "date" in stored.columns
    log = spark.read.parquet(scratch + "/store/data_collection_log").collect()
    assert sum(r.records_collected for r in log) == t.weather.count()
    assert all(r.status == "success" and r.data_source == "OpenWeatherMap" for r in log)
    # a re-delivered micro-batch replaces its own load directory
    from voltgrid.operators import cleaning
    replay = cleaning.clean_weather(ingest.read_weather_json(spark, land), AS_OF)   # batch 0 again, from the source
    sink(replay, 0)
    assert spark.read.parquet(scratch + "/store/weather_data").count() == t.weather.count()


def test_t08_state_ends(spark, scratch):
    """The three services: months stay open while days pass; a period's state
    is dropped once it has been over for longer than the longest one."""
    from voltgrid.operators import derived
    from voltgrid.schemas import conform
    call = lambda *rows: conform(spark.createDataFrame(
        [(s, dt.datetime(*d)) for s, d in rows], "data_source string, started_at timestamp_ntz"), "data_collection_log")
    batches = [call(("openweather", (2024, 1, 3)), ("here_maps", (2024, 1, 3)), ("openchargemap", (2024, 1, 3))),
               call(("openweather", (2024, 1, 31, 23)), ("here_maps", (2024, 1, 30))),
               call(("here_maps", (2024, 1, 31)), ("openweather", (2024, 4, 1))),
               call(("openweather", (2024, 4, 2)))]
    rows, sizes = [], []
    sink = lambda batch, _: rows.extend(map(tuple, batch.collect()))
    for i, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(scratch + "/log")
        stream = spark.readStream.schema(b.schema).parquet(scratch + "/log")
        run = jobs.run_available_now(jobs.quota_usage_stream(stream), f"t08_end_{i}", sink, checkpoint=scratch + "/ck",
                                     output_mode="update")
        sizes.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    last = {r[:3]: r for r in rows}
    want = derived.quota_usage(batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3]))
    assert sorted(last.values()) == sorted(map(tuple, want.collect()))
    assert last["here_maps", "month", dt.datetime(2024, 1, 1)][3] == 3
    assert sizes[1] == 4 and sizes[-1] <= 2, sizes
