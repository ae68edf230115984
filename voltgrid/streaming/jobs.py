"""Structured Streaming forms of the collection cycle.

The reference re-runs its whole cycle every two hours; here each step is an
incremental query over a landing zone, run with ``trigger(availableNow=True)``
(process what has arrived, then stop — the scheduled-batch pattern) or a
processing-time trigger. Every query has its own checkpoint location, which
must be on shared storage (the session's ``spark.checkpoint.dir`` or a path
given by the caller), so a restarted or retried query resumes exactly.

Event-time columns are zone-less in the tables; watermarks need TIMESTAMP, so
streaming jobs map the event column to the UTC instant with the same wall time
(``ntz_to_instant``) — windows then follow the data's own clock in any session
time zone (SURVEY §7.4).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltgrid.functions.columns import instant_to_ntz, ntz_to_instant
from voltgrid.operators import cleaning
from voltgrid.operators.derived import quota_columns, quota_periods
from voltgrid.session import checkpoint_dir
from voltgrid.sinks.tables import append, collection_log_row, upsert
from voltgrid.sources import ingest


def checkpoint_location(spark: SparkSession, query: str) -> str:
    return f"{checkpoint_dir(spark)}/streams/{query}"


# ---------------------------------------------------------------- T01 / T06

def landing_stream(spark: SparkSession, path: str, kind: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of a landing folder of JSON documents
    (``kind`` = stations | weather | traffic_flow | incidents), parsed by
    the batch readers S01/S05/S09/S11 — they are row-local, so they apply to
    streams unchanged."""
    ddl = {"stations": ingest.STATION_DOC, "weather": ingest.WEATHER_DOC,
           "traffic_flow": ingest.TRAFFIC_FLOW_DOC, "incidents": ingest.INCIDENT_DOC}[kind]
    r = (spark.readStream.schema(ddl).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", ingest.CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = r.json(path)
    return {"stations": ingest.parse_stations, "weather": ingest.parse_weather,
            "traffic_flow": ingest.parse_traffic_flow, "incidents": ingest.parse_incidents}[kind](docs)


def cleaned_stream(stream: DataFrame, kind: str, as_of: _dt.datetime) -> DataFrame:
    """The batch cleaning rules C01–C03 on a stream (stateless)."""
    return {"stations": cleaning.clean_stations, "weather": cleaning.clean_weather,
            "traffic": cleaning.clean_traffic}[kind](stream, as_of)


# ---------------------------------------------------------------- T02

def upsert_sink(root: str, name: str, key: list[str], order_by: list[str], query: str | None = None):
    """``foreachBatch`` function merging each micro-batch into an
    upserted table (K01). Rows carry the query and the number of the batch
    that wrote them: ``query`` or, without it, the id that Spark keeps in the
    query's own checkpoint, so the batches of another query, or of a new
    checkpoint, are never taken for this one's. A batch delivered again finds
    its own rows, or later ones, and changes nothing; one that failed half way
    merges what it had not."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert(spark, root, name, batch, key, order_by, version=own or "batch", batch_id=batch_id)
    return write


def append_sink(root: str, name: str, partition_by: str | None = "date",
                audit: tuple[str, str] | None = None, load_prefix: str | None = None):
    """foreachBatch appending to a time-series table.

    Each micro-batch writes its own ``load=<prefix><batch id>`` directory with
    overwrite, so a batch re-delivered after a failure replaces its earlier
    output (exactly-once). With ``audit=(data_source, collection_type)`` the
    batch also writes its K07 audit row; the record count is observed during
    the write itself (no second pass over the batch)."""
    prefix = load_prefix if load_prefix is not None else f"{name}-"

    def write(batch: DataFrame, batch_id: int) -> None:
        load = f"{prefix}{batch_id}"
        if audit is None:
            append(batch, root, name, partition_by, load_id=load)
            return
        obs = Observation(f"{name}_{batch_id}")
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        append(batch.observe(obs, F.count(F.lit(1)).alias("rows")), root, name, partition_by, load_id=load)
        done = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = collection_log_row(batch.sparkSession, audit[0], audit[1], int(obs.get.get("rows", 0)),
                                 "success", started, done)
        append(row, root, "data_collection_log", load_id=load)
    return write


# ---------------------------------------------------------------- T03

def dedupe_stream(stream: DataFrame, event_col: str, key: list[str], delay: str = "2 hours") -> DataFrame:
    """Suppress re-delivered records by key within the watermark
    (state is bounded by the watermark delay)."""
    s = stream.withColumn("_event_ts", ntz_to_instant(event_col))
    return s.withWatermark("_event_ts", delay).dropDuplicatesWithinWatermark(key).drop("_event_ts")


# ---------------------------------------------------------------- T04 / T08

def hourly_usage_stream(usage: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Sessions and energy per station per tumbling hour. In append mode
    an hour is emitted once the watermark passes its end (late rows beyond
    the watermark are dropped by Spark and reported in the query progress as
    ``numRowsDroppedByWatermark``)."""
    u = usage.withColumn("_ts", ntz_to_instant("session_start")).withWatermark("_ts", delay)
    g = u.groupBy(F.window("_ts", "1 hour").alias("w"), "station_id").agg(
        F.count("id").alias("session_count"), F.sum("energy_consumed_kwh").alias("total_energy"))
    return g.select("station_id", instant_to_ntz("w.start").alias("hour"), "session_count", "total_energy")


def quota_counter_stream(log: DataFrame, delay: str = "1 day") -> DataFrame:
    """Calls per data source per calendar day (tumbling 1-day window),
    for update-mode output."""
    s = log.withColumn("_ts", ntz_to_instant("started_at")).withWatermark("_ts", delay)
    g = s.groupBy(F.window("_ts", "1 day").alias("w"), "data_source").agg(F.count(F.lit(1)).alias("calls"))
    return g.select(F.col("data_source").alias("service"), instant_to_ntz("w.start").alias("day"),
                    "calls", (F.col("calls") < 1000).alias("can_use"))


LONGEST_PERIOD = "31 days"


def quota_usage_stream(log: DataFrame, quotas: dict | None = None, grace_days: int = 1) -> DataFrame:
    """T08 with each service's own period (day or month) and limit, as D02
    has them; for update mode.

    The start of a call's period is the event time, and its watermark trails by
    the longest period and ``grace_days``: the period that is running is never
    late, however many later days other services have had, and the state of a
    period is dropped once it has been over for that long. The state is one row
    for each service and period within the watermark."""
    keyed = quota_periods(log, quotas).withColumn("_start", ntz_to_instant("period_start")) \
        .withWatermark("_start", f"{int(LONGEST_PERIOD.split()[0]) + grace_days} days")
    g = keyed.groupBy("service", "period", "_start", "quota_limit").agg(F.count(F.lit(1)).alias("calls"))
    return quota_columns(g.withColumn("period_start", instant_to_ntz("_start")))


# ---------------------------------------------------------------- T05

def weather_usage_stream(weather: DataFrame, usage: DataFrame, delay: str = "2 hours") -> DataFrame:
    """T05 as a stream–stream join: each weather observation with the usage of
    its station in the same hour, whichever arrives first. Usage is one row
    per station and hour (emitted when the watermark passes the hour), so no
    observation × session pairs are formed; both sides' state is dropped once
    the watermark has passed the hour."""
    hour = F.window("_ts", "1 hour").alias("_w")
    u = usage.withColumn("_ts", ntz_to_instant("session_start")).withWatermark("_ts", delay) \
        .groupBy("station_id", hour).agg(F.count("id").alias("session_count"),
                                         F.sum("energy_consumed_kwh").alias("total_energy"))
    w = weather.withColumn("_ts", ntz_to_instant("timestamp")).withWatermark("_ts", delay).withColumn("_w", hour)
    return w.join(u, ["station_id", "_w"]).withColumn("hour", instant_to_ntz("_w.start")).drop("_w", "_ts")


def weather_with_stored_usage(weather: DataFrame, hourly_usage: DataFrame) -> DataFrame:
    """Each streamed weather observation joined to the same-hour usage of its
    station as the stored hourly table (T04) has it when the micro-batch runs.
    An observation whose hour has no usage yet is not emitted, then or later;
    ``weather_usage_stream`` waits for late usage."""
    from voltgrid.functions.columns import hour_floor
    w = weather.withColumn("hour", hour_floor("timestamp"))
    return w.join(hourly_usage, ["station_id", "hour"])


# ---------------------------------------------------------------- T07

def score_stream(features: DataFrame, model) -> DataFrame:
    """Score new feature rows with a fitted isolation forest (broadcast
    model, stateless vectorised ``mapInPandas``)."""
    from voltgrid.operators.isolation_forest import score
    return score(model, features)


# ---------------------------------------------------------------- runner

def run_available_now(df: DataFrame, query_name: str, sink, checkpoint: str | None = None,
                      output_mode: str = "append"):
    """Start ``df`` with ``trigger(availableNow=True)`` into ``sink`` (a
    foreachBatch function or a format name) and wait for it to finish."""
    spark = df.sparkSession
    w = (df.writeStream.queryName(query_name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, query_name))
         .trigger(availableNow=True))
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    q = w.start()
    q.awaitTermination()
    return q
