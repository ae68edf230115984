"""Writes of the canonical tables, audit rows, CSV export and
referential integrity.

Storage is plain parquet (no table format with MERGE is installed):
- append-only tables (usage, weather, traffic, anomalies, features, energy,
  audit) are written with ``mode('append')``, time series partitioned by
  ``date`` so date filters prune directories;
- upserted tables (stations, points) are partitioned by a bucket, a hash of
  the key. A batch reads and rewrites the buckets that hold its keys and no
  other, by Spark's dynamic partition overwrite. Every stored row carries the
  query and the batch that wrote it, so the data itself says whether a batch
  has been merged; there is no history to read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.schemas import DDL, conform, schema
from voltgrid.session import checkpoint_dir
from voltgrid.sources.tables import read_if_there

# ------------------------------------------------------------------ K01/K02


def latest_by_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """Keep, per key, the row that is greatest by ``order_by`` (last write
    wins). Implemented as a ``max_by`` aggregate rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding
    a third of all rows costs one partial row per task instead of sorting
    that third in a single window partition. Rows that tie are ordered by a
    hash of the whole row and then by the row, so the winner doesn't depend on
    the order of arrival."""
    cols = [c for c in df.columns]
    order = F.struct(*[F.col(c) for c in order_by], F.xxhash64(*cols).alias("_hash"),
                     *[F.col(c).alias(f"_tie_{c}") for c in cols])
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"))
    return agg.select("_row.*")


def upsert_frame(target: DataFrame, batch: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """K01/K02 as a DataFrame: insert or replace by ``key``; among equal
    ``order_by`` values the batch wins (it is written later)."""
    t = target.withColumn("_seq", F.lit(0))
    b = batch.withColumn("_seq", F.lit(1))
    u = t.unionByName(b, allowMissingColumns=True)
    return latest_by_key(u, key, [*order_by, "_seq"]).drop("_seq")


BUCKETS = 64              # of an upserted table, fixed for its life; more for a larger one
PROVENANCE = "_query string, _batch bigint"


def bucket_of(key: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def merge_batch(stored: DataFrame, incoming: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """K01/K02 with provenance (``_query``, ``_batch``): per key the stored
    row, or the incoming one if there is none stored or it is not older. A
    batch that is delivered again meets rows of its own query that are of the
    same batch or a later one, and leaves them as they are. One aggregate: a
    hot key costs a partial row per task."""
    cols = stored.columns
    union = stored.withColumn("_new", F.lit(False)).unionByName(incoming.select(*cols).withColumn("_new", F.lit(True)))
    order = F.struct(*[F.col(c).alias(f"o_{c}") for c in order_by])
    full = F.struct(order.alias("order"), F.xxhash64(*cols).alias("hash"), *[F.col(c).alias(f"t_{c}") for c in cols])
    row = F.struct(order.alias("order"), F.struct(*cols).alias("row"))
    agg = union.groupBy(*key).agg(F.max_by(row, F.when(~F.col("_new"), full)).alias("old"),
                                  F.max_by(row, F.when(F.col("_new"), full)).alias("new"))
    merged_before = F.col("old.row._query").eqNullSafe(F.col("new.row._query")) \
        & (F.col("old.row._batch") >= F.col("new.row._batch"))
    keep = F.col("new").isNull() | (F.col("old").isNotNull() & (
        F.coalesce(merged_before, F.lit(False)) | (F.col("old.order") > F.col("new.order"))))
    return agg.select(F.when(keep, F.col("old.row")).otherwise(F.col("new.row")).alias("r")).select("r.*")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_if_there(spark, f"{DDL[name]}, {PROVENANCE}, bucket int", f"{root}/{name}")


def read_upserted(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The content of an upserted table; empty before the first upsert."""
    return conform(_stored(spark, root, name), name)


def upsert(spark: SparkSession, root: str, name: str, batch: DataFrame, key: list[str],
           order_by: list[str], version: str, batch_id: int = 0, buckets: int = BUCKETS) -> None:
    """Merge ``batch`` into table ``name``. ``version`` and
    ``batch_id`` name the batch (a cycle's stamp; a query's id and its batch
    number). The batch is reduced to one row per key and checkpointed, so its
    source is read once; the buckets it touches (``buckets`` numbers at most)
    prune the scan of the table and are all that is written. The new files are
    complete before the old ones of any bucket go, so a job that fails, or loses
    its executors, leaves the table as it was; running the batch again merges
    what is missing and changes nothing else. Swapping the files in is Spark's
    commit: a driver that dies within it may leave some buckets new, some old."""
    checkpoint_dir(spark)
    incoming = latest_by_key(conform(batch, name), key, order_by).withColumns({
        "_query": F.lit(version), "_batch": F.lit(batch_id).cast("bigint"), "bucket": bucket_of(key, buckets)}).checkpoint()
    touched = [r["bucket"] for r in incoming.select("bucket").distinct().collect()]
    if not touched:
        return
    stored = _stored(spark, root, name).where(F.col("bucket").isin(touched))
    merged = merge_batch(stored, incoming, ["bucket", *key], order_by)
    (merged.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(f"{root}/{name}"))


# ------------------------------------------------------------------ K03–K10


def with_serial_id(df: DataFrame) -> DataFrame:
    """Fill a missing surrogate ``id`` (the database's SERIAL) with a stable
    content hash of the row's other columns: the same row gets the same id
    on every run and every executor (``monotonically_increasing_id`` would
    not), so retried loads stay idempotent."""
    if "id" not in df.columns or dict(df.dtypes)["id"] != "bigint":
        return df
    others = [F.col(c) for c in df.columns if c != "id"]
    return df.withColumn("id", F.coalesce(F.col("id"), F.xxhash64(*others)))


def append(df: DataFrame, root: str, name: str, partition_by: str | None = None,
           load_id: str | None = None) -> None:
    """K10 (and K04, K05, K08, K09): conform to the table schema and append.
    Time series pass ``partition_by='date'``.

    With ``load_id`` (a cycle stamp or a streaming batch id) the rows go to
    their own ``load=<id>`` directory, written with overwrite: re-running the
    same load after a failure replaces its earlier output instead of
    duplicating it (exactly-once per load). Readers see ``load`` as a
    partition column; ``conform`` drops it."""
    out = with_serial_id(conform(df, name))
    ts_col = {"weather_data": "timestamp", "traffic_data": "timestamp", "usage_data": "session_start",
              "anomaly_detection": "detected_at"}.get(name)
    if partition_by == "date" and "date" not in out.columns and ts_col:
        out = out.withColumn("date", F.to_date(ts_col))
    w = out.write.mode("overwrite" if load_id is not None else "append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{root}/{name}" if load_id is None else f"{root}/{name}/load={load_id}")


def prepare_weather_rows(df: DataFrame) -> DataFrame:
    """Humidity and UV index are stored truncated to whole numbers."""
    out = conform(df, "weather_data")
    return out.withColumn("humidity_percent", F.col("humidity_percent").cast("int").cast("decimal(5,2)")) \
              .withColumn("uv_index", F.col("uv_index").cast("int").cast("decimal(3,1)"))


def prepare_anomaly_rows(df: DataFrame) -> DataFrame:
    """``is_resolved`` defaults to false."""
    out = conform(df, "anomaly_detection")
    return out.withColumn("is_resolved", F.coalesce(F.col("is_resolved"), F.lit(False)))


def collection_log_row(spark: SparkSession, source: str, collection_type: str, records: int,
                       status: str, started_at: _dt.datetime, completed_at: _dt.datetime,
                       error: str | None = None) -> DataFrame:
    """One audit row for a load, with the job's real start and end.
    ``records`` comes from the load's own metrics (``DataFrame.observe``),
    not from a second pass over the data."""
    row = [(None, source, collection_type, int(records), status, error, started_at, completed_at, None)]
    return spark.createDataFrame(row, schema("data_collection_log"))


# ------------------------------------------------------------------ K11

CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"   # ISO text with microseconds


def export_csv(df: DataFrame, directory: str, name: str) -> bool:
    """Header, minimal quoting with ``"`` escaped by doubling, NULL as an
    empty field, nested values as JSON text. Empty input writes nothing and
    returns False. Executors write part files (no ``coalesce(1)``)."""
    if df.isEmpty():
        return False

    def render(f):
        c = F.col(f.name)
        if f.dataType.typeName() in ("array", "map", "struct"):
            return F.to_json(c).alias(f.name)
        if f.dataType.typeName() == "boolean":       # Python text form, as the exports carry
            return F.when(c, F.lit("True")).when(~c, F.lit("False")).alias(f.name)
        return c
    out = df.select(*[render(f) for f in df.schema.fields])
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"')
        .option("emptyValue", "").option("nullValue", "")
        .option("timestampNTZFormat", CSV_TIMESTAMP).option("timestampFormat", CSV_TIMESTAMP)
        .csv(f"{directory}/{name}"))
    return True


# ------------------------------------------------------------------ K12


def orphans(child: DataFrame, parent: DataFrame, child_key: str = "station_id",
            parent_key: str = "id") -> DataFrame:
    """Child rows whose parent does not exist (``left_anti``; rows with a
    NULL key are orphans too, as a foreign key would reject them)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def cascade_delete(tables, station_ids: DataFrame):
    """Remove stations and, as ``ON DELETE CASCADE`` would, all their
    children. ``station_ids`` is a one-column frame (``id``)."""
    from voltgrid.sources.tables import Tables
    ids = station_ids.select(F.col("id").alias("_gone")).distinct()

    def drop(df, col):
        return df.join(ids, df[col] == ids["_gone"], "left_anti")
    return Tables(stations=drop(tables.stations, "id"), points=drop(tables.points, "station_id"),
                  usage=drop(tables.usage, "station_id"), weather=drop(tables.weather, "station_id"),
                  traffic=drop(tables.traffic, "station_id"), anomalies=drop(tables.anomalies, "station_id"),
                  log=tables.log,
                  energy=None if tables.energy is None else drop(tables.energy, "station_id"))
