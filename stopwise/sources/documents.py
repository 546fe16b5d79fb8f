"""Raw feed documents: finding the files, reading them, flattening them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.functions import clock
from stopwise.schemas import DOCUMENT_SCHEMAS, TABLE_SCHEMAS

_CORRUPT = "_corrupt"

# Name patterns tried at the root when a feed has no folder of its own.
_LOOSE_NAMES = {
    "alerts": "*alert*.json",
    "trip_updates": "*trip_update*.json",
    "vehicle_positions": "*vehicle*position*.json",
}


def matches(spark: SparkSession, pattern: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def _with_corrupt(feed: str) -> T.StructType:
    return T.StructType([*DOCUMENT_SCHEMAS[feed], T.StructField(_CORRUPT, T.StringType())])


def find_feed_files(spark: SparkSession, raw_root: str, feed: str) -> str | None:
    """Glob of the files of ``feed``: its folder first, then names at the root."""
    candidates = (
        f"{raw_root}/{feed}/*.json",
        f"{raw_root}/*{feed}*.json",
        f"{raw_root}/{_LOOSE_NAMES[feed]}",
    )
    return next((c for c in candidates if matches(spark, c)), None)


def _bound(spark: SparkSession, text: str) -> Column:
    parsed = clock.parse_time(F.lit(text))
    if spark.range(1).select(parsed.isNull()).first()[0]:
        raise ValueError(f"Invalid datetime format: {text}")
    return parsed


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    feed: str,
    start: str | None = None,
    end: str | None = None,
    minute_rule: str = "file",
) -> DataFrame:
    """One row per raw file with its name; ``start`` and ``end`` select by name, inclusive.

    A bound that no day-first format matches raises ``ValueError``.
    Files are selected before their bodies are read: the condition only uses file
    metadata, which Spark applies when it lists the files.
    """
    schema = _with_corrupt(feed)
    docs = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(paths)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    stamp = clock.file_time(F.col("file_name"))
    if start is not None:
        docs = docs.filter(stamp >= _bound(spark, start))
    if end is not None:
        docs = docs.filter(stamp <= _bound(spark, end))
    return with_snapshot_minute(docs, minute_rule)


def parse_documents(df: DataFrame, text: str, feed: str) -> DataFrame:
    """Turn a column of document texts into the same shape as :func:`read_documents`."""
    schema = _with_corrupt(feed)
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    others = [c for c in df.columns if c != text]
    return df.select(*others, parsed.alias("_doc")).select(*others, "_doc.*")


def with_snapshot_minute(docs: DataFrame, minute_rule: str = "file") -> DataFrame:
    """Add ``snapshot_minute``: the minute of the file name, or of the header.

    The name's minute is London wall time. A name that cannot be read falls back
    to the header.
    """
    header = F.col("header.timestamp")
    of_header = header - F.pmod(header, F.lit(60))
    if minute_rule not in ("file", "header"):
        raise ValueError(f"Unknown minute rule: {minute_rule}")
    if minute_rule == "header":
        return docs.withColumn("snapshot_minute", of_header)
    stamp = clock.file_time(F.col("file_name"))
    named = clock.epoch_of_local(stamp, clock.LONDON)
    return docs.withColumn(
        "snapshot_minute", F.coalesce(named - F.pmod(named, F.lit(60)), of_header)
    )


def _passed_through(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in {"header", "entity", _CORRUPT}]


def _entities(docs: DataFrame, member: str) -> DataFrame:
    return docs.select(
        *_passed_through(docs),
        F.col("header.timestamp").alias("snapshot_timestamp"),
        F.explode("entity").alias("e"),
    ).filter(F.col(f"e.{member}").isNotNull())


def _all_present(columns: list[str]) -> Column:
    ok = F.lit(True)
    for name in columns:
        ok = ok & F.col(name).isNotNull()
    return ok


# Columns a flat row cannot do without.
_REQUIRED = {
    "alerts": ["snapshot_timestamp", "alert_entity_id"],
    "trip_updates": [
        "snapshot_timestamp",
        "trip_id",
        "route_id",
        "start_time",
        "start_date",
        "stop_sequence",
        "stop_id",
    ],
    "vehicle_positions": ["snapshot_timestamp"],
}


def _trip_update_rows(docs: DataFrame) -> DataFrame:
    keep = _passed_through(docs)
    stops = _entities(docs, "trip_update").select(
        *keep,
        "snapshot_timestamp",
        F.col("e.trip_update.trip").alias("trip"),
        F.col("e.trip_update.vehicle.id").alias("vehicle_id"),
        F.explode("e.trip_update.stop_time_update").alias("s"),
    )
    return stops.select(
        *keep,
        "snapshot_timestamp",
        "trip.trip_id",
        "trip.route_id",
        F.coalesce("trip.direction_id", F.lit(0)).alias("direction_id"),
        "trip.start_time",
        "trip.start_date",
        "vehicle_id",
        "s.stop_sequence",
        "s.stop_id",
        F.col("s.arrival.time").alias("arrival_time"),
        F.col("s.departure.time").alias("departure_time"),
        F.coalesce("s.arrival.delay", F.lit(0.0)).cast("int").alias("arrival_delay"),
        F.coalesce("s.departure.delay", F.lit(0.0)).cast("int").alias("departure_delay"),
    )


def _vehicle_rows(docs: DataFrame) -> DataFrame:
    keep = _passed_through(docs)
    v = "e.vehicle"
    return (
        _entities(docs, "vehicle")
        .filter(F.to_json(v) != "{}")
        .select(
            *keep,
            "snapshot_timestamp",
            f"{v}.trip.trip_id",
            f"{v}.trip.route_id",
            f"{v}.trip.direction_id",
            F.col(f"{v}.vehicle.id").alias("vehicle_id"),
            f"{v}.position.latitude",
            f"{v}.position.longitude",
            f"{v}.position.bearing",
            f"{v}.position.speed",
            f"{v}.current_stop_sequence",
            f"{v}.current_status",
            f"{v}.stop_id",
            f"{v}.congestion_level",
            f"{v}.occupancy_status",
        )
    )


def _joined_text(field: str) -> Column:
    texts = F.transform(f"a.{field}.translation", lambda t: F.coalesce(t["text"], F.lit("")))
    return F.coalesce(F.array_join(texts, " "), F.lit("")).alias(field)


def _alert_rows(docs: DataFrame) -> DataFrame:
    keep = _passed_through(docs)
    # No list of periods means one open period; an empty list means none.
    open_period = F.array(F.lit(None).cast("struct<start:bigint,end:bigint>"))
    return (
        _entities(docs, "alert")
        .select(
            *keep,
            "snapshot_timestamp",
            F.col("e.id").alias("alert_entity_id"),
            F.col("e.alert").alias("a"),
        )
        .withColumn("p", F.explode(F.coalesce("a.active_period", open_period)))
        .withColumn("i", F.explode("a.informed_entity"))
        .select(
            *keep,
            "snapshot_timestamp",
            "alert_entity_id",
            F.col("p.start").alias("active_period_start"),
            F.col("p.end").alias("active_period_end"),
            "i.agency_id",
            "i.route_id",
            "i.direction_id",
            "a.cause",
            "a.effect",
            _joined_text("header_text"),
            _joined_text("description_text"),
            F.get("a.url.translation", F.lit(0))["text"].alias("url"),
        )
    )


_ROWS = {
    "alerts": _alert_rows,
    "trip_updates": _trip_update_rows,
    "vehicle_positions": _vehicle_rows,
}


def flatten(docs: DataFrame, feed: str) -> DataFrame:
    """Flat, typed rows of ``feed``; rows without a required field are left out."""
    rows = _ROWS[feed](docs)
    extra = [c for c in rows.columns if c not in TABLE_SCHEMAS[feed].names]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLE_SCHEMAS[feed]]
    return rows.filter(_all_present(_REQUIRED[feed])).select(*extra, *typed)


def rejected(docs: DataFrame, feed: str) -> DataFrame:
    """Rows :func:`flatten` leaves out, and documents that are not readable."""
    rows = _ROWS[feed](docs).filter(~_all_present(_REQUIRED[feed]))
    keep = _passed_through(docs)
    lost = rows.select(
        *keep, F.to_json(F.struct(*[c for c in rows.columns if c not in keep])).alias("record")
    )
    unread = docs.filter(F.col(_CORRUPT).isNotNull()).select(*keep, F.col(_CORRUPT).alias("record"))
    return lost.unionByName(unread)


def manifest(docs: DataFrame, feed: str) -> DataFrame:
    """One row per document: that it was seen, its minutes and its row counts.

    An empty document leaves no flat row but still marks its minute as observed.
    """
    keep = _passed_through(docs)
    rows = _ROWS[feed](docs).groupBy(*keep).agg(
        F.count_if(_all_present(_REQUIRED[feed])).alias("n_rows"),
        F.count_if(~_all_present(_REQUIRED[feed])).alias("n_rejected"),
    )
    seen = docs.select(
        *keep,
        F.col("header.timestamp").alias("header_timestamp"),
        F.col(_CORRUPT).isNotNull().cast("int").alias("unreadable"),
    )
    same = None
    right = rows.select(*[F.col(c).alias(f"_r_{c}") for c in keep], "n_rows", "n_rejected")
    for c in keep:
        test = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        same = test if same is None else same & test
    return seen.join(right, same, "left").select(
        F.lit(feed).alias("feed"),
        *keep,
        "header_timestamp",
        "unreadable",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
    )
