"""Processed tables: partitioned writes, unions, look-ups by minute."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions import clock
from stopwise.plans.lineage import checkpointed
from stopwise.schemas import FEEDS, TABLE_SCHEMAS
from stopwise.sources import documents

_DATE = ["year", "month", "day"]


def write_by_date(
    df: DataFrame,
    path: str,
    epoch: str = "snapshot_timestamp",
    zone: str = clock.LONDON,
    mode: str = "append",
) -> None:
    """Write Parquet under ``year=/month=/day=`` of each row's own date in ``zone``.

    With ``mode="overwrite"`` only the dates in ``df`` are replaced. The rebalance
    lets Spark merge small tasks of one date and split a heavy date.
    """
    dated = df.withColumns(clock.partition_columns(epoch, zone)).hint("rebalance", *_DATE)
    (
        dated.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*_DATE)
        .parquet(path)
    )


def replace_range(
    df: DataFrame,
    path: str,
    start: int | None,
    end: int | None,
    epoch: str = "snapshot_timestamp",
    zone: str = clock.LONDON,
) -> None:
    """Write ``df``, the rows of ``start <= epoch <= end``, in place of the stored rows of that range.

    Only the dates the range begins or ends in hold other rows. They are copied
    before the dates are replaced. Dates of the range that get no row lose theirs.
    """
    spark = df.sparkSession
    days = [None if b is None else F.to_date(clock.local_time(F.lit(int(b)), zone)) for b in (start, end)]
    held = _date_folders(spark, path)
    if held and any(d is not None for d in days):
        folder = F.make_date(*[F.col(c).cast("int") for c in _DATE])
        outside = F.lit(False)
        if start is not None:
            outside = outside | (F.col(epoch) < F.lit(int(start)))
        if end is not None:
            outside = outside | (F.col(epoch) > F.lit(int(end)))
        stored = spark.read.option("mergeSchema", True).parquet(path)
        others = stored.filter(folder.isin(*[d for d in days if d is not None]) & outside).drop(*_DATE)
        df = df.unionByName(checkpointed(others), allowMissingColumns=True)
    write_by_date(df, path, epoch, zone, mode="overwrite")
    if held:
        least, most = (None if d is None else str(spark.range(1).select(d.cast("string")).first()[0]) for d in days)
        now = _date_folders(spark, path)
        fs_conf = spark._jsc.hadoopConfiguration()
        for date, (folder_path, files) in held.items():  # at most one a day
            inside = (least is None or date >= least) and (most is None or date <= most)
            if inside and now.get(date, (None, files))[1] == files:  # not written: a written date has new files
                old = spark._jvm.org.apache.hadoop.fs.Path(folder_path)
                old.getFileSystem(fs_conf).delete(old, True)


def _date_folders(spark: SparkSession, path: str) -> dict[str, tuple[str, frozenset[str]]]:
    """Folder and file names of each stored date (``YYYY-MM-DD``)."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for found in fs.globStatus(pattern) or []:
        folder = found.getPath()
        parts = [p.split("=")[1] for p in folder.toString().split("/")[-3:]]
        date = f"{int(parts[0]):04d}-{int(parts[1]):02d}-{int(parts[2]):02d}"
        out[date] = (folder.toString(), frozenset(f.getPath().getName() for f in fs.listStatus(folder)))
    return out


def read_dated(
    spark: SparkSession,
    path: str,
    start: int | None = None,
    end: int | None = None,
    zone: str = clock.LONDON,
    column: str = "snapshot_timestamp",
) -> DataFrame:
    """Read a table of :func:`write_by_date`, epoch range inclusive, other dates unread."""
    df = spark.read.parquet(path)
    return in_range(df, start, end, column, zone)


def in_range(
    df: DataFrame,
    start: int | None,
    end: int | None,
    column: str = "snapshot_timestamp",
    zone: str = clock.LONDON,
    slack_days: int = 0,
) -> DataFrame:
    """Rows with ``start <= column <= end``; also limits the date folders read.

    ``slack_days`` widens the folders read, for a ``column`` other than the one the
    folders follow.
    """
    dated = set(_DATE) <= set(df.columns)
    folder = F.make_date(*[F.col(c).cast("int") for c in _DATE]) if dated else None
    for bound, low in ((start, True), (end, False)):
        if bound is None:
            continue
        limit = F.lit(int(bound))
        df = df.filter(F.col(column) >= limit if low else F.col(column) <= limit)
        if dated:
            day = F.to_date(clock.local_time(limit, zone))
            near = folder >= F.date_sub(day, slack_days) if low else folder <= F.date_add(day, slack_days)
            df = df.filter(near)
    return df


def at_minute(df: DataFrame, minute: int, zone: str = clock.LONDON) -> DataFrame:
    """The rows of one snapshot minute.

    The minute is the file name's, the folders follow the header, so those of the
    days before and after are read as well.
    """
    return in_range(df, minute, minute, "snapshot_minute", zone, slack_days=1)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def load_feeds(
    spark: SparkSession,
    root: str,
    feeds: Sequence[str] = FEEDS,
    output: str | None = None,
) -> DataFrame:
    """All rows of the chosen feeds with ``feed_type``; feeds without a folder are skipped."""
    tables = {
        feed: spark.read.parquet(f"{root}/{feed}")
        for feed in feeds
        if exists(spark, f"{root}/{feed}")
    }
    if not tables:
        empty = {feed: spark.createDataFrame([], TABLE_SCHEMAS[feed]) for feed in feeds}
        return union_feeds(empty)
    combined = union_feeds(tables)
    if output is not None:
        combined.write.mode("overwrite").option("compression", "snappy").parquet(output)
    return combined


def union_feeds(tables: dict[str, DataFrame]) -> DataFrame:
    """Feeds on top of each other; a column a feed lacks is null there."""
    tagged = [df.withColumn("feed_type", F.lit(feed)) for feed, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def snapshot_minutes(manifest: DataFrame, feed: str = "trip_updates") -> DataFrame:
    """Distinct observed minutes of a feed."""
    return (
        manifest.filter((F.col("feed") == feed) & F.col("snapshot_minute").isNotNull())
        .select("snapshot_minute")
        .distinct()
    )


def paired_minutes(manifest: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every minute of the trip-update or vehicle feed, and which of the two it has."""
    key = [*scope, "snapshot_minute"]

    def has(feed: str) -> Column:
        return F.max((F.col("feed") == feed).cast("int"))

    return (
        manifest.filter(F.col("feed").isin("trip_updates", "vehicle_positions"))
        .groupBy(*key)
        .agg(
            has("trip_updates").alias("has_trip_updates"),
            has("vehicle_positions").alias("has_vehicle_positions"),
            F.sum(F.when(F.col("feed") == "vehicle_positions", F.col("n_rows"))).alias(
                "n_vehicles"
            ),
        )
        .withColumn(
            "status",
            F.when(F.col("has_trip_updates") == 0, "trip_updates missing")
            .when(F.col("has_vehicle_positions") == 0, "vehicle_positions missing")
            .when(F.col("n_vehicles") == 0, "vehicle_positions empty")
            .otherwise("complete"),
        )
    )


def usable_minutes(manifest: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Minutes that have a file of both feeds; an empty vehicle file is enough."""
    pairs = paired_minutes(manifest, scope)
    both = (F.col("has_trip_updates") == 1) & (F.col("has_vehicle_positions") == 1)
    return pairs.filter(both).select(*scope, "snapshot_minute")


def ingest_feeds(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    feeds: Sequence[str] = FEEDS,
    start: str | None = None,
    end: str | None = None,
    scope: dict[str, str] | None = None,
    minute_rule: str = "file",
) -> dict[str, int]:
    """Flatten the raw files of each feed into dated tables, a manifest and rejects.

    Returns the number of rejected records of this run per feed. A file that was read
    before, by its name and ``scope``, takes the place of what it left then; a folder
    keeps to one set of scope columns. ``minute_rule`` is that of
    :func:`documents.with_snapshot_minute`. The manifest is written first, so that a run
    that broke off is found there and repeated safely.
    """
    lost, key = {}, ["file_name", *(scope or {})]
    for feed in feeds:
        glob = documents.find_feed_files(spark, raw_root, feed)
        if glob is None:
            continue
        docs = documents.read_documents(spark, glob, feed, start, end, minute_rule)
        for name, value in (scope or {}).items():
            docs = docs.withColumn(name, F.lit(value))
        seen = checkpointed(documents.manifest(docs, feed))
        before = _replace_seen(seen, f"{out_root}/manifest", feed, key)
        rows, path, again = documents.flatten(docs, feed), f"{out_root}/{feed}", before is not None
        if before is not None:
            _replace_files(rows, path, seen, key, before)
        else:
            write_by_date(rows, path)
        lost[feed] = seen.agg(F.coalesce(F.sum(F.col("n_rejected") + F.col("unreadable")), F.lit(0))).first()[0]
        _replace_rejects(documents.rejected(docs, feed), f"{out_root}/rejected/{feed}", seen.select(*key), key, again, lost[feed])
    return lost


def _stored(spark: SparkSession, path: str, merge: bool = True) -> DataFrame | None:
    """What ``path`` holds. With ``merge`` the files' columns are put together, which opens every footer."""
    some = any(documents.matches(spark, f"{path}/{p}") for p in ("*=*", "part-*"))
    return spark.read.option("mergeSchema", merge).parquet(path) if some else None


def _dates(df: DataFrame, epoch: str) -> set[date]:
    """London dates of ``epoch``; at most one a day."""
    day = F.make_date(*[c.cast("int") for c in clock.partition_columns(epoch, clock.LONDON).values()])
    return {r[0] for r in df.filter(F.col(epoch).isNotNull()).select(day).distinct().collect()}


def _replace_seen(seen: DataFrame, path: str, feed: str, key: Sequence[str]) -> set[date] | None:
    """Put the documents of a run into the manifest.

    Returns the dates of those that were there already, or ``None`` without such ones.
    """
    stored = _stored(seen.sparkSession, path)
    known = stored.filter(F.col("feed") == feed) if stored is not None else None
    names = seen.select(*key)
    writer, before = seen.write.mode("append"), None
    if known is not None and set(key) <= set(known.columns):
        earlier = checkpointed(known.join(names, list(key), "left_semi"))
        before = None if earlier.isEmpty() else _dates(earlier, "header_timestamp")
    if before is not None:
        others = checkpointed(known.join(names, list(key), "left_anti"))
        both = others.unionByName(seen, allowMissingColumns=True)
        writer = both.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("feed").parquet(path)
    return before


def _replace_files(rows: DataFrame, path: str, seen: DataFrame, key: Sequence[str], before: set[date]) -> None:
    """Write ``rows`` in place of all stored rows of the files ``seen``.

    Rows are stored by the header's date, which the manifest has: only the dates
    ``before`` and those of ``seen`` are read and written again.
    """
    spark = rows.sparkSession
    stored = _stored(spark, path, merge=False)
    if stored is None or not set(key) <= set(stored.columns):
        write_by_date(rows, path)
        return
    now = _dates(seen.filter("n_rows > 0"), "header_timestamp")
    touched = before | now
    held = stored.filter(F.make_date(*[F.col(c).cast("int") for c in _DATE]).isin(*touched)) if touched else stored.limit(0)
    others = checkpointed(held.join(seen.select(*key), list(key), "left_anti").drop(*_DATE))
    write_by_date(rows.unionByName(others, allowMissingColumns=True), path, mode="overwrite")
    for day in touched - now - _dates(others, "snapshot_timestamp"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _replace_rejects(bad: DataFrame, path: str, names: DataFrame, key: Sequence[str], again: bool, count: int) -> None:
    stored = _stored(bad.sparkSession, path) if again else None
    if stored is not None and set(key) <= set(stored.columns):
        others = checkpointed(stored.join(names, list(key), "left_anti"))
        others.unionByName(bad, allowMissingColumns=True).write.mode("overwrite").parquet(path)
    elif count:
        bad.write.mode("append").parquet(path)


def replay_batches(
    df: DataFrame,
    batch_size: int,
    start: int | None = None,
    end: int | None = None,
    order: Sequence[str] = ("snapshot_timestamp",),
) -> DataFrame:
    """Add ``batch_id``: rows in time order, ``batch_size`` rows to a batch.

    ``order`` starts with the time and should go on with columns that settle ties.
    Spark samples the whole order to split it evenly, so one crowded second is
    split as well. The split is written out, which fixes it; its parts are
    numbered on their own and their sizes give the offsets.
    """
    from stopwise.operators.ordered import with_position

    chosen = in_range(df, start, end, order[0])
    parts = checkpointed(chosen.repartitionByRange(*order)).withColumn(
        "_chunk", F.spark_partition_id()
    )
    numbered = with_position(parts, [], "_chunk", list(order), "position")
    return numbered.withColumn(
        "batch_id", F.floor((F.col("position") - 1) / batch_size)
    ).drop("_chunk")
