"""Raw files into flat tables as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopwise.functions import clock
from stopwise.schemas import FEEDS
from stopwise.sources import documents


def stream_texts(
    spark: SparkSession, raw_root: str, feeds: Sequence[str], max_files: int | None = None
) -> DataFrame:
    """New raw files of the feeds' folders, one row each: feed, file name and text."""
    reader = spark.readStream.format("text").option("wholetext", True)
    reader = reader.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listed = "{" + ",".join(feeds) + "}"
    files = reader.load(f"{raw_root}/{listed}").select(
        F.col("value").alias("body"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
    )
    feed = F.element_at(F.split("file_path", "/"), -2)
    return files.select("body", "file_name", feed.alias("feed"))


def feed_documents(texts: DataFrame, feed: str, minute_rule: str = "file") -> DataFrame:
    """Parsed documents of one feed out of :func:`stream_texts` rows."""
    mine = texts.filter(F.col("feed") == feed).select("body", "file_name")
    parsed = documents.parse_documents(mine, "body", feed)
    return documents.with_snapshot_minute(parsed, minute_rule)


def ingest_stream(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    checkpoint: str,
    feeds: Sequence[str] = FEEDS,
    max_files: int | None = None,
    trigger: dict | None = None,
    minute_rule: str = "file",
) -> StreamingQuery:
    """Keep the flat tables and the manifest of ``out_root`` up to date.

    Each micro-batch owns its ``ingest_batch`` folder, so a repeated batch replaces
    its own rows and no others.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for feed in feeds:
            docs = feed_documents(batch, feed, minute_rule)
            rows = documents.flatten(docs, feed).withColumns(
                {**clock.partition_columns("snapshot_timestamp"), "ingest_batch": F.lit(batch_id)}
            )
            _replace(rows, f"{out_root}/{feed}", ["ingest_batch", "year", "month", "day"])
            seen = documents.manifest(docs, feed).withColumn("ingest_batch", F.lit(batch_id))
            _replace(seen, f"{out_root}/manifest", ["feed", "ingest_batch"])

    stream = stream_texts(spark, raw_root, feeds, max_files).writeStream.foreachBatch(write)
    return (
        stream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _replace(df: DataFrame, path: str, parts: list[str]) -> None:
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def replay_stream(
    spark: SparkSession, path: str, schema, max_files: int = 1
) -> DataFrame:
    """A Parquet table as a stream, ``max_files`` files to a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
