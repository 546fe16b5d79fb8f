"""Station features minute by minute, with the batch code and a carried state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopwise.config import FeatureConfig
from stopwise.functions import clock
from stopwise.operators import station, vehicles
from stopwise.plans.features import Carry, Network, feature_tables
from stopwise.sources import documents, tables
from stopwise.streaming.ingest import feed_documents, stream_texts
from stopwise.streaming.runs import StateFolder

_FEEDS = ("trip_updates", "vehicle_positions")


def next_carry(result, cfg: FeatureConfig) -> Carry:
    """What the minutes after ``result`` need; bounded per stop and per scope."""
    histories = vehicles.lag_histories(result.lags, cfg)
    newest = F.max_by(F.struct("snapshot_minute", "history"), F.col("snapshot_minute"))
    lags = (
        histories.groupBy(*cfg.scope)
        .agg(newest.alias("h"))
        .filter("h IS NOT NULL")
        .select(*cfg.scope, "h.snapshot_minute", F.col("h.history").alias("lags"))
    )
    return Carry(rows=station.carry_rows(result.rolled, cfg), lags=lags)


class FeatureStream:
    """The foreachBatch step that turns raw files into feature rows.

    Minutes are closed once ``allowed_lateness`` seconds newer files have been
    seen. A closed minute is not opened again; files for it are set aside under
    ``late``, files without a minute or without readable text under ``rejected``.
    So every file read is in a closed minute, pending, late or rejected.

    A step's output carries its number: twice the number of the micro-batch, or one
    more for a flush after it. The number is entered in the ``ledger`` once the
    step is complete, for readers that must not take a step twice.
    """

    def __init__(
        self,
        spark: SparkSession,
        stops: DataFrame,
        out_path: str,
        state_path: str,
        cfg: FeatureConfig = FeatureConfig(),
        allowed_lateness: int = 120,
    ) -> None:
        self.spark = spark
        self.network = Network.from_stops(stops, cfg)
        self.out_path = out_path
        self.state = StateFolder(spark, state_path)
        self.cfg = cfg
        self.allowed_lateness = allowed_lateness

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch.select("body", "file_name", "feed"), 2 * batch_id, self.allowed_lateness)

    def flush(self) -> None:
        """Close every minute seen so far."""
        last = self.state.latest()
        if last is not None:
            nothing = self.state.table(last, "pending").drop("minute").limit(0)
            self._step(nothing, last | 1, 0)  # after a flush, the same number again

    def _step(self, texts: DataFrame, batch_id: int, lateness: int) -> None:
        cfg = self.cfg
        before = self.state.before(batch_id)
        known = {"closed": None, "seen": None}
        timed = self._timed(texts)
        reason = F.when(F.expr("try_parse_json(body)").isNull(), "unreadable").when(F.col("minute").isNull(), "no minute")
        refused = timed.withColumn("reason", reason).filter("reason IS NOT NULL")
        refused.write.mode("overwrite").parquet(f"{self.out_path}/rejected/batch_id={batch_id}")
        timed = timed.filter(reason.isNull())
        carry = None
        if before is not None:
            known = self.state.meta(before)
            timed = timed.unionByName(self.state.table(before, "pending"))
            if known["closed"] is not None:
                carry = Carry(
                    rows=self.state.table(before, "rows"), lags=self.state.table(before, "lags")
                )
        # The batch is read by several branches below.
        timed = timed.persist()
        try:
            newest = timed.agg(F.max("minute")).first()[0]
            seen = max((x for x in (newest, known["seen"]) if x is not None), default=None)
            until = None if seen is None else seen - lateness
            self._close(timed, batch_id, known["closed"], seen, until, carry)
        finally:
            timed.unpersist()

    @staticmethod
    def _timed(texts: DataFrame) -> DataFrame:
        """Add the minute of each document, from its name or its header."""
        header = F.get_json_object("body", "$.header.timestamp").try_cast("long")
        docs = documents.with_snapshot_minute(
            texts.withColumn("header", F.struct(header.alias("timestamp")))
        )
        return docs.drop("header").withColumnRenamed("snapshot_minute", "minute")

    def _close(self, timed, batch_id, closed, seen, until, carry) -> None:
        cfg = self.cfg
        ready = timed.filter(F.col("minute") <= F.lit(until).cast("long"))
        pending = timed.filter(F.col("minute") > F.lit(until).cast("long"))
        if closed is not None:
            late = ready.filter(F.col("minute") <= closed)
            late.write.mode("overwrite").parquet(f"{self.out_path}/late/batch_id={batch_id}")
            ready = ready.filter(F.col("minute") > closed)
        docs = {feed: feed_documents(ready, feed) for feed in _FEEDS}
        rows = {feed: documents.flatten(d, feed) for feed, d in docs.items()}
        manifest = tables.union_feeds(
            {feed: d.select("snapshot_minute").distinct() for feed, d in docs.items()}
        ).select("snapshot_minute", F.col("feed_type").alias("feed"), F.lit(1).alias("n_rows"))
        minutes = tables.usable_minutes(manifest, cfg.scope)
        usable = {
            feed: df.join(minutes, cfg.minute_key, "left_semi") for feed, df in rows.items()
        }
        result = feature_tables(
            usable["trip_updates"], usable["vehicle_positions"], minutes, self.network, cfg, carry
        )
        dated = result.features.withColumns(
            clock.partition_columns("snapshot_timestamp", "UTC")
        )
        dated.write.mode("overwrite").partitionBy("year", "month", "day").parquet(
            f"{self.out_path}/features/batch_id={batch_id}"
        )
        kept = next_carry(result, cfg)
        done = max((x for x in (closed, until) if x is not None), default=None)
        self.state.write(
            batch_id,
            {"rows": kept.rows, "lags": kept.lags, "pending": pending},
            {"closed": done, "seen": seen},
        )
        self.spark.range(1).select(F.lit(batch_id).cast("long").alias("number")).coalesce(1).write.mode("overwrite").json(
            f"{self.out_path}/ledger/step={batch_id}"
        )
        self.state.forget(batch_id)


def feature_stream(
    spark: SparkSession,
    raw_root: str,
    step: FeatureStream,
    checkpoint: str,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``step`` on the trip-update and vehicle files under ``raw_root``."""
    texts = stream_texts(spark, raw_root, _FEEDS, max_files)
    return (
        texts.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
