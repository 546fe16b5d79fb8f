"""Vehicle presence per stop and the adaptive age limits of the feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import FeatureConfig
from stopwise.functions.arrays import last_items, sorted_quantile
from stopwise.operators.ordered import with_last_known, with_position

_DAY = 86400
_BLOCK = 1440


def latest_vehicles(vp: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Newest vehicle row per minute, stop and direction.

    The age limit bounds the newest row from below, so it is tested later on this
    one row instead of on every vehicle row.
    """
    texts = [
        (F.col(c) if c in vp.columns else F.lit(None)).cast("string").alias(c)
        for c in ("congestion_level", "occupancy_status")
    ]
    newest = F.max(F.struct("snapshot_timestamp", *texts))
    return (
        vp.filter(F.col("snapshot_timestamp") <= F.col("snapshot_minute"))
        .withColumn("direction_id", F.col("direction_id").cast("int"))
        .groupBy(*cfg.row_key)
        .agg(newest.alias("v"))
        .select(
            *cfg.row_key,
            F.col("v.snapshot_timestamp").alias("vehicle_ts"),
            F.col("v.congestion_level").try_cast("double").alias("congestion_level"),
            F.col("v.occupancy_status").try_cast("double").alias("occupancy_status"),
        )
    )


def minute_lags(rows: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Per minute, the lags of its last rows as an array of at most ``lag_history`` items.

    ``cfg.feed_order`` tells which rows are the last ones; rows of one place go by
    age, the oldest first, and rows without a place come before all others. Every
    map task sends a minute's last ``lag_history`` rows at most. Without an order
    the newest rows are the last ones, and rows are counted per lag first.
    """
    lag = F.greatest(F.col("snapshot_minute") - F.col("snapshot_timestamp"), F.lit(0))
    if cfg.feed_order:
        last_first = Window.partitionBy(*cfg.minute_key).orderBy(
            *[F.desc_nulls_last(c) for c in cfg.feed_order], "lag"
        )
        last = (
            rows.select(*cfg.minute_key, lag.cast("int").alias("lag"), *cfg.feed_order)
            .withColumn("_back", F.row_number().over(last_first))
            .filter(F.col("_back") <= cfg.lag_history)
        )
        in_order = F.reverse(F.array_sort(F.collect_list(F.struct("_back", "lag"))))
        return last.groupBy(*cfg.minute_key).agg(
            F.transform(in_order, lambda r: r["lag"]).alias("lags")
        )
    counts = (
        rows.withColumn("lag", lag.cast("int"))
        .groupBy(*cfg.minute_key, "lag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    newest_first = (
        Window.partitionBy(*cfg.minute_key)
        .orderBy("lag")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.lit(cfg.lag_history) - F.coalesce(F.sum("n").over(newest_first), F.lit(0))
    kept = counts.withColumn("keep", F.least("n", room).cast("int")).filter("keep > 0")
    runs = F.reverse(F.array_sort(F.collect_list(F.struct("lag", "keep"))))
    return kept.groupBy(*cfg.minute_key).agg(
        F.flatten(F.transform(runs, lambda r: F.array_repeat(r["lag"], r["keep"]))).alias("lags")
    )


def lag_histories(lags: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """The last ``lag_history`` lags up to and with each minute.

    Minutes are numbered and cut into blocks. Each block also gets the minutes
    before it that its first rows look back on.
    """
    reach = cfg.lag_history - 1
    scope = list(cfg.scope)
    numbered = with_position(
        lags.withColumn("_day", F.floor(F.col("snapshot_minute") / _DAY)),
        scope,
        "_day",
        ["snapshot_minute"],
        "_i",
    )
    block = F.floor(F.col("_i") / _BLOCK)
    spread = numbered.withColumn(
        "_block",
        F.explode(F.array_distinct(F.array(block, F.floor((F.col("_i") + reach) / _BLOCK)))),
    ).withColumn("_own", block == F.col("_block"))
    back = Window.partitionBy(*scope, "_block").orderBy("_i").rowsBetween(-reach, 0)
    gathered = F.flatten(F.collect_list("lags").over(back))
    return (
        spread.withColumn("history", last_items(gathered, cfg.lag_history))
        .filter("_own")
        .select(*cfg.minute_key, "history")
    )


def tolerances(
    minutes: DataFrame, lags: DataFrame, base_secs: int, cfg: FeatureConfig, out: str
) -> DataFrame:
    """Age limit per minute of ``minutes``: ``base_secs`` or the recent 95th percentile lag.

    ``lags`` must only hold minutes of ``minutes``. A minute without rows keeps
    the limit of the minute before.
    """
    scope = list(cfg.scope)
    added = lag_histories(lags, cfg)
    p95 = F.floor(sorted_quantile(F.array_sort("history"), 0.95))
    limits = added.select(
        *cfg.minute_key,
        F.greatest(F.lit(base_secs), p95 + cfg.lag_buffer_secs).cast("long").alias("_limit"),
    )
    joined = minutes.join(limits, cfg.minute_key, "left").withColumn(
        "_day", F.floor(F.col("snapshot_minute") / _DAY)
    )
    filled = with_last_known(
        joined, scope, "_day", ["snapshot_minute"], F.col("_limit"), out
    )
    return filled.select(
        *cfg.minute_key, F.coalesce(out, F.lit(base_secs)).cast("long").alias(out)
    )


def feed_limits(
    tu: DataFrame, vp: DataFrame, served: DataFrame, cfg: FeatureConfig
) -> DataFrame:
    """``tu_tolerance`` and ``vp_tolerance`` of each minute of ``served``.

    The limit of the trip updates is told only; no row is dropped by it. Every
    minute with trip updates counts for it, for the vehicles' one the served ones.
    """
    wanted = served.select(*cfg.minute_key).distinct()
    spoken = wanted.union(tu.select(*cfg.minute_key)).distinct()
    told = tolerances(spoken, minute_lags(tu, cfg), cfg.tu_lag_secs, cfg, "tu_tolerance")
    lags = minute_lags(vp, cfg).join(wanted, cfg.minute_key, "left_semi")
    seen = tolerances(wanted, lags, cfg.vp_lag_secs, cfg, "vp_tolerance")
    return seen.join(told, cfg.minute_key)
