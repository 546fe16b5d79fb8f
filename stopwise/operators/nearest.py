"""From raw trip updates to one candidate per minute, stop and direction.

Input rows carry ``snapshot_minute`` (the minute they are read in) and
``snapshot_timestamp`` (when the feed was made). Every reduction here is an
aggregate with a map-side part, so a crowded minute or stop is reduced where it
is read, before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import FeatureConfig


def usable_updates(tu: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Updates made by the minute, with ``offset`` (seconds to arrival) and filled delays."""
    return tu.filter(F.col("snapshot_timestamp") <= F.col("snapshot_minute")).select(
        *cfg.minute_key,
        "stop_id",
        F.col("direction_id").cast("int").alias("direction_id"),
        "trip_id",
        "route_id",
        "stop_sequence",
        F.col("arrival_time").cast("long").alias("arrival_time"),
        F.col("departure_time").cast("long").alias("departure_time"),
        F.coalesce(F.col("arrival_delay").cast("double"), F.lit(0.0)).alias("arrival_delay"),
        F.coalesce(F.col("departure_delay").cast("double"), F.lit(0.0)).alias("departure_delay"),
        (F.col("arrival_time") - F.col("snapshot_minute")).cast("long").alias("offset"),
    )


def future_windows(updates: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """How far ahead each minute looks: the 95th percentile offset, kept within bounds."""
    p95 = F.percentile(F.when(F.col("offset") >= 0, F.col("offset")), 0.95)
    floor, ceiling = F.lit(float(cfg.max_future_secs)), F.lit(float(cfg.future_ceiling_secs))
    return updates.groupBy(*cfg.minute_key).agg(
        F.least(F.greatest(F.coalesce(p95, floor), floor), ceiling).alias("future_window")
    )


def _within_ceiling(updates: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Rows that could pass the window of some minute; the minute's own window comes later."""
    return updates.filter(F.col("offset").between(-1, cfg.future_ceiling_secs + 1))


# Nearest first; the other columns only settle ties.
_RANK = ["trip_id", "stop_sequence", "route_id", "arrival_time"]
_PAYLOAD = ["arrival_delay", "departure_delay"]


def nearest_updates(updates: DataFrame, windows: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Nearest forecast per minute, stop and direction.

    A column that is null on the nearest row is taken from the next one that has
    it. The order is by distance and the window is a limit on distance, so the
    window is tested after the aggregate, on its one row per key.
    """
    order = [F.abs("offset").alias("gap"), *_RANK, *_PAYLOAD]
    best = F.min(F.struct(*order, "offset"))
    departing = F.min(
        F.when(
            F.col("departure_time").isNotNull(),
            F.struct(*order, F.col("departure_time").alias("departure_time"), "offset"),
        )
    )
    reduced = (
        _within_ceiling(updates, cfg)
        .groupBy(*cfg.row_key)
        .agg(best.alias("best"), departing.alias("departing"))
    )
    limit = F.col("future_window") + 1
    return (
        reduced.join(windows, cfg.minute_key)
        .filter(F.col("best.offset") <= limit)
        .select(
            *cfg.row_key,
            "best.trip_id",
            "best.route_id",
            "best.stop_sequence",
            "best.arrival_time",
            F.when(F.col("departing.offset") <= limit, F.col("departing.departure_time")).alias(
                "departure_time"
            ),
            "best.arrival_delay",
            "best.departure_delay",
            "best.offset",
        )
    )


def trip_stop_delays(updates: DataFrame, windows: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Unclipped arrival delay of each trip at each stop it still calls at, per minute."""
    key = [*cfg.minute_key, "trip_id", "stop_id"]
    order = F.struct(
        F.abs("offset").alias("gap"),
        "direction_id",
        "stop_sequence",
        "route_id",
        "arrival_time",
        "arrival_delay",
        "offset",
    )
    reduced = _within_ceiling(updates, cfg).groupBy(*key).agg(F.min(order).alias("best"))
    return (
        reduced.join(windows, cfg.minute_key)
        .filter(F.col("best.offset") <= F.col("future_window") + 1)
        .select(*key, F.col("best.arrival_delay").alias("arrival_delay"))
    )
