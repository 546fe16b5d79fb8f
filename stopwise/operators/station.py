"""Station features from candidates: windows per stop and direction.

After :mod:`nearest` there is at most one row per minute, stop and direction.
A window over one stop and direction therefore holds at most one row per minute
of history (525,600 a year), however crowded the feed is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import FeatureConfig
from stopwise.functions import clock
from stopwise.functions.arrays import sorted_quantile


def _clip(delay: str, cfg: FeatureConfig) -> Column:
    return F.greatest(F.least(F.col(delay), F.lit(float(cfg.delay_cap))), F.lit(-float(cfg.delay_cap)))


def mark_real(
    candidates: DataFrame, cfg: FeatureConfig, carried: DataFrame | None = None
) -> DataFrame:
    """Add ``is_real``: near enough, and another trip than the near-enough row before.

    ``carried`` holds the last real row of each stop from an earlier run.
    """
    near = candidates.withColumn("_near", F.col("offset") <= cfg.max_future_secs)
    if carried is not None:
        near = near.withColumn("_new", F.lit(True)).unionByName(
            carried.select(*cfg.row_key, "trip_id").withColumns(
                {"_near": F.lit(True), "_new": F.lit(False)}
            ),
            allowMissingColumns=True,
        )
    order = Window.partitionBy(*cfg.stop_key, "_near").orderBy("snapshot_minute")
    before = F.lag(F.struct("trip_id")).over(order)
    marked = near.withColumn(
        "is_real",
        F.col("_near") & (before.isNull() | ~before["trip_id"].eqNullSafe(F.col("trip_id"))),
    )
    if carried is not None:
        marked = marked.filter("_new").drop("_new")
    return marked.drop("_near")


def segment_rows(
    real: DataFrame, cfg: FeatureConfig, carried: DataFrame | None = None
) -> DataFrame:
    """Real rows with clipped delays, schedule and ``seg``, the service-day segment.

    Rows of ``carried`` (see :func:`carry_rows`) belong to one open segment and
    bring their headway along.
    """
    rows = real.withColumns(
        {
            "sched_arr": F.col("arrival_time") - F.col("arrival_delay"),
            "dwell_delta": F.when(
                F.col("departure_time").isNotNull(),
                F.col("departure_delay") - F.col("arrival_delay"),
            ),
            "arr": _clip("arrival_delay", cfg),
            "dep": _clip("departure_delay", cfg),
            "old_headway": F.lit(None).cast("double"),
            "is_new": F.lit(True),
        }
    )
    if carried is not None:
        rows = rows.unionByName(
            carried.withColumn("is_new", F.lit(False)), allowMissingColumns=True
        )
    order = Window.partitionBy(*cfg.stop_key).orderBy("snapshot_minute")
    before = F.lag("arrival_time").over(order)
    if cfg.service_day_rule == "shifted":
        today = clock.service_day("arrival_time", cfg.local_zone, cfg.reset_hour)
        cut = F.lag(today).over(order) != today
    else:
        cut = clock.starts_new_service_day(
            before, F.col("arrival_time"), cfg.local_zone, cfg.reset_hour
        )
    return rows.withColumn(
        "_cut", F.coalesce(cut & F.col("is_new"), F.lit(False)).cast("int")
    ).withColumn("seg", F.sum("_cut").over(order)).drop("_cut")


def rolling_features(rows: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Headways, gradients and rolling statistics inside each segment."""
    segment = Window.partitionBy(*cfg.stop_key, "seg").orderBy("snapshot_minute")
    earlier = segment.rowsBetween(Window.unboundedPreceding, -1)

    gap = (F.col("arrival_time") - F.lag("arrival_time").over(segment)).cast("double")
    headway = F.when(
        F.col("is_new"), F.when(gap.between(1, cfg.max_headway_secs), gap)
    ).otherwise(F.col("old_headway"))
    planned = F.col("sched_arr") - F.lag("sched_arr").over(segment)

    def full(n: int, stat) -> Column:
        frame = segment.rowsBetween(-n, -1)
        return F.when(F.count("arr").over(frame) == n, stat(F.col("arr")).over(frame))

    stepped = rows.withColumns(
        {
            "headway_t": headway,
            "_planned": planned,
            "delay_arrival_grad_t": F.col("arr") - F.lag("arr", 1, 0.0).over(segment),
            "delay_departure_grad_t": F.col("dep") - F.lag("dep", 1, 0.0).over(segment),
            "delay_mean_5": full(5, F.avg),
            "delay_std_5": full(5, F.stddev_samp),
            "delay_mean_15": full(15, F.avg),
            "last_vehicle_ts": F.last("vehicle_ts", ignorenulls=True).over(earlier),
        }
    ).withColumns(
        {
            "rel_headway_t": F.try_divide(
                F.col("headway_t"), F.nullif(F.col("_planned"), F.lit(0.0))
            ),
            "_valid": F.col("headway_t").isNotNull(),
        }
    )
    # The last 60 headways among the rows that have one, then carried to the rows after.
    among_valid = (
        Window.partitionBy(*cfg.stop_key, "seg", "_valid")
        .orderBy("snapshot_minute")
        .rowsBetween(-(cfg.lag_history - 1), 0)
    )
    here = F.when(
        F.col("_valid"),
        sorted_quantile(F.array_sort(F.collect_list("headway_t").over(among_valid)), 0.9),
    )
    return (
        stepped.withColumn("_p90", here)
        .withColumn("headway_p90_60", F.last("_p90", ignorenulls=True).over(earlier))
        .drop("_planned", "_valid", "_p90", "old_headway")
    )


def carry_rows(rolled: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """The rows of each stop's open segment that later minutes can still look back on.

    At most 15 latest rows, 60 latest with a headway and one latest with a
    vehicle: a bound per stop, whatever the length of the history.
    """
    last_seg = Window.partitionBy(*cfg.stop_key)
    back = Window.partitionBy(*cfg.stop_key).orderBy(F.desc("snapshot_minute"))
    upto = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        rolled.withColumn("_last", F.max("seg").over(last_seg))
        .filter(F.col("seg") == F.col("_last"))
        .withColumns(
            {
                "_row": F.row_number().over(back),
                "_headways": F.count("headway_t").over(upto),
                "_vehicles": F.count("vehicle_ts").over(upto),
            }
        )
    )
    kept = ranked.filter(
        (F.col("_row") <= 15)
        | (F.col("headway_t").isNotNull() & (F.col("_headways") <= cfg.lag_history))
        | (F.col("vehicle_ts").isNotNull() & (F.col("_vehicles") == 1))
    )
    return kept.select(
        *cfg.row_key,
        "trip_id",
        "route_id",
        "arrival_time",
        "sched_arr",
        "arr",
        "dep",
        "vehicle_ts",
        F.col("headway_t").alias("old_headway"),
    )


def _visible_first(stop: Column, asked_by: Column) -> Column:
    """Sort place of a look-up against an update of the same minute.

    Stops of one minute are handled in ascending id order: a stop with a smaller
    id has its new delay already, one with a larger id still shows its old one.
    """
    return F.when(stop < asked_by, F.lit(2)).otherwise(F.lit(0))


def upstream_delays(
    rows: DataFrame, neighbours: DataFrame, cfg: FeatureConfig
) -> DataFrame:
    """Last known delay at the one or two stops before, one row per look-up.

    Updates and look-ups of a stop are put in one order, and each look-up takes
    the last update before it. A stop not seen yet counts as 0.
    """
    joined = rows.filter("is_new").join(
        neighbours, [*cfg.scope, "route_id", "direction_id", "stop_id"]
    )
    asked = joined.select(
        *cfg.minute_key,
        "direction_id",
        F.col("stop_id").alias("asked_by"),
        F.explode(F.array("prev_1", "prev_2")).alias("stop_id"),
    ).filter(F.col("stop_id").isNotNull())
    asked = asked.withColumn("_place", _visible_first(F.col("stop_id"), F.col("asked_by")))
    given = rows.select(*cfg.row_key, "arr", F.lit(1).alias("_place"))
    order = (
        Window.partitionBy(*cfg.stop_key)
        .orderBy("snapshot_minute", "_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        asked.unionByName(given, allowMissingColumns=True)
        .withColumn("known", F.last("arr", ignorenulls=True).over(order))
        .filter(F.col("asked_by").isNotNull())
        .select(
            *cfg.minute_key,
            F.col("asked_by").alias("stop_id"),
            "direction_id",
            F.coalesce("known", F.lit(0.0)).alias("up"),
        )
    )


def downstream_delays(
    rows: DataFrame, neighbours: DataFrame, trip_delays: DataFrame, cfg: FeatureConfig
) -> DataFrame:
    """Delay of the same trip at the one or two stops after, one row per hit."""
    joined = rows.filter("is_new").join(
        neighbours, [*cfg.scope, "route_id", "direction_id", "stop_id"]
    )
    asked = joined.select(
        *cfg.minute_key,
        "direction_id",
        "trip_id",
        F.col("stop_id").alias("asked_by"),
        F.explode(F.array("next_1", "next_2")).alias("stop_id"),
    ).filter(F.col("stop_id").isNotNull())
    return asked.join(trip_delays, [*cfg.minute_key, "trip_id", "stop_id"]).select(
        *cfg.minute_key,
        F.col("asked_by").alias("stop_id"),
        "direction_id",
        F.col("arrival_delay").alias("down"),
    )


def neighbour_features(up: DataFrame, down: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Mean upstream and largest downstream delay per row."""
    return (
        up.unionByName(down, allowMissingColumns=True)
        .groupBy(*cfg.row_key)
        .agg(
            F.avg("up").alias("upstream_delay_mean_2"),
            F.max("down").alias("downstream_delay_max_2"),
        )
    )


def vehicle_features(cfg: FeatureConfig) -> dict[str, Column]:
    """Presence, level and data age; needs ``vehicle_ts`` null where too old."""
    present = F.col("vehicle_ts").isNotNull()
    age = F.when(present, F.col("snapshot_minute") - F.col("vehicle_ts")).otherwise(
        F.col("snapshot_minute") - F.col("last_vehicle_ts")
    )
    cap = F.lit(cfg.fresh_cap_secs)
    return {
        "is_train_present": present.cast("int"),
        "data_fresh_secs": F.least(F.coalesce(age, cap), cap).cast("double"),
    }


def minute_key_grid(minutes: DataFrame, keys: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Every key in every minute.

    An equi-join on the scope and a salt taken from the minute. Few keys become a
    broadcast by their size; many keys are shuffled in ``grid_salts`` shares.
    """
    n = cfg.grid_salts
    salted = minutes.select(
        *cfg.minute_key,
        F.pmod(F.xxhash64("snapshot_minute"), F.lit(n)).cast("int").alias("_salt"),
    )
    shares = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(shares, [*cfg.scope, "_salt"]).drop("_salt")


def clock_features(minute: str, cfg: FeatureConfig) -> dict[str, Column]:
    local = clock.local_time(minute, cfg.local_zone)
    return {
        "sin_hour": F.sin(clock.hour_angle(local)),
        "cos_hour": F.cos(clock.hour_angle(local)),
        "day_type": clock.is_weekend(local),
        "local_dt": local,
    }
