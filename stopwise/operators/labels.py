"""Ground truth for scores: alert intervals and delay thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import clock
from stopwise.operators.ordered import with_running_max

_DAY = 86400

# Cause codes of planned works, as the text the feed tables hold.
PLANNED_CAUSES = ("9", "10")


def build_events(alerts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Distinct alert events."""
    return alerts.select(
        *scope, "alert_entity_id", "active_period_start", "active_period_end", "cause"
    ).distinct()


def without_planned(events: DataFrame, causes: Sequence[str] = PLANNED_CAUSES) -> DataFrame:
    """Events not caused by planned works; an unknown cause stays."""
    return events.filter(~F.coalesce(F.col("cause").cast("string").isin(*causes), F.lit(False)))


def outside_planned_days(
    scored: DataFrame,
    alerts: DataFrame,
    causes: Sequence[str] = PLANNED_CAUSES,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Scores on UTC dates without an alert of planned works."""
    dates = (
        alerts.filter(F.col("cause").cast("string").isin(*causes))
        .select(*scope, clock.utc_date("snapshot_timestamp").alias("_date"))
        .distinct()
    )
    return (
        scored.withColumn("_date", clock.utc_date("ts"))
        .join(dates, [*scope, "_date"], "left_anti")
        .drop("_date")
    )


def label_scores(
    scored: DataFrame, events: DataFrame, lead_time: int = 900, scope: Sequence[str] = ()
) -> DataFrame:
    """Add ``label``: 1 if some event has ``start - lead_time <= ts <= end``.

    Distinct times and event starts are put in one order. A time is covered
    exactly when the largest end among the events begun by then is not before it,
    so a running maximum replaces the range join. An open end matches nothing.
    """
    scope = list(scope)
    times = scored.select(*scope, F.col("ts").alias("_t")).distinct()
    begins = events.filter(
        F.col("active_period_start").isNotNull() & F.col("active_period_end").isNotNull()
    ).select(
        *scope,
        (F.col("active_period_start") - lead_time).alias("_t"),
        F.col("active_period_end").alias("_end"),
        F.lit(0).alias("_place"),
    )
    line = times.withColumn("_place", F.lit(1)).unionByName(begins, allowMissingColumns=True)
    line = line.withColumn("_chunk", F.floor(F.col("_t") / _DAY))
    reached = with_running_max(line, scope, "_chunk", ["_t", "_place"], F.col("_end"), "_reach")
    hit = reached.filter((F.col("_place") == 1) & (F.col("_reach") >= F.col("_t"))).select(
        *scope, F.col("_t").alias("ts"), F.lit(1).alias("label")
    )
    return scored.join(hit, [*scope, "ts"], "left").withColumn(
        "label", F.coalesce("label", F.lit(0))
    )


def _delay(scored: DataFrame, column: str) -> Column:
    if column not in scored.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))


def delay_label(scored: DataFrame, threshold: float, two_sided: bool = False) -> Column:
    """1 where the arrival or departure delay exceeds ``threshold`` seconds."""
    delays = [_delay(scored, c) for c in ("arrival_delay_t", "departure_delay_t")]
    if two_sided:
        delays = [F.abs(d) for d in delays]
    return ((delays[0] > threshold) | (delays[1] > threshold)).cast("int")


def label_delays(scored: DataFrame, threshold: float, two_sided: bool = False) -> DataFrame:
    return scored.withColumn("label", delay_label(scored, threshold, two_sided))


def attach_delays(scored: DataFrame, features: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Delays of the scored minute, stop and direction; 0 where there is no feature row."""
    delays = features.select(
        *scope,
        F.col("snapshot_timestamp").alias("ts"),
        "stop_id",
        "direction_id",
        "arrival_delay_t",
        "departure_delay_t",
    )
    names = ("arrival_delay_t", "departure_delay_t")
    plain = scored.drop(*names)
    return plain.join(delays, [*scope, "ts", "stop_id", "direction_id"], "left").withColumns(
        {n: F.coalesce(n, F.lit(0.0)) for n in names}
    )


def false_negatives(labelled: DataFrame) -> DataFrame:
    return labelled.filter("label = 1 AND anomaly_flag = 0")


def false_positives(labelled: DataFrame) -> DataFrame:
    return labelled.filter("label = 0 AND anomaly_flag = 1")
