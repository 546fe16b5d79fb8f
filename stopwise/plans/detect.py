"""The detector plan: station features in, scores and flags out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.config import (
    DROPPED_BY_DEFAULT,
    DYNAMIC_FEATURES,
    WATCHED_STOPS,
    DetectorConfig,
)
from stopwise.functions import clock
from stopwise.operators import spacetrees, thresholds
from stopwise.operators.ordered import with_position
from stopwise.plans.lineage import ship_package

_KEYS = ("ts", "stop_id", "direction_id")
_NOT_FEATURES = {"snapshot_timestamp", "snapshot_minute", "ts", "stop_id", "direction_id", "local_dt"}


@dataclass(frozen=True)
class DetectorInput:
    """Which rows and columns of the feature table the detector sees."""

    stations: Sequence[str] | None = WATCHED_STOPS
    dropped: Sequence[str] = DROPPED_BY_DEFAULT
    # Rows with zeros in all of these are left out; empty keeps every row.
    active_columns: Sequence[str] = DYNAMIC_FEATURES
    scope: Sequence[str] = ()
    local_zone: str = clock.SYDNEY
    reset_hour: int = 3
    features: Sequence[str] | None = field(default=None)


def feature_names(features: DataFrame, use: DetectorInput) -> list[str]:
    """Numeric columns that are neither keys nor dropped."""
    if use.features is not None:
        return list(use.features)
    out = {*_NOT_FEATURES, *use.scope, *use.dropped}
    return [
        f.name
        for f in features.schema
        if f.name not in out and isinstance(f.dataType, T.NumericType)
    ]


def detector_rows(features: DataFrame, use: DetectorInput, daily_reset: bool = True) -> DataFrame:
    """Rows the detector takes, nulls as zeros, with their service ``day``."""
    names = feature_names(features, use)
    rows = features
    if use.stations is not None:
        rows = rows.filter(F.col("stop_id").cast("string").isin(*[str(s) for s in use.stations]))
    # Tested on the raw columns: a filter over the filled ones makes the optimizer
    # try every mix of raw and filled columns.
    active = [F.col(c) != 0 for c in use.active_columns if c in names]
    if active:
        rows = rows.filter(reduce(lambda a, b: a | b, active))
    day = (
        clock.service_day("snapshot_timestamp", use.local_zone, use.reset_hour)
        if daily_reset
        else F.lit("1970-01-01").cast("date")
    )
    rows = rows.select(
        *use.scope,
        day.alias("day"),
        F.col("snapshot_timestamp").alias("ts"),
        "stop_id",
        "direction_id",
        *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names],
    )
    return rows


def number_rows(rows: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Add ``seq``, the place of a row in its service day."""
    hourly = rows.withColumn("_hour", F.floor(F.col("ts") / 3600))
    return with_position(
        hourly, [*scope, "day"], "_hour", ["ts", "stop_id", "direction_id"], "seq"
    ).drop("_hour")


def score_numbered(
    numbered: DataFrame,
    names: Sequence[str],
    cfgs: dict[str, DetectorConfig],
    scope: Sequence[str] = (),
    explain: Column | None = None,
) -> DataFrame:
    """Score numbered rows under every structure of ``cfgs`` (by structure id)."""
    ship_package(numbered.sparkSession)
    scored = spacetrees.score_windows(numbered, names, [*scope, "day"], _KEYS, cfgs, explain)
    if explain is None:
        return scored
    return scored.withColumn(
        "top_features", F.when(F.col("changes").isNotNull(), spacetrees.top_changes(names))
    ).drop("changes")


def score_features(
    features: DataFrame,
    cfg: DetectorConfig = DetectorConfig(),
    use: DetectorInput = DetectorInput(),
    explain: Column | None = None,
) -> DataFrame:
    """Score and flag every row the detector takes.

    ``explain`` is a condition on the feature columns that selects the rows to
    explain; ``F.lit(True)`` explains all. Explaining re-walks the trees once per
    feature, so a narrow condition pays.
    """
    names = feature_names(features, use)
    numbered = number_rows(detector_rows(features, use, cfg.daily_reset), use.scope)
    scored = score_numbered(numbered, names, {cfg.structure_id: cfg}, use.scope, explain)
    return _public(scored, cfg, use, explain is not None)


def _public(scored: DataFrame, cfg: DetectorConfig, use: DetectorInput, explained: bool) -> DataFrame:
    flag = thresholds.above_quantile(F.lit(cfg.window_size), F.lit(cfg.threshold_quantile))
    top = F.col("top_features") if explained else F.lit(None).cast(
        "array<struct<feature:string,contribution:double>>"
    )
    return scored.select(
        *use.scope,
        "day",
        *_KEYS,
        "seq",
        "anomaly_score",
        flag.alias("anomaly_flag"),
        top.alias("top_features"),
        spacetrees.top_changes_json(top).alias("shap_top3_json"),
    )


def rows_to_carry(numbered: DataFrame, cfg: DetectorConfig, scope: Sequence[str] = ()) -> DataFrame:
    """The end of the open service day that later rows still depend on.

    Scores of the last ``window_size`` rows reach back over two windows and the
    masses behind them over one more; so whole windows from two before the
    open one are kept, at most three windows and the rows of the open one.
    """
    latest = numbered.groupBy(*scope).agg(
        F.max(F.struct("day", "seq")).alias("_end")
    )
    if scope:
        marked = numbered.join(latest, [*scope])
    else:
        marked = numbered.withColumn("_end", latest.scalar())
    window = F.floor((F.col("seq") - 1) / cfg.window_size)
    # The next row has number end + 1.
    open_window = F.floor(F.col("_end.seq") / cfg.window_size)
    return marked.filter(
        (F.col("day") == F.col("_end.day")) & (window >= open_window - 2)
    ).drop("_end")


def continue_scores(
    carried: DataFrame | None,
    features: DataFrame,
    cfg: DetectorConfig,
    use: DetectorInput = DetectorInput(),
    explain: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score ``features`` as the continuation of an earlier run.

    ``explain`` as in :func:`score_features`. Returns the new scores and the numbered rows of both runs, from which
    :func:`rows_to_carry` makes the next state.
    """
    names = feature_names(features, use)
    fresh = number_rows(detector_rows(features, use, cfg.daily_reset), use.scope)
    if carried is None:
        scored = score_numbered(fresh, names, {cfg.structure_id: cfg}, use.scope, explain)
        return _public(scored, cfg, use, explain is not None), fresh
    by_day = [*use.scope, "day"]
    offsets = carried.groupBy(*by_day).agg(F.max("seq").alias("_offset"))
    shifted = (
        fresh.join(offsets, by_day, "left")
        .withColumn("seq", F.col("seq") + F.coalesce("_offset", F.lit(0)))
        .drop("_offset")
    )
    numbered = carried.unionByName(shifted.select(*carried.columns))
    # Carried rows were explained when they were new.
    late = F.col("seq") > F.coalesce(F.col("_offset"), F.lit(0))
    marked = numbered.join(offsets, by_day, "left") if explain is not None else numbered
    scored = score_numbered(marked, names, {cfg.structure_id: cfg}, use.scope, None if explain is None else late & explain)
    new = scored.join(shifted.select(*use.scope, *_KEYS), [*use.scope, *_KEYS], "left_semi")
    return _public(new, cfg, use, explain is not None), numbered


def run_summary(scored: DataFrame) -> DataFrame:
    """Snapshots with rows, flags, and the mean of the snapshots' mean scores."""
    per_minute = scored.groupBy("ts").agg(
        F.sum("anomaly_flag").alias("flags"), F.avg("anomaly_score").alias("mean_score")
    )
    return per_minute.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.coalesce(F.sum("flags"), F.lit(0)).alias("anomalies"),
        F.coalesce(F.avg("mean_score"), F.lit(0.0)).alias("mean_score"),
    )
