"""The steps a user runs, from folders to folders."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.config import DetectorConfig, FeatureConfig
from stopwise.operators import labels, metrics, routes
from stopwise.plans.detect import DetectorInput, run_summary, score_features
from stopwise.plans.features import Network, feature_tables
from stopwise.plans.tune import best_config, grid_search
from stopwise.sources.tables import in_range, load_feeds, replace_range, usable_minutes

UTC = "UTC"


def generate_features(
    spark: SparkSession,
    processed_root: str,
    out_path: str,
    start: int | None = None,
    end: int | None = None,
    cfg: FeatureConfig = FeatureConfig(),
    skip_unreadable: bool = False,
) -> DataFrame:
    """Features of every minute both feeds have a file for, ends included.

    Reads the tables and the manifest :func:`ingest_feeds` writes; the routes come
    from all trip updates, the features from those in the range. Stored features
    outside the range stay. A row is looked for in the folders of its minute's date
    and of the days before and after. With ``skip_unreadable`` the routes come from those
    files of the trip updates that can be read, of which every footer is opened; an
    unreadable file of the range fails.
    """
    updates, positions = (f"{processed_root}/{f}" for f in ("trip_updates", "vehicle_positions"))
    readable = spark.read.options(ignoreCorruptFiles=skip_unreadable, mergeSchema=skip_unreadable).parquet(updates)
    feeds = {"trip_updates": spark.read.schema(readable.schema).parquet(updates), "vehicle_positions": spark.read.parquet(positions)}
    manifest = spark.read.parquet(f"{processed_root}/manifest")
    minutes = in_range(usable_minutes(manifest, cfg.scope), start, end, "snapshot_minute")
    stops = routes.route_stops(readable, cfg.scope)
    chosen = {
        name: in_range(df, start, end, "snapshot_minute", slack_days=1)
        .drop("year", "month", "day")
        .join(minutes, cfg.minute_key, "left_semi")
        for name, df in feeds.items()
    }
    result = feature_tables(
        chosen["trip_updates"],
        chosen["vehicle_positions"],
        minutes,
        Network.from_stops(stops, cfg),
        cfg,
    )
    replace_range(result.features, out_path, start, end, zone=UTC)
    return spark.read.parquet(out_path)


def detect_anomalies(
    spark: SparkSession,
    features_path: str,
    out_path: str,
    start: int,
    end: int,
    cfg: DetectorConfig = DetectorConfig(),
    use: DetectorInput = DetectorInput(),
    explain: Column | None = None,
) -> DataFrame:
    """Score ``start <= minute < end``, write the scores by UTC date, return the summary.

    Stored scores outside the range stay.
    """
    features = in_range(spark.read.parquet(features_path), start, end - 1, zone=UTC)
    scored = score_features(features.drop("year", "month", "day"), cfg, use, explain)
    replace_range(scored, out_path, start, end - 1, epoch="ts", zone=UTC)
    written = in_range(spark.read.parquet(out_path), start, end - 1, "ts", UTC)
    return run_summary(written)


def tune(
    spark: SparkSession,
    features_path: str,
    grid: Mapping[str, object],
    start: int,
    end: int,
    results_path: str,
    csv_path: str | None = None,
    best_path: str | None = None,
    delay_threshold: float = 120,
    use: DetectorInput = DetectorInput(),
    data_version: str = "",
) -> DataFrame:
    """Grid search over a time range; results as CSV and the best setting as JSON if asked."""
    features = in_range(spark.read.parquet(features_path), start, end - 1, zone=UTC)
    results = grid_search(
        features.drop("year", "month", "day"),
        grid,
        use,
        start,
        end,
        delay_threshold=delay_threshold,
        results_path=results_path,
        data_version=data_version,
    )
    if csv_path is not None:
        # One row per setting.
        results.coalesce(1).write.mode("overwrite").option("header", True).csv(csv_path)
    if best_path is not None:
        best_config(results).coalesce(1).write.mode("overwrite").json(best_path)
    return results


def evaluate_against_alerts(
    spark: SparkSession, scores_path: str, processed_root: str, skip_planned: bool = False
) -> DataFrame:
    """Metrics of stored scores against the alerts feed.

    With ``skip_planned``, planned works and the dates they touch are left out.
    """
    scored = spark.read.parquet(scores_path)
    alerts = load_feeds(spark, processed_root, ["alerts"])
    events = labels.build_events(alerts)
    if skip_planned:
        scored = labels.outside_planned_days(scored, alerts)
        events = labels.without_planned(events)
    return metrics.evaluate(scored, events)


def settings_table(spark: SparkSession, cfg: DetectorConfig) -> DataFrame:
    """The settings as one row, to store next to scores."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in asdict(cfg).items()])
