"""Grid search over detector settings in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import DetectorConfig
from stopwise.operators import labels, metrics, thresholds
from stopwise.plans.detect import (
    DetectorInput,
    detector_rows,
    feature_names,
    number_rows,
    score_numbered,
)
from stopwise.plans.lineage import checkpointed
from stopwise.sources.tables import exists


def expand_grid(grid: Mapping[str, object], limit: int | None = None) -> list[DetectorConfig]:
    """All combinations, in the order of the grid; settings without effect add none."""
    lists = [v if isinstance(v, (list, tuple)) else [v] for v in grid.values()]
    combos = [DetectorConfig.from_mapping(dict(zip(grid, c))) for c in product(*lists)]
    return list(dict.fromkeys(combos))[:limit]


def read_grid(path: str) -> dict[str, object]:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)


def _config_rows(configs: Sequence[DetectorConfig], context: Mapping[str, object]):
    return F.array(
        *[
            F.struct(
                F.lit(c.config_id(**context)).alias("config_id"),
                F.lit(i).alias("config_order"),
                F.lit(c.structure_id).alias("structure_id"),
                F.lit(c.n_trees).alias("n_trees"),
                F.lit(c.height).alias("height"),
                F.lit(c.window_size).alias("window_size"),
                F.lit(float(c.threshold_quantile)).alias("threshold_quantile"),
            )
            for i, c in enumerate(configs)
        ]
    )


def grid_scores(
    features: DataFrame,
    configs: Sequence[DetectorConfig],
    use: DetectorInput = DetectorInput(),
    context: Mapping[str, object] | None = None,
) -> DataFrame:
    """Scores and flags under every setting; ``config_id`` tells them apart.

    Settings that only differ in the quantile share one scoring.
    """
    names = feature_names(features, use)
    resets = {c.daily_reset for c in configs}
    if len(resets) != 1:
        raise ValueError("the settings of one grid must agree on daily_reset")
    numbered = number_rows(detector_rows(features, use, resets.pop()), use.scope)
    cfgs = {c.structure_id: c for c in configs}
    scored = score_numbered(numbered, names, cfgs, use.scope)
    mine = F.filter(
        _config_rows(configs, context or {}), lambda c: c["structure_id"] == F.col("structure_id")
    )
    each = scored.withColumn("_config", F.explode(mine))
    return each.select(
        *use.scope,
        F.col("_config.config_id").alias("config_id"),
        "ts",
        "stop_id",
        "direction_id",
        "seq",
        "anomaly_score",
        thresholds.above_quantile(
            F.col("_config.window_size"), F.col("_config.threshold_quantile")
        ).alias("anomaly_flag"),
    )


def _fingerprint(features: DataFrame) -> str:
    """Number and hash of the rows, in any order; repeated rows count."""
    columns = sorted(features.columns)
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    n, total = features.agg(F.count("*"), F.sum(row.cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def grid_search(
    features: DataFrame,
    grid: Mapping[str, object],
    use: DetectorInput = DetectorInput(),
    start: int | None = None,
    end: int | None = None,
    delay_threshold: float = 120,
    k: int = 50,
    limit: int | None = None,
    across: str = "station",
    results_path: str | None = None,
    data_version: str = "",
) -> DataFrame:
    """One row of metrics per setting, over ``start <= minute < end``.

    With ``results_path`` finished settings are kept there, under an id that also
    covers the time range, ``use``, the columns, ``data_version`` and the number and
    a hash of the rows, and are not computed again.
    """
    spark = features.sparkSession
    if start is not None:
        features = features.filter(F.col("snapshot_timestamp") >= start)
    if end is not None:
        features = features.filter(F.col("snapshot_timestamp") < end)
    context = {"start": start, "end": end, "threshold": delay_threshold, "k": k,
               "across": across, "data": data_version, "use": repr(asdict(use)),
               "columns": repr(sorted(features.dtypes))}
    if results_path is not None:
        context["rows"] = _fingerprint(features)
    configs = expand_grid(grid, limit)
    wanted = [c.config_id(**context) for c in configs]
    todo = configs
    if results_path is not None and exists(spark, results_path):
        known = spark.read.parquet(results_path)
        mine = known.filter(F.col("config_id").cast("string").isin(*wanted))
        done = {r[0] for r in mine.select("config_id").distinct().collect()}
        todo = [c for c, i in zip(configs, wanted) if i not in done]

    def compute(chosen: Sequence[DetectorConfig]) -> DataFrame:
        scored = grid_scores(features, chosen, use, context)
        # Four metrics read the same rows.
        delayed = checkpointed(labels.attach_delays(scored, features, use.scope))
        found = metrics.evaluate(
            delayed, delay_threshold=delay_threshold, k=k, by=["config_id"], across=across
        )
        settings = spark.range(1).select(
            F.explode(_config_rows(chosen, context)).alias("c")
        ).select("c.*")
        # A setting without any scored row still gets its row, of zeros.
        return settings.drop("structure_id").join(found, "config_id", "left").withColumns(
            {
                m: F.coalesce(m, F.lit(0.0))
                for m in ("lead_time_roc_auc", "precision_at_k", "fpr")
            }
        )

    if results_path is None:
        return compute(configs)
    if todo:
        # One row per setting. A plain column keeps the type of an id of digits only.
        compute(todo).coalesce(1).write.mode("append").parquet(results_path)
    return spark.read.parquet(results_path).filter(F.col("config_id").isin(*wanted))


def best_config(results: DataFrame) -> DataFrame:
    """The setting with the highest area under the curve; the earlier one on a tie."""
    row = F.struct(*results.columns)
    rank = F.struct(F.col("lead_time_roc_auc"), (-F.col("config_order")).alias("o"))
    return results.agg(F.max_by(row, rank).alias("best")).select("best.*")
