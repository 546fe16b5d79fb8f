"""A detector at rest: settings, trees and the rows its next scores depend on."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession

from stopwise.config import DetectorConfig
from stopwise.operators.spacetrees import build_trees
from stopwise.plans.detect import DetectorInput, continue_scores, rows_to_carry


def tree_table(spark: SparkSession, cfg: DetectorConfig, features: Sequence[str]) -> DataFrame:
    """The inner nodes of the trees: ``n_trees * (2**height - 1)`` rows."""
    feature, split = build_trees(
        cfg.n_trees, cfg.height, len(features), cfg.seed, cfg.lower, cfg.upper
    )
    rows = [
        (t, n, features[feature[t, n]], float(split[t, n]))
        for t in range(cfg.n_trees)
        for n in range(1, 1 << cfg.height)
    ]
    return spark.createDataFrame(rows, "tree int, node int, feature string, split double")


@dataclass(frozen=True)
class Detector:
    """Settings and the numbered rows carried from earlier runs, if any."""

    cfg: DetectorConfig
    use: DetectorInput
    carried: DataFrame | None = None

    def score(self, features: DataFrame, explain: Column | None = None) -> tuple[DataFrame, Detector]:
        """Scores of ``features`` in continuation, and the detector after them; rows with ``explain`` explained."""
        scores, numbered = continue_scores(self.carried, features, self.cfg, self.use, explain)
        left = rows_to_carry(numbered, self.cfg, self.use.scope)
        return scores, replace(self, carried=left)


def save_detector(detector: Detector, features: Sequence[str], path: str) -> None:
    """Write the tables of ``detector`` under ``path``; ``carried`` must be set."""
    carried = detector.carried
    spark = carried.sparkSession
    use = {k: v for k, v in asdict(detector.use).items()}
    meta = json.dumps({"config": asdict(detector.cfg), "input": use, "features": list(features)})
    carried.write.mode("overwrite").parquet(f"{path}/carried_rows")
    tree_table(spark, detector.cfg, features).write.mode("overwrite").parquet(f"{path}/hst_tree")
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/detector_meta"
    )


def load_detector(spark: SparkSession, path: str) -> Detector:
    meta = json.loads(spark.read.text(f"{path}/detector_meta").first()[0])
    use = DetectorInput(**{**meta["input"], "features": meta["features"]})
    return Detector(
        DetectorConfig(**meta["config"]), use, spark.read.parquet(f"{path}/carried_rows")
    )
