"""The detector on a stream of feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopwise.config import DetectorConfig
from stopwise.functions import clock
from stopwise.plans.detect import DetectorInput
from stopwise.plans.state import Detector
from stopwise.streaming.runs import StateFolder


class DetectorStream:
    """The foreachBatch step that scores feature rows in continuation of earlier ones.

    Batches must come in time order, as the feature stream writes them.
    """

    def __init__(
        self,
        spark: SparkSession,
        out_path: str,
        state_path: str,
        cfg: DetectorConfig = DetectorConfig(),
        use: DetectorInput = DetectorInput(),
        explain: Column | None = None,
    ) -> None:
        self.out_path = out_path
        self.state = StateFolder(spark, state_path)
        self.cfg = cfg
        self.use = use
        self.explain = explain

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._score(batch, batch_id, None)

    def take(self, entries: DataFrame, batch_id: int, features_root: str, schema) -> None:
        """Score the steps that ``entries`` of a ledger name, in order, each once for all batches.

        The number of the last step taken is part of the state, so a step that is entered again, as its feature batch was
        repeated, isn't scored again, while a repeated batch of this query takes the same steps as before.
        """
        before = self.state.before(batch_id)
        last = -1 if before is None else self.state.meta(before).get("taken", -1)
        numbers = sorted(r.number for r in entries.filter(F.col("number") > last).select("number").distinct().collect())
        folders = [f"{features_root}/features/batch_id={n}" for n in numbers]
        reader = self.state.spark.read.schema(schema).option("recursiveFileLookup", True)
        rows = reader.parquet(*folders) if folders else self.state.spark.createDataFrame([], schema)
        rows = rows.filter(F.col("snapshot_timestamp").isNotNull())
        self._score(rows, batch_id, numbers[-1] if numbers else last)

    def _score(self, batch: DataFrame, batch_id: int, taken: int | None) -> None:
        before = self.state.before(batch_id)
        carried = None if before is None else self.state.table(before, "carried")
        scores, after = Detector(self.cfg, self.use, carried).score(batch, self.explain)
        dated = scores.withColumns(clock.partition_columns("ts", "UTC"))
        dated.write.mode("overwrite").partitionBy("year", "month", "day").parquet(
            f"{self.out_path}/batch_id={batch_id}"
        )
        self.state.write(batch_id, {"carried": after.carried}, {} if taken is None else {"taken": taken})
        self.state.forget(batch_id)


def detector_stream(
    spark: SparkSession,
    features_path: str,
    schema,
    step: DetectorStream,
    checkpoint: str,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(features_path).filter(F.col("snapshot_timestamp").isNotNull())
    return (
        rows.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def ledger_stream(
    spark: SparkSession,
    features_root: str,
    schema,
    step: DetectorStream,
    checkpoint: str,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score the finished steps of a feature stream, each exactly once, in continuation.

    ``features_root`` is the output folder of :class:`stopwise.streaming.features.FeatureStream`, ``schema`` that of its
    feature rows.
    """
    reader = spark.readStream.schema("number long").option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    entries = reader.json(f"{features_root}/ledger")

    def take(batch: DataFrame, batch_id: int) -> None:
        step.take(batch, batch_id, features_root, schema)

    return (
        entries.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
