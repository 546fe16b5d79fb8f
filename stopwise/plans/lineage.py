"""Plan helpers that touch the cluster: lineage cuts and the package on the workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from stopwise.config import FeatureConfig


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without it, as in tests, gets one of its own; on a cluster no
    other machine could read that.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="stopwise-"))
    return df.checkpoint(eager=True)


def cut(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return checkpointed(df) if cfg.cut_lineage else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="stopwise-"), "stopwise")
    context.addPyFile(shutil.make_archive(target, "zip", root, "stopwise"))
    _SHIPPED.add(context.applicationId)
