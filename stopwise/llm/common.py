"""Helpers shared by the operators: text rules, shared tables, small schemas."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.plans.lineage import ship_package

#: The white space of every rule here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased; every other letter stays."""
    return F.translate(column, UPPER, UPPER.lower())


def shared_root(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session without that setting (tests) gets a temporary folder, and only if it runs on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="stopwise-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor then costs a task, not the lineage."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables of this application that nothing reads any more, on whatever store holds them."""
    context = spark.sparkContext
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def fresh(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"{wish}_"
    return wish


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n.lower() not in {c.lower() for c in df.columns}]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def with_workers(df: DataFrame) -> DataFrame:
    """Make this package importable on the Python workers before a plan that needs it."""
    ship_package(df.sparkSession)
    return df


_HOLDER: list[type] = []


def claim(owner: type) -> dict:
    """The models and caches (``owner._open``) of an operator on this worker.

    Workers are used again by later stages, so an operator that begins frees what another one has left.
    """
    if not _HOLDER or _HOLDER[0] is not owner:
        for other in _HOLDER:
            other._open.clear()
        _HOLDER[:] = [owner]
    return owner._open
