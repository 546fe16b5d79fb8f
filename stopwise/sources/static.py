"""Static schedule files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions import clock
from stopwise.schemas import STATION_SCHEDULE


def read_static(spark: SparkSession, path: str) -> DataFrame:
    """A schedule text file; every column stays text, so ids keep their zeros."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def station_schedule(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Scheduled calls with service and route; times as seconds after midnight."""
    calls = stop_times.select(
        "trip_id",
        "stop_id",
        clock.clock_seconds("arrival_time").alias("sched_arr"),
        clock.clock_seconds("departure_time").alias("sched_dep"),
        F.col("stop_sequence").cast("string").try_cast("int").alias("stop_sequence"),
    )
    return calls.join(trips.select("trip_id", "service_id", "route_id"), "trip_id").select(
        *STATION_SCHEDULE.names
    )


def build_station_schedule(
    spark: SparkSession, static_dir: str, out_path: str | None = None
) -> DataFrame:
    """Schedule of a folder with ``stop_times.txt`` and ``trips.txt``; written if asked."""
    schedule = station_schedule(
        read_static(spark, f"{static_dir}/stop_times.txt"),
        read_static(spark, f"{static_dir}/trips.txt"),
    )
    if out_path is not None:
        schedule.write.mode("overwrite").parquet(out_path)
        return spark.read.parquet(out_path)
    return schedule
