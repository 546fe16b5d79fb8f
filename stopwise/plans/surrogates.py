"""Transit-shaped tables derived from the generic test tables.

The test data has no feeds, so a stream of events stands in for them: snapshots
are hourly, users become stops, and a trip lasts two hours on one of two routes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_E = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            f"{_E} AS e",
            "user_id",
            "event_type",
            "value",
            "cast(get_json_object(props, '$.k') AS int) AS k",
            "concat('S', user_id % 8) AS stop_id",
            "cast((user_id div 8) % 2 AS int) AS direction_id",
        )
        .withColumn("snapshot_minute", F.expr("e - e % 3600"))
    )


def spread_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times spread over a year, so that clock changes are among them."""
    return events(spark, sf_dir).selectExpr("event_id", "e + user_id % 12 * 2592000 AS e2")


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("snapshot_minute").distinct()


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter("event_type <> 'error'")
        .withColumn("arrival_time", F.expr("snapshot_minute + cast(floor(value * 30) AS bigint)"))
        .selectExpr(
            "event_id",
            "snapshot_minute",
            "snapshot_minute AS snapshot_timestamp",
            "concat('T', user_id % 2, '_', e div 7200) AS trip_id",
            "concat('R', user_id % 2) AS route_id",
            "direction_id",
            "'00:00:00' AS start_time",
            "date_format(timestampadd(SECOND, e, timestamp_ntz'1970-01-01 00:00:00'), 'yyyyMMdd')"
            " AS start_date",
            "concat('V', user_id % 5) AS vehicle_id",
            "cast(user_id % 8 + 1 AS int) AS stop_sequence",
            "stop_id",
            "arrival_time",
            "CASE WHEN k % 11 <> 0 THEN arrival_time + 30 + k % 5 * 10 END AS departure_time",
            "CASE WHEN k % 7 <> 0 THEN k * 8 - 400 END AS arrival_delay",
            "k * 7 - 300 AS departure_delay",
        )
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter("event_type = 'view'")
        .selectExpr(
            "event_id",
            "snapshot_minute",
            "snapshot_minute - k % 90 AS snapshot_timestamp",
            "stop_id",
            "direction_id",
            "concat('V', user_id % 5) AS vehicle_id",
            "round(value / 10, 3) AS latitude",
            "cast(k % 4 AS string) AS congestion_level",
            "cast(k % 3 AS string) AS occupancy_status",
        )
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter("event_type = 'error'")
        .selectExpr(
            "event_id",
            "snapshot_minute",
            "e AS snapshot_timestamp",
            "concat('A', user_id % 20) AS alert_entity_id",
            "e AS active_period_start",
            "CASE WHEN k % 13 <> 0 THEN e + 600 + cast(floor(value * 10) AS bigint) END"
            " AS active_period_end",
            "concat('R', user_id % 2) AS route_id",
            "cast(k % 10 + 1 AS string) AS cause",
        )
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .withColumn("anomaly_score", F.expr("floor(value * 100) % 1000 / 1000.0D"))
        .selectExpr(
            "event_id",
            "e AS ts",
            "stop_id",
            "direction_id",
            "anomaly_score",
            "CASE WHEN anomaly_score > 0.9D THEN 1 ELSE 0 END AS anomaly_flag",
            "cast(CASE WHEN k % 7 <> 0 THEN k * 8 - 400 END AS double) AS arrival_delay_t",
            "cast(k * 7 - 300 AS double) AS departure_delay_t",
        )
    )


def _hms(seconds: str) -> str:
    return (
        f"concat(lpad(cast({seconds} div 3600 AS string), 2, '0'), ':',"
        f" lpad(cast({seconds} div 60 % 60 AS string), 2, '0'), ':',"
        f" lpad(cast({seconds} % 60 AS string), 2, '0'))"
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_suppkey").alias("stop"))
        .withColumn("at", F.expr("(l_orderkey % 20 + l_linenumber) * 3600 + l_orderkey % 3600"))
    )
    return calls.selectExpr(
        "cast(l_orderkey AS string) AS trip_id",
        "cast(stop AS string) AS stop_id",
        f"{_hms('at')} AS arrival_time",
        f"{_hms('(at + 45)')} AS departure_time",
        "cast(l_linenumber AS string) AS stop_sequence",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS trip_id",
        "o_orderpriority AS service_id",
        "cast(o_custkey % 5 AS string) AS route_id",
    )


# The same views in the oracle's SQL, as named sub-queries.
ORACLE_VIEWS = {
    "ev": """
      SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS e, user_id, event_type, value,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             'S' || (user_id % 8) AS stop_id, CAST((user_id // 8) % 2 AS INTEGER) AS direction_id,
             CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) % 3600
               AS snapshot_minute
      FROM events""",
    "mins": "SELECT DISTINCT snapshot_minute FROM ev",
    "tu": """
      SELECT event_id, snapshot_minute, snapshot_minute AS snapshot_timestamp,
             'T' || (user_id % 2) || '_' || (e // 7200) AS trip_id,
             'R' || (user_id % 2) AS route_id, direction_id,
             '00:00:00' AS start_time, strftime(make_timestamp(e * 1000000), '%Y%m%d') AS start_date,
             'V' || (user_id % 5) AS vehicle_id,
             CAST(user_id % 8 + 1 AS INTEGER) AS stop_sequence, stop_id,
             snapshot_minute + CAST(floor(value * 30) AS BIGINT) AS arrival_time,
             CASE WHEN k % 11 <> 0 THEN snapshot_minute + CAST(floor(value * 30) AS BIGINT)
                  + 30 + k % 5 * 10 END AS departure_time,
             CASE WHEN k % 7 <> 0 THEN k * 8 - 400 END AS arrival_delay,
             k * 7 - 300 AS departure_delay
      FROM ev WHERE event_type <> 'error'""",
    "vp": """
      SELECT event_id, snapshot_minute, snapshot_minute - k % 90 AS snapshot_timestamp,
             stop_id, direction_id, 'V' || (user_id % 5) AS vehicle_id,
             round(value / 10, 3) AS latitude,
             CAST(k % 4 AS VARCHAR) AS congestion_level, CAST(k % 3 AS VARCHAR) AS occupancy_status
      FROM ev WHERE event_type = 'view'""",
    "al": """
      SELECT event_id, snapshot_minute, e AS snapshot_timestamp,
             'A' || (user_id % 20) AS alert_entity_id,
             e AS active_period_start,
             CASE WHEN k % 13 <> 0 THEN e + 600 + CAST(floor(value * 10) AS BIGINT) END
               AS active_period_end,
             'R' || (user_id % 2) AS route_id, CAST(k % 10 + 1 AS VARCHAR) AS cause
      FROM ev WHERE event_type = 'error'""",
    "sc": """
      SELECT event_id, e AS ts, stop_id, direction_id,
             CAST(CAST(floor(value * 100) AS BIGINT) % 1000 AS DOUBLE) / 1000.0 AS anomaly_score,
             CASE WHEN CAST(CAST(floor(value * 100) AS BIGINT) % 1000 AS DOUBLE) / 1000.0 > 0.9
                  THEN 1 ELSE 0 END AS anomaly_flag,
             CAST(CASE WHEN k % 7 <> 0 THEN k * 8 - 400 END AS DOUBLE) AS arrival_delay_t,
             CAST(k * 7 - 300 AS DOUBLE) AS departure_delay_t
      FROM ev""",
}
