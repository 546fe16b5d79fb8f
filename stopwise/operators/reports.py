"""Summaries of scores, feeds and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stopwise.functions import clock
from stopwise.operators.quantiles import exact_quantiles

HIGH_CONFIDENCE = 0.99


def station_rates(scored: DataFrame) -> DataFrame:
    """Flags, rows and share of flagged rows per station."""
    return scored.groupBy("stop_id").agg(
        F.sum("anomaly_flag").alias("total_anoms"),
        F.count("anomaly_flag").alias("total_snaps"),
        F.try_divide(F.sum("anomaly_flag"), F.count("anomaly_flag")).alias("rate"),
    )


def is_high(limit: float = HIGH_CONFIDENCE) -> Column:
    return F.col("anomaly_score") >= limit


def high_confidence(scored: DataFrame, limit: float = HIGH_CONFIDENCE) -> DataFrame:
    """Rows at or above a fixed score, per station."""
    return scored.groupBy("stop_id").agg(
        F.count_if(is_high(limit)).alias("n_high"),
        F.count(F.lit(1)).alias("total"),
        F.try_divide(F.count_if(is_high(limit)), F.count(F.lit(1))).alias("rate_high"),
    )


def top_anomalies(scored: DataFrame, n: int = 10) -> DataFrame:
    """The highest scores; earlier rows first on a tie."""
    return scored.orderBy(
        F.desc("anomaly_score"), "ts", "stop_id", "direction_id", *_extra_order(scored)
    ).limit(n)


def _extra_order(scored: DataFrame) -> list[str]:
    return [c for c in ("event_id", "seq") if c in scored.columns]


def rows_of_top_stations(
    scored: DataFrame, limit: float = HIGH_CONFIDENCE, n: int = 10
) -> DataFrame:
    """High-confidence rows of the ``n`` stations that have the most of them."""
    best = (
        high_confidence(scored, limit)
        .orderBy(F.desc("n_high"), "stop_id")
        .limit(n)
        .select("stop_id")
    )
    return scored.filter(is_high(limit)).join(best, "stop_id", "left_semi")


def station_timelines(scored: DataFrame, condition: Column | None = None) -> DataFrame:
    """Flagged times per station and UTC date, with the station's total.

    One list per station and day stays small however long the history is; a
    station's whole list is the lists of its days one after another.
    """
    chosen = scored.filter(condition if condition is not None else F.col("anomaly_flag") == 1)
    days = (
        chosen.withColumn("date", clock.utc_date("ts"))
        .groupBy("stop_id", "date")
        .agg(
            F.count(F.lit(1)).alias("n_day"),
            F.array_sort(F.collect_list("ts")).alias("snapshots_ts"),
        )
    )
    return days.withColumns(
        {
            "n_anomalies": F.sum("n_day").over(Window.partitionBy("stop_id")),
            "snapshots_dt": F.transform("snapshots_ts", clock.utc_time),
        }
    )


def driver_frequency(scored: DataFrame) -> DataFrame:
    """How often each feature is among the top contributions, from their JSON text."""
    pairs = F.from_json("shap_top3_json", "array<array<string>>")
    return (
        scored.select(F.explode(pairs).alias("pair"))
        .select(F.get("pair", F.lit(0)).alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("appearances"))
    )


def histogram(
    df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows per equal-width bin; without bounds, from smallest to largest value.

    The last bin includes the upper bound.
    """
    if low is None or high is None:
        ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
        ranged = df.withColumn("_ends", ends.select(F.struct("low", "high")).scalar())
        a, b = F.col("_ends.low"), F.col("_ends.high")
    else:
        ranged, a, b = df, F.lit(low), F.lit(high)
    place = F.floor((F.col(value) - a) / (b - a) * bins)
    return (
        ranged.filter(F.col(value).isNotNull() & F.col(value).between(a, b))
        .withColumn("bin", F.when(b == a, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_prevalence(labelled: DataFrame) -> DataFrame:
    """Positive labels, rows, and their share."""
    return labelled.agg(
        F.coalesce(F.sum("label"), F.lit(0)).alias("positives"),
        F.count(F.lit(1)).alias("total"),
        F.avg("label").alias("rate"),
    )


_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    long = _long(df, columns)
    stats = long.groupBy("column").agg(
        F.count("number").alias("count"),
        F.avg("number").alias("mean"),
        F.stddev_samp("number").alias("std"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    return stats.join(exact_quantiles(long, ["column"], "number", _QUARTILES), "column", "left")


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per row and column: the value as text and, for numeric columns, as number."""
    kinds = {f.name: f.dataType for f in df.schema}
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("string").alias("text"),
                (
                    F.col(c).cast("double")
                    if isinstance(kinds[c], T.NumericType)
                    else F.lit(None).cast("double")
                ).alias("number"),
            )
            for c in columns
        ]
    )
    return df.select(F.explode(cells).alias("cell")).select("cell.*")


def column_profile(df: DataFrame, n_samples: int = 10) -> DataFrame:
    """Type, presence, statistics, distinct values and a few samples of every column.

    Values are counted per column first; all that follows works on the counts.
    """
    long = _long(df, df.columns)
    values = long.groupBy("column", "text", "number").agg(F.count(F.lit(1)).alias("n"))
    present = values.filter("text IS NOT NULL")
    smallest = Window.partitionBy("column").orderBy("number", "text")
    samples = (
        present.withColumn("place", F.row_number().over(smallest))
        .filter(F.col("place") <= n_samples)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("s"))
        .select(
            "column",
            F.array_join(F.transform("s", lambda v: v["text"]), ", ").alias("sample_values"),
        )
    )
    presence = values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
        F.count("text").alias("n_unique"),
        F.round(
            100.0
            * F.sum(F.when(F.col("text").isNull(), F.col("n")).otherwise(0))
            / F.sum("n"),
            1,
        ).alias("pct_missing"),
    )
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    profile = presence.withColumn("dtype", types[F.col("column")])
    profile = profile.join(describe(df, numeric), "column", "left") if numeric else profile
    return profile.join(samples, "column", "left")


def column_presence(df: DataFrame, group: str = "feed_type", share: float = 0.5) -> DataFrame:
    """Columns filled in at least ``share`` of a group's rows."""
    columns = [c for c in df.columns if c != group]
    shares = df.groupBy(group).agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    return (
        shares.unpivot([group], columns, "column", "present_share")
        .filter(F.col("present_share") >= share)
    )


def presence_text(presence: DataFrame, group: str = "feed_type") -> DataFrame:
    """One line per column: the groups that fill it and how well."""
    item = F.concat(
        F.col(group), F.lit(" ("), F.round(F.col("present_share") * 100, 0).cast("int"), F.lit("% present)")
    )
    return presence.groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_list(item)), ", ").alias("feeds")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def headway_check(features: DataFrame) -> DataFrame:
    """PASS for every snapshot in which some headway is known."""
    return features.groupBy("snapshot_timestamp").agg(
        F.when(F.bool_or(F.col("headway_t").isNotNull()), "PASS").otherwise("FAIL").alias("result")
    )


def feature_null_rates(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and share of nulls per snapshot."""
    return features.groupBy("snapshot_timestamp").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(F.col(c).isNull().cast("int")).alias(f"{c}_null_rate") for c in columns],
    )


def non_null_shares(df: DataFrame, columns: Sequence[str], minimum: float = 0.95) -> DataFrame:
    """Share of filled rows per column and whether it reaches ``minimum``."""
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "column", "non_null_share").withColumn(
        "passes", (F.col("non_null_share") >= minimum).cast("int")
    )

