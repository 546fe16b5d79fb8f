"""Exact quantiles of large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators.ordered import with_running_sum, with_value_chunk


def exact_quantiles(df: DataFrame, by: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` per ``by``, one column per entry of ``qs``.

    Equal values are counted first; the counts get running totals over value
    chunks, and only the rows at the wanted ranks go on. No group is gathered.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    ranked = with_running_sum(
        with_value_chunk(counts, by, value, "_chunk"), by, "_chunk", [value], F.col("_n"), "_end"
    ).withColumn("_start", F.col("_end") - F.col("_n"))
    if by:
        ranked = ranked.join(totals, by)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())

    def rank_of(q: float):
        return (F.col("_total") - 1) * F.lit(float(q))

    def covers(rank):
        return (F.col("_start") <= rank) & (rank < F.col("_end"))

    wanted = F.lit(False)
    aggs = []
    for name, q in qs.items():
        rank = rank_of(q)
        low, high = F.floor(rank), F.ceil(rank)
        wanted = wanted | covers(low) | covers(high)
        a = F.max(F.when(covers(low), F.col(value).cast("double")))
        b = F.max(F.when(covers(high), F.col(value).cast("double")))
        frac = F.max(rank - low)
        aggs.append((a + (b - a) * frac).alias(name))
    return ranked.filter(wanted).groupBy(*by).agg(*aggs)
