"""Windows over a long order, split into chunks.

A window without a (or with a coarse) partition key puts a whole history into one
task. Here the order is cut into chunks by a column that never decreases along
it (a day, an hour, a value range). Each chunk is windowed on its own, and what
flows over a chunk border comes from one summary row per chunk. The summaries
are small: their number is the number of chunks, not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def _over(part: list[str], order: list, reverse: bool = False) -> WindowSpec:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if reverse:
        cols = [c.desc() for c in cols]
    return Window.partitionBy(*part).orderBy(*cols)


def _before(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def _upto(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_carry(
    df: DataFrame,
    part: list[str],
    chunk: str,
    summary: Column,
    carry,
    reverse: bool = False,
) -> DataFrame:
    """Add ``_carry``: ``carry`` over the summaries of the chunks before a row's chunk."""
    keys = [*part, chunk]
    summaries = df.groupBy(*keys).agg(summary.alias("_s"))
    spec = _before(_over(part, [chunk], reverse))
    carried = summaries.select(*keys, carry(F.col("_s")).over(spec).alias("_carry"))
    return df.join(carried, keys, "left")


def with_position(
    df: DataFrame, part: list[str], chunk: str, order: list[str], out: str
) -> DataFrame:
    """Number the rows of each ``part`` from 1 in ``order``."""
    local = F.row_number().over(_over([*part, chunk], order))
    carried = _with_carry(df, part, chunk, F.count(F.lit(1)), F.sum)
    return carried.withColumn(
        out, (local + F.coalesce(F.col("_carry"), F.lit(0))).cast("long")
    ).drop("_carry")


def with_running_sum(
    df: DataFrame, part: list[str], chunk: str, order: list[str], value: Column, out: str
) -> DataFrame:
    """Sum of ``value`` from the start of ``part`` through the row."""
    local = F.sum(value).over(_upto(_over([*part, chunk], order)))
    carried = _with_carry(df, part, chunk, F.sum(value), F.sum)
    return carried.withColumn(out, local + F.coalesce(F.col("_carry"), F.lit(0))).drop("_carry")


def with_running_max(
    df: DataFrame, part: list[str], chunk: str, order: list[str], value: Column, out: str
) -> DataFrame:
    """Largest ``value`` from the start of ``part`` through the row."""
    local = F.max(value).over(_upto(_over([*part, chunk], order)))
    carried = _with_carry(df, part, chunk, F.max(value), F.max)
    return carried.withColumn(out, F.greatest(local, F.col("_carry"))).drop("_carry")


def with_last_known(
    df: DataFrame,
    part: list[str],
    chunk: str,
    order: list[str],
    value: Column,
    out: str,
    reverse: bool = False,
) -> DataFrame:
    """Latest non-null ``value`` at or before the row (at or after it with ``reverse``)."""
    local = F.last(value, ignorenulls=True).over(_upto(_over([*part, chunk], order, reverse)))
    pick = F.min_by if reverse else F.max_by
    edge = pick(value, F.when(value.isNotNull(), F.struct(*order)))
    carried = _with_carry(
        df, part, chunk, edge, lambda s: F.last(s, ignorenulls=True), reverse
    )
    return carried.withColumn(out, F.coalesce(local, F.col("_carry"))).drop("_carry")


def with_previous(
    df: DataFrame, part: list[str], chunk: str, order: list[str], value: Column, out: str
) -> DataFrame:
    """``value`` of the row before; null on the first row of ``part``."""
    boxed = F.struct(value.alias("v"))
    local = F.lag(boxed).over(_over([*part, chunk], order))
    carried = _with_carry(df, part, chunk, F.max_by(boxed, F.struct(*order)), F.last)
    return carried.withColumn(out, F.coalesce(local, F.col("_carry"))["v"]).drop("_carry")


def with_value_chunk(
    df: DataFrame, part: list[str], value: str, out: str, n_chunks: int = 128
) -> DataFrame:
    """Add a chunk number that never decreases with ``value`` and splits it evenly.

    The borders are approximate quantiles. They only balance the work; results
    built on the chunks stay exact.
    """
    shares = F.array(*[F.lit(i / n_chunks) for i in range(1, n_chunks)])
    borders = F.percentile_approx(value, shares, F.lit(10 * n_chunks)).alias("_borders")
    if part:
        with_borders = df.join(df.groupBy(*part).agg(borders), part)
    else:
        with_borders = df.withColumn("_borders", df.agg(borders).scalar())
    number = F.size(F.filter("_borders", lambda border: border <= F.col(value)))
    return with_borders.withColumn(out, number).drop("_borders")
