"""Quality of scores against labels. Every metric can be taken per group ``by``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.functions import clock
from stopwise.operators import labels
from stopwise.operators.ordered import (
    with_last_known,
    with_previous,
    with_running_sum,
    with_value_chunk,
)

_HOUR = 3600
_DAY = 86400
_ROW_ORDER = ["ts", "stop_id", "direction_id"]


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with tied scores counted half; 0 with a single class.

    Rows are reduced to one per distinct score before anything is put in order.
    """
    by = list(by)
    steps = scored.groupBy(*by, "anomaly_score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranked = with_running_sum(
        with_value_chunk(steps, by, "anomaly_score", "_chunk"),
        by,
        "_chunk",
        ["anomaly_score"],
        F.col("neg"),
        "_upto",
    )
    won = F.sum(F.col("pos").cast("double") * (F.col("_upto") - F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*by).agg(
        F.coalesce(F.try_divide(won, F.nullif(pairs, F.lit(0.0))), F.lit(0.0)).alias(
            "lead_time_roc_auc"
        )
    )


def precision_at_k(scored: DataFrame, k: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Mean over UTC dates of the share of labels among the ``k`` highest scores."""
    daily = [*by, "_date"]
    best = Window.partitionBy(*daily).orderBy(F.desc("anomaly_score"), *_ROW_ORDER)
    top = (
        scored.withColumn("_date", clock.utc_date("ts"))
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= k)
    )
    per_day = top.groupBy(*daily).agg(F.avg("label").alias("_share"))
    return per_day.groupBy(*by).agg(
        F.coalesce(F.avg("_share"), F.lit(0.0)).alias("precision_at_k")
    )


def false_positive_rate(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    fp = F.count_if((F.col("label") == 0) & (F.col("anomaly_flag") == 1))
    tn = F.count_if((F.col("label") == 0) & (F.col("anomaly_flag") == 0))
    return scored.groupBy(*by).agg(
        F.coalesce(F.try_divide(fp.cast("double"), (fp + tn).cast("double")), F.lit(0.0)).alias(
            "fpr"
        )
    )


def first_detections(
    scored: DataFrame, events: DataFrame, any_row: bool = False, scope: Sequence[str] = ()
) -> DataFrame:
    """Each event with the time of the first flagged row inside it, if any.

    Event starts and detection times are put in one order; the next detection
    after a start is looked up and then tested against the end.
    """
    scope = list(scope)
    hits = scored if any_row else scored.filter("anomaly_flag = 1")
    times = hits.select(*scope, F.col("ts").alias("_t")).distinct()
    line = (
        events.filter("active_period_start IS NOT NULL AND active_period_end IS NOT NULL")
        .withColumns({"_t": F.col("active_period_start"), "_place": F.lit(0)})
        .unionByName(
            times.withColumns({"_place": F.lit(1), "_hit": F.col("_t")}), allowMissingColumns=True
        )
        .withColumn("_chunk", F.floor(F.col("_t") / _DAY))
    )
    looked = with_last_known(
        line, scope, "_chunk", ["_t", "_place"], F.col("_hit"), "_next", reverse=True
    )
    return looked.filter("_place = 0").select(
        *events.columns,
        F.when(F.col("_next") <= F.col("active_period_end"), F.col("_next")).alias("detected_at"),
    )


def mttd_events(
    scored: DataFrame, events: DataFrame, any_row: bool = False, scope: Sequence[str] = ()
) -> DataFrame:
    """Mean minutes from event start to first detection; null when nothing was found."""
    found = first_detections(scored, events, any_row, scope)
    return found.groupBy(*scope).agg(
        F.avg((F.col("detected_at") - F.col("active_period_start")) / 60.0).alias("mttd")
    )


def label_runs(
    labelled: DataFrame, by: Sequence[str] = (), across: str = "station"
) -> DataFrame:
    """Runs of consecutive positive labels with their start and first flag.

    ``across="network"`` takes all stations' rows as one sequence.
    """
    part = [*by] if across == "network" else [*by, "stop_id", "direction_id"]
    order = _ROW_ORDER if across == "network" else ["ts"]
    # All stations of an hour, or one station's day.
    length = _HOUR if across == "network" else _DAY
    rows = labelled.withColumn("_chunk", F.floor(F.col("ts") / length))
    rows = with_previous(rows, part, "_chunk", order, F.col("label"), "_before")
    opens = ((F.col("label") == 1) & (F.coalesce("_before", F.lit(0)) == 0)).cast("int")
    rows = with_running_sum(
        rows.withColumn("_opens", opens), part, "_chunk", order, F.col("_opens"), "run"
    )
    return (
        rows.filter("label = 1")
        .groupBy(*part, "run")
        .agg(
            F.min("ts").alias("started_at"),
            F.min(F.when(F.col("anomaly_flag") == 1, F.col("ts"))).alias("flagged_at"),
        )
    )


def mttd_flags(
    labelled: DataFrame, by: Sequence[str] = (), across: str = "station"
) -> DataFrame:
    """Mean minutes from the start of a run of labels to its first flagged row."""
    runs = label_runs(labelled, by, across)
    return runs.groupBy(*by).agg(
        F.avg((F.col("flagged_at") - F.col("started_at")) / 60.0).alias("mttd")
    )


METRICS = ("lead_time_roc_auc", "precision_at_k", "mttd", "fpr")


def _side_by_side(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """Metrics of separate tables in one row per group."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*by).agg(*[F.max(m).alias(m) for m in METRICS])


def evaluate(
    scored: DataFrame,
    events: DataFrame | None = None,
    k: int = 50,
    lead_time: int = 900,
    delay_threshold: float | None = None,
    by: Sequence[str] = (),
    any_row: bool = False,
    across: str = "station",
) -> DataFrame:
    """The four metrics, against delays if a threshold is given, else against events.

    With events, ``by`` must be columns both tables have.
    """
    by = list(by)
    if delay_threshold is not None:
        labelled = labels.label_delays(scored, delay_threshold)
        mttd = mttd_flags(labelled, by, across)
    elif events is not None:
        labelled = labels.label_scores(scored, events, lead_time, by)
        mttd = mttd_events(labelled, events, any_row, by)
    else:
        labelled = scored.withColumn("label", F.lit(0))
        mttd = labelled.groupBy(*by).agg(F.lit(None).cast("double").alias("mttd"))
    return _side_by_side(
        [
            roc_auc(labelled, by),
            precision_at_k(labelled, k, by),
            mttd,
            false_positive_rate(labelled, by),
        ],
        by,
    )
