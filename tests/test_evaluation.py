import pytest
from pyspark.sql import functions as F

from stopwise.operators import labels, metrics, ordered, quantiles, reports

SCORES = "ts long, stop_id string, direction_id int, anomaly_score double, anomaly_flag int, arrival_delay_t double, departure_delay_t double"


@pytest.fixture
def scored(spark):
    rows = [
        (0, "A", 0, 0.05, 0, 0.0, 0.0),
        (60, "A", 0, 0.1, 0, 130.0, 0.0),
        (120, "A", 0, 0.9, 1, 140.0, 0.0),
        (180, "A", 0, 0.8, 1, 0.0, 150.0),
        (240, "A", 0, 0.2, 0, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, SCORES)


def listed(df, column, order="ts"):
    return [r[column] for r in df.orderBy(order).collect()]


def test_lead_labels(spark, scored):
    events = spark.createDataFrame(
        [("e", 60, 180, "1"), ("open", 0, None, "1")],
        "alert_entity_id string, active_period_start long, active_period_end long, cause string",
    )
    assert listed(labels.label_scores(scored, events, 60), "label") == [1, 1, 1, 1, 0]
    assert listed(labels.label_scores(scored, events, 0), "label") == [0, 1, 1, 1, 0]
    assert listed(labels.label_scores(scored, events.limit(0), 60), "label") == [0] * 5


def test_delay_labels(scored):
    assert listed(labels.label_delays(scored, 120), "label") == [0, 1, 1, 1, 0]
    assert listed(labels.label_delays(scored, 160), "label") == [0] * 5
    bare = scored.drop("arrival_delay_t", "departure_delay_t")
    assert listed(labels.label_delays(bare, 0), "label") == [0] * 5
    early = scored.withColumn("arrival_delay_t", -F.col("arrival_delay_t"))
    assert listed(labels.label_delays(early, 120, two_sided=True), "label") == [0, 1, 1, 1, 0]


def test_metrics_of_the_small_case(scored):
    row = metrics.evaluate(scored, delay_threshold=120, k=1).first()
    assert row.lead_time_roc_auc == pytest.approx(5 / 6)
    assert (row.precision_at_k, row.mttd, row.fpr) == (1.0, 1.0, 0.0)


def test_single_class_and_empty_input(scored):
    row = metrics.evaluate(scored, delay_threshold=1000).first()
    assert (row.lead_time_roc_auc, row.precision_at_k, row.mttd) == (0.0, 0.0, None)
    assert row.fpr == pytest.approx(2 / 5)
    row = metrics.evaluate(scored.limit(0), delay_threshold=120).first()
    assert (row.lead_time_roc_auc, row.precision_at_k, row.mttd, row.fpr) == (0.0, 0.0, None, 0.0)
    assert metrics.evaluate(scored).first().mttd is None


def test_detection_needs_a_flag_unless_told_otherwise(spark, scored):
    events = spark.createDataFrame(
        [("e", 30, 180, "1"), ("f", 200, 230, "1")],
        "alert_entity_id string, active_period_start long, active_period_end long, cause string",
    )
    assert metrics.mttd_events(scored, events).first()[0] == pytest.approx(1.5)
    assert metrics.mttd_events(scored, events, any_row=True).first()[0] == pytest.approx(0.5)


def test_planned_works_compare_causes_as_text(spark, scored):
    alerts = spark.createDataFrame(
        [(0, "a", 0, 1, "9"), (0, "b", 0, 1, "1"), (0, "c", 0, 1, None)],
        "snapshot_timestamp long, alert_entity_id string, active_period_start long, active_period_end long, cause string",
    )
    kept = labels.without_planned(labels.build_events(alerts))
    assert sorted(r.alert_entity_id for r in kept.collect()) == ["b", "c"]
    assert labels.outside_planned_days(scored, alerts).count() == 0


def test_chunked_windows_equal_plain_ones(spark):
    from pyspark.sql.window import Window

    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 37 % 500).alias("t"),
        F.when(F.col("id") % 4 == 0, F.col("id") * 7 % 11).alias("v"),
    ).withColumn("c", F.floor(F.col("t") / 30))
    w = Window.partitionBy("g").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    value = F.col("v")
    cases = {
        "position": (ordered.with_position(df, ["g"], "c", ["t"], "o"), F.row_number().over(w)),
        "sum": (ordered.with_running_sum(df, ["g"], "c", ["t"], F.coalesce("v", F.lit(0)), "o"), F.sum(F.coalesce("v", F.lit(0))).over(upto)),
        "max": (ordered.with_running_max(df, ["g"], "c", ["t"], value, "o"), F.max("v").over(upto)),
        "last": (ordered.with_last_known(df, ["g"], "c", ["t"], value, "o"), F.last("v", ignorenulls=True).over(upto)),
        "next": (ordered.with_last_known(df, ["g"], "c", ["t"], value, "o", reverse=True), F.first("v", ignorenulls=True).over(after)),
        "previous": (ordered.with_previous(df, ["g"], "c", ["t"], value, "o"), F.lag("v").over(w)),
    }
    for name, (chunked, plain) in cases.items():
        got = sorted((r.g, r.t, r.o) for r in chunked.collect())
        want = sorted((r.g, r.t, r.o) for r in df.withColumn("o", plain).collect())
        assert got == want, name


def test_exact_quantiles_with_one_heavy_value(spark):
    import numpy as np

    values = [5.0] * 400 + [float(i * i % 997) for i in range(600)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "k string, v double")
    found = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.37, "m": 0.5}).collect()}
    assert found["a"].q == pytest.approx(np.quantile(values, 0.37))
    assert found["a"].m == pytest.approx(np.quantile(values, 0.5))
    assert found["b"].q == 1.0
    assert quantiles.exact_quantiles(df.select("v"), [], "v", {"q": 0.9}).first()[0] == pytest.approx(np.quantile(values + [1.0], 0.9))


def test_histogram_includes_the_upper_end(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (None,)], "x double")
    assert {r.bin: r.n for r in reports.histogram(df, "x", 2).collect()} == {0: 1, 1: 2}
    assert {r.bin: r.n for r in reports.histogram(df, "x", 4, 0.0, 1.0).collect()} == {0: 1, 2: 1, 3: 1}


def test_presence_text(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("b", None, None)], "feed_type string, x int, y int")
    lines = {r["column"]: r.feeds for r in reports.presence_text(reports.column_presence(df)).collect()}
    assert lines == {"x": "a (100% present)", "y": "a (50% present)"}
