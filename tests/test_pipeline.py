import pytest
from test_streaming import small_feed, write_minute, write_updates, write_vehicles

from stopwise.config import DetectorConfig
from stopwise.plans import pipeline
from stopwise.plans.detect import DetectorInput
from stopwise.sources.tables import ingest_feeds


def test_from_raw_files_to_metrics(spark, tmp_path):
    tu, vp, minutes = small_feed(10)
    raw = tmp_path / "raw"
    for m in minutes:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
        alert = {"active_period": [{"start": m, "end": m + 60}], "informed_entity": [{"route_id": "R"}], "cause": 9 if m % 120 else 3}
        write_minute(raw, "alerts", m, [{"id": str(m), "alert": alert}])
    p = f"{tmp_path}/processed"
    ingest_feeds(spark, str(raw), p)
    feats = pipeline.generate_features(spark, p, f"{tmp_path}/feats", minutes[1], minutes[8])
    assert {r[0] for r in feats.select("snapshot_timestamp").distinct().collect()} == set(minutes[1:9])
    assert feats.count() == 8 * 6
    cfg = DetectorConfig(n_trees=3, height=3, window_size=8, threshold_quantile=0.5, seed=1)
    use = DetectorInput(stations=None)
    summary = pipeline.detect_anomalies(
        spark, f"{tmp_path}/feats", f"{tmp_path}/scores", minutes[1], minutes[8], cfg, use
    ).first()
    assert summary.snapshots <= 7 and summary.anomalies > 0
    row = pipeline.evaluate_against_alerts(spark, f"{tmp_path}/scores", p).first()
    assert 0 <= row.lead_time_roc_auc <= 1
    assert pipeline.evaluate_against_alerts(spark, f"{tmp_path}/scores", p, True).first().fpr == 0.0
    grid = {"n_trees": [3], "height": [3], "window_size": [8], "threshold_quantile": [0.5, 0.8]}
    results = pipeline.tune(
        spark, f"{tmp_path}/feats", grid, minutes[1], minutes[9], f"{tmp_path}/results",
        f"{tmp_path}/csv", f"{tmp_path}/best", use=use,
    )
    assert results.count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    assert spark.read.json(f"{tmp_path}/best").count() == 1
    assert pipeline.settings_table(spark, cfg).first().n_trees == 3


def test_a_range_run_again_leaves_no_old_rows(spark, tmp_path):
    from stopwise.sources import tables

    day, path = 86400, f"{tmp_path}/t"
    stored = lambda: sorted((r.snapshot_timestamp, r.v) for r in spark.read.parquet(path).collect())
    frame = lambda rows: spark.createDataFrame(rows, "snapshot_timestamp long, v int")
    first = [(day * d + 3600 * h, 1) for d in range(1, 6) for h in (1, 12)]
    tables.write_by_date(frame(first), path, zone="UTC")
    start, end = 2 * day + 7200, 5 * day + 7200  # begins and ends within a date
    tables.replace_range(frame([(3 * day, 2)]), path, start, end, zone="UTC")
    outside = [r for r in first if not start <= r[0] <= end]
    assert stored() == sorted([*outside, (3 * day, 2)])  # day 4, inside, is empty now
    tables.replace_range(frame([]), path, day, 2 * day - 1, zone="UTC")  # a whole date, without a row
    assert stored() == sorted([r for r in outside if r[0] >= 2 * day] + [(3 * day, 2)])
    tables.replace_range(frame([(9 * day, 3)]), path, None, None, zone="UTC")
    assert stored() == [(9 * day, 3)]


def test_routes_of_the_readable_files(spark, tmp_path):
    tu, vp, minutes = small_feed(6)
    for m in minutes:
        write_updates(tmp_path / "raw", tu, m)
        write_vehicles(tmp_path / "raw", vp, m)
    p = tmp_path / "processed"
    ingest_feeds(spark, f"{tmp_path}/raw", str(p))
    whole = pipeline.generate_features(spark, str(p), f"{tmp_path}/whole", minutes[1], minutes[4])
    far = p / "trip_updates/year=2001/month=01/day=01"
    far.mkdir(parents=True)
    (far / "part-broken.parquet").write_bytes(b"PAR1 no table PAR1")
    some = pipeline.generate_features(spark, str(p), f"{tmp_path}/some", minutes[1], minutes[4], skip_unreadable=True)
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        pipeline.generate_features(spark, str(p), f"{tmp_path}/none", minutes[1], minutes[4])
