import random
from bisect import bisect_left

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.config import DetectorConfig
from stopwise.operators import spacetrees, thresholds
from stopwise.plans import detect, state, tune

SCHEMA = (
    "snapshot_timestamp long, stop_id string, direction_id int, arrival_delay_t double,"
    " departure_delay_t double, headway_t double"
)
START = 1_743_865_200  # 2025-04-06 02:00 in Sydney, an hour before the clock goes back
USE = detect.DetectorInput(stations=["A", "B", "7"])


def feature_rows(n, seed=0, step=60):
    rng = random.Random(seed)
    return [
        (START + step * i, stop, d, rng.choice((0.0, 0.3, 0.7, 0.9)), rng.random(), rng.random() + 0.01)
        for i in range(n)
        for stop in ("A", "B")
        for d in (0, 1)
    ]


def one_by_one(rows, cfg):
    """Scores and flags with masses updated row by row."""
    feature, split = spacetrees.build_trees(cfg.n_trees, cfg.height, 3, cfg.seed, cfg.lower, cfg.upper)
    out, day = [], None
    for row in sorted(rows):
        import datetime
        from zoneinfo import ZoneInfo

        local = datetime.datetime.fromtimestamp(row[0], ZoneInfo("Australia/Sydney"))
        today = (local.replace(tzinfo=None) - datetime.timedelta(hours=3)).date()
        if today != day:
            day, seen, scores = today, 0, []
            ref = np.zeros((cfg.n_trees, 2 << cfg.height))
            cur, ready = ref.copy(), False
        x, raw, paths = row[3:], 0.0, []
        for t in range(cfg.n_trees):
            node, going = 1, True
            for depth in range(cfg.height + 1):
                paths.append((t, node))
                if going:
                    raw += ref[t, node] * 2.0**depth
                    going = ref[t, node] >= 0.1 * cfg.window_size
                if depth < cfg.height:
                    node = 2 * node + int(x[feature[t, node]] >= split[t, node])
        top = cfg.n_trees * cfg.window_size * (2.0 ** (cfg.height + 1) - 1)
        score = 1 - raw / top if ready else 0.0
        seen += 1
        scores = (scores + [score])[-cfg.window_size :]
        flag = int(seen >= cfg.window_size and score > np.quantile(scores, cfg.threshold_quantile))
        out.append((*row[:3], score, flag))
        for t, node in paths:
            cur[t, node] += 1
        if seen % cfg.window_size == 0:
            ref, cur, ready = cur, np.zeros_like(cur), True
    return out


@pytest.mark.parametrize("psi", [7, 30, 64])
def test_scores_and_flags_equal_a_row_by_row_run(spark, psi, monkeypatch):
    monkeypatch.setattr(spacetrees, "GROUP_ROWS", 100)
    cfg = DetectorConfig(n_trees=5, height=4, window_size=psi, threshold_quantile=0.9, seed=3)
    rows = feature_rows(180)  # crosses 03:00
    found = detect.score_features(spark.createDataFrame(rows, SCHEMA).repartition(5), cfg, USE)
    got = sorted((r.ts, r.stop_id, r.direction_id, r.anomaly_score, r.anomaly_flag) for r in found.collect())
    want = sorted(one_by_one(rows, cfg))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)
    assert [g[4] for g in got] == [w[4] for w in want]
    assert sum(w[4] for w in want) > 0
    assert all(0 <= g[3] <= 1 for g in got)


def test_station_list_and_zero_rows(spark):
    rows = [(START, "A", 0, 0.0, 0.0, 0.0), (START, "A", 1, None, 5.0, None), (START, "Z", 0, 1.0, 1.0, 1.0), (START, "7", 0, 1.0, 0.0, 0.0)]
    found = detect.score_features(spark.createDataFrame(rows, SCHEMA), DetectorConfig(window_size=10), USE)
    assert sorted((r.stop_id, r.direction_id) for r in found.collect()) == [("7", 0), ("A", 1)]


def test_no_flags_while_warming_up(spark):
    rows = [(START + 60 * i, "A", 0, 0.5, 0.5, 0.5) for i in range(10)]
    found = detect.score_features(spark.createDataFrame(rows, SCHEMA), DetectorConfig(window_size=10), USE)
    assert found.agg(F.sum("anomaly_flag")).first()[0] == 0


def test_rows_are_numbered_from_one_after_three_in_the_morning(spark):
    # 02:10 comes twice that night, then 03:10.
    rows = [(START + 3600 * i + 600, "A", 0, 1.0, 1.0, 1.0) for i in range(3)]
    found = detect.score_features(spark.createDataFrame(rows, SCHEMA), DetectorConfig(window_size=10), USE)
    assert [r.seq for r in found.orderBy("ts").collect()] == [1, 2, 1]


def test_rank_rule_equals_the_quantile():
    rng = random.Random(1)
    for n, q in ((10, 0.9), (33, 0.97), (50, 0.5)):
        scores = np.array([rng.choice((0.1, 0.2, 0.3, 0.4, rng.random())) for _ in range(300)])
        ranks = thresholds.smaller_in_window(scores, n)
        for i in range(n - 1, 300):
            window = scores[i - n + 1 : i + 1]
            assert ranks[i] == bisect_left(sorted(window), scores[i])
            assert (scores[i] > np.quantile(window, q)) == (ranks[i] >= int((n - 1) * q) + 1)


def test_explanation_ranks_features_by_change(spark):
    cfg = DetectorConfig(n_trees=6, height=4, window_size=20, seed=3)
    found = detect.score_features(
        spark.createDataFrame(feature_rows(30), SCHEMA), cfg, USE, explain=F.col("arrival_delay_t") > 0.5
    )
    rows = found.filter("top_features IS NOT NULL").collect()
    assert rows and found.filter("top_features IS NULL").count() > 0
    for r in rows:
        sizes = [abs(t.contribution) for t in r.top_features]
        assert len(sizes) == 3 and sizes == sorted(sizes, reverse=True)
        assert r.shap_top3_json.startswith('[["')


def test_saved_detector_continues_where_it_stopped(spark, tmp_path):
    cfg = DetectorConfig(n_trees=4, height=3, window_size=16, threshold_quantile=0.8, seed=3)
    rows = feature_rows(60)
    whole = detect.score_features(spark.createDataFrame(rows, SCHEMA), cfg, USE)
    want = {(r.ts, r.stop_id, r.direction_id): (r.anomaly_score, r.anomaly_flag, r.seq) for r in whole.collect()}
    detector, got = state.Detector(cfg, USE), {}
    for part in (rows[:84], rows[84:88], rows[88:]):
        scores, detector = detector.score(spark.createDataFrame(part, SCHEMA))
        got |= {(r.ts, r.stop_id, r.direction_id): (r.anomaly_score, r.anomaly_flag, r.seq) for r in scores.collect()}
        path = f"{tmp_path}/{len(got)}"
        state.save_detector(detector, ["arrival_delay_t", "departure_delay_t", "headway_t"], path)
        detector = state.load_detector(spark, path)
        assert detector.carried.count() <= 4 * cfg.window_size
    assert got == want
    assert spark.read.parquet(f"{path}/hst_tree").count() == 4 * 7


def test_grid_scores_once_per_structure_and_keeps_results(spark, tmp_path):
    grid = {"n_trees": [3], "height": [3], "window_size": [10, 20], "threshold_quantile": [0.5, 0.8],
            "subsample_size": [128, 256], "seed": 3}
    assert len(tune.expand_grid(grid)) == 4
    assert len(tune.expand_grid(grid, limit=3)) == 3
    feats = spark.createDataFrame([(*r[:3], r[3] * 200, *r[4:]) for r in feature_rows(40)], SCHEMA)
    path = f"{tmp_path}/results"
    first = tune.grid_search(feats, grid, USE, results_path=path, data_version="1").collect()
    again = tune.grid_search(feats, grid, USE, results_path=path, data_version="1").collect()
    assert sorted(first) == sorted(again) and len(first) == 4
    aucs = {}
    for r in first:
        aucs.setdefault(r.window_size, set()).add(round(r.lead_time_roc_auc, 12))
    assert all(len(v) == 1 for v in aucs.values())
    best = tune.best_config(spark.read.parquet(path)).first()
    assert best.lead_time_roc_auc == max(r.lead_time_roc_auc for r in first)


def test_kept_results_belong_to_their_rows_and_columns(spark, tmp_path):
    from dataclasses import replace

    feats = spark.createDataFrame([(*r[:3], r[3] * 200, *r[4:]) for r in feature_rows(40)], SCHEMA)
    some = sorted(r[0] for r in feats.select("stop_id").distinct().collect())[:1]
    grid, path = {"n_trees": [3], "height": [3], "window_size": [10], "seed": 3}, f"{tmp_path}/results"
    one_stop = replace(USE, stations=some)

    def run(rows, use, kept=path):
        return tune.grid_search(rows, grid, use, results_path=kept).drop("config_id").collect()

    run(feats, USE)
    assert run(feats, one_stop) == run(feats, one_stop, None)
    less = feats.where("snapshot_timestamp % 120 = 0")
    assert run(less, USE) == run(less, USE, None)
    assert spark.read.parquet(path).count() == 3


def test_grid_without_rows_gives_zero_metrics(spark):
    feats = spark.createDataFrame([], SCHEMA)
    rows = tune.grid_search(feats, {"window_size": [10]}, USE).collect()
    assert [(r.lead_time_roc_auc, r.precision_at_k, r.mttd, r.fpr) for r in rows] == [(0.0, 0.0, None, 0.0)]


def test_settings_ignore_what_has_no_effect(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("n_trees: 7\nsubsample_size: 256\nwarmup_days: 4\n")
    assert DetectorConfig.from_yaml(str(path)) == DetectorConfig(n_trees=7)
    with pytest.raises(TypeError):
        DetectorConfig.from_mapping({"n_tree": 7})


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
@pytest.mark.parametrize("window", [1, 3, 64, 1000])
def test_ranks_in_sliding_windows(n, window):
    scores = np.random.default_rng(n).integers(0, 12, n) / 7.0  # many ties
    want = [int((scores[max(0, i - window + 1) : i + 1] < scores[i]).sum()) for i in range(n)]
    assert thresholds.smaller_in_window(scores, window).tolist() == want


def test_ranks_of_a_large_window_take_no_row_loop():
    import time

    scores = np.random.default_rng(1).random(200_000)
    start = time.perf_counter()
    ranks = thresholds.smaller_in_window(scores, 10_000)
    assert time.perf_counter() - start < 5
    for i in (0, 9_999, 10_000, 123_456):
        assert ranks[i] == (scores[max(0, i - 9_999) : i + 1] < scores[i]).sum()


def test_one_shuffle_of_the_rows_for_each_window_size(spark):
    rows = spark.createDataFrame(
        [("2025-04-06", k, "A", 0, k + 1, 0.5) for k in range(40)], "day string, ts long, stop_id string, direction_id int, seq long, f double"
    )
    cfgs = {c.structure_id: c for c in (DetectorConfig(n_trees=t, height=h, window_size=w) for t in (2, 3) for h in (2, 3) for w in (5, 8))}
    scored = detect.score_numbered(rows, ["f"], cfgs)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert len(cfgs) == 8 and plan.count("Exchange hashpartitioning") == 2 and plan.count("FlatMapGroupsInPandas") == 2
    assert scored.count() == 40 * 8
