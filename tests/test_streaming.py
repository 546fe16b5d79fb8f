import json
import random

import feature_model as model
from pyspark.sql import functions as F
from test_features import START, TU, VP, assert_same, frame, stops_frame, update

from stopwise.config import DetectorConfig, FeatureConfig
from stopwise.functions import clock
from stopwise.plans import detect
from stopwise.plans.features import station_features
from stopwise.streaming.detect import DetectorStream, detector_stream, ledger_stream
from stopwise.streaming.features import FeatureStream, feature_stream
from stopwise.streaming.ingest import ingest_stream, replay_stream

NETWORK = {("R", 0): ["A", "B", "C"], ("R", 1): ["C", "B", "A"]}
USE = detect.DetectorInput(stations=None)


def small_feed(n=18):
    rng = random.Random(9)
    minutes = [START + 60 * i for i in range(n)]
    tu, vp = [], []
    for m in minutes:
        for (_, d), stops in NETWORK.items():
            for i, s in enumerate(stops):
                if rng.random() < 0.8:
                    tu.append(
                        update(m, m + rng.randint(0, 400), trip=f"T{d}{m // 120}", stop=s, direction=d,
                               stop_sequence=i + 1, delay=rng.randint(-50, 350))
                    )
        for _ in range(3):
            vp.append(dict(snapshot_minute=m, snapshot_timestamp=m, stop_id=rng.choice("ABC"), direction_id=0))
    return tu, vp, minutes


def name_of(minute):
    from datetime import datetime
    from zoneinfo import ZoneInfo

    return datetime.fromtimestamp(minute, ZoneInfo("Europe/London")).strftime("%Y_%d_%m_%H_%M_%S.json")


def write_minute(root, feed, minute, entities):
    folder = root / feed
    folder.mkdir(parents=True, exist_ok=True)
    doc = {"header": {"timestamp": minute}, "entity": entities}
    (folder / name_of(minute)).write_text(json.dumps(doc))


def write_updates(root, tu, minute):
    write_minute(root, "trip_updates", minute, [
        {"id": str(i), "trip_update": {
            "trip": {"trip_id": u["trip_id"], "route_id": "R", "direction_id": u["direction_id"],
                     "start_time": "0", "start_date": "0"},
            "stop_time_update": [{
                "stop_sequence": u["stop_sequence"], "stop_id": u["stop_id"],
                "arrival": {"time": u["arrival_time"], "delay": u["arrival_delay"]},
                "departure": {"time": u["departure_time"], "delay": u["departure_delay"]}}]}}
        for i, u in enumerate(tu) if u["snapshot_minute"] == minute
    ])


def write_vehicles(root, vp, minute):
    write_minute(root, "vehicle_positions", minute, [
        {"id": str(i), "vehicle": {"stop_id": v["stop_id"], "trip": {"direction_id": v["direction_id"]}}}
        for i, v in enumerate(vp) if v["snapshot_minute"] == minute
    ])


def test_feature_and_detector_streams_equal_the_batch(spark, tmp_path):
    tu, vp, minutes = small_feed()
    raw, out = tmp_path / "raw", f"{tmp_path}/out"
    stops = stops_frame(spark, NETWORK)
    cfg = FeatureConfig()

    def run():
        step = FeatureStream(spark, stops, out, f"{tmp_path}/state", cfg, allowed_lateness=120)
        feature_stream(spark, str(raw), step, f"{tmp_path}/cp").awaitTermination()
        return step

    for m in minutes[:9]:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
    run()
    # One vehicle file comes late but in time, one not at all, one after its minute closed.
    for m in minutes[9:]:
        write_updates(raw, tu, m)
        if m not in (minutes[9], minutes[12]):
            write_vehicles(raw, vp, m)
    step = run()
    write_vehicles(raw, vp, minutes[12])
    step = run()
    step.flush()

    closed = [m for m in minutes if m not in (minutes[9], minutes[12])]
    inside = set(closed)
    found = spark.read.parquet(f"{out}/features")
    wanted = model.run([u for u in tu if u["snapshot_minute"] in inside],
                       [v for v in vp if v["snapshot_minute"] in inside], closed, NETWORK)
    assert_same(found, wanted)
    late = spark.read.option("basePath", f"{out}/late").parquet(f"{out}/late")
    assert late.select("file_name").distinct().count() == 1

    small = DetectorConfig(n_trees=3, height=3, window_size=12, threshold_quantile=0.8, seed=5)
    names = detect.feature_names(found.drop("batch_id", "year", "month", "day"), USE)
    use = detect.DetectorInput(stations=None, features=names)
    whole = detect.score_features(found, small, use)
    schema = found.drop("batch_id", "year", "month", "day").schema
    # One file per batch of minutes, oldest first.
    ordered = f"{tmp_path}/ordered"
    for i in range(3):
        part = found.select(*schema.names).filter(
            f"snapshot_timestamp >= {minutes[6 * i]} AND snapshot_timestamp < {minutes[6 * i] + 360}"
        )
        part.coalesce(1).write.mode("append").parquet(ordered)
    scoring = DetectorStream(spark, f"{tmp_path}/scores", f"{tmp_path}/dstate", small, use)
    detector_stream(spark, ordered, schema, scoring, f"{tmp_path}/dcp", max_files=1).awaitTermination()
    names = ("ts", "stop_id", "direction_id", "seq", "anomaly_score", "anomaly_flag")
    got = sorted(tuple(r[n] for n in names) for r in spark.read.parquet(f"{tmp_path}/scores").collect())
    want = sorted(tuple(r[n] for n in names) for r in whole.collect())
    assert got == want
    assert len(got) > 30 and sum(r[-1] for r in got) > 0


def test_chained_streams_take_every_feature_step_once(spark, tmp_path):
    tu, vp, minutes = small_feed(12)
    raw, out = tmp_path / "raw", f"{tmp_path}/out"
    stops = stops_frame(spark, NETWORK)
    small = DetectorConfig(n_trees=3, height=3, window_size=12, threshold_quantile=0.8, seed=5)
    steps = []

    class Recorded(FeatureStream):
        def __call__(self, batch, batch_id):
            steps.append(batch_id)
            self.texts = [tuple(r) for r in batch.select("body", "file_name", "feed").collect()]
            super().__call__(batch, batch_id)

    def features():
        step = Recorded(spark, stops, out, f"{tmp_path}/state", FeatureConfig(), allowed_lateness=0)
        feature_stream(spark, str(raw), step, f"{tmp_path}/cp").awaitTermination()
        return step

    def scores(schema, use):
        step = DetectorStream(spark, f"{tmp_path}/scores", f"{tmp_path}/dstate", small, use, explain=F.lit(True))
        ledger_stream(spark, out, schema, step, f"{tmp_path}/dcp").awaitTermination()

    for m in minutes[:6]:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
    step = features()
    schema = spark.read.parquet(f"{out}/features/batch_id=0").drop("year", "month", "day").schema
    use = detect.DetectorInput(stations=None, features=detect.feature_names(spark.createDataFrame([], schema), USE))
    scores(schema, use)
    # The feature batch is repeated after the detector has read it.
    step(spark.createDataFrame(step.texts, "body string, file_name string, feed string"), steps[-1])
    scores(schema, use)
    for m in minutes[6:]:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
    step = features()
    scores(schema, use)
    step.flush()
    step.flush()
    scores(schema, use)

    found = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{out}/features")
    whole = detect.score_features(found, small, use, explain=F.lit(True))
    names = ("ts", "stop_id", "direction_id", "seq", "anomaly_score", "anomaly_flag", "shap_top3_json")
    got = sorted(tuple(r[n] for n in names) for r in spark.read.parquet(f"{tmp_path}/scores").collect())
    assert got == sorted(tuple(r[n] for n in names) for r in whole.collect())
    assert len(got) > 30 and all(r[-1] for r in got)


def test_every_document_is_accounted_for(spark, tmp_path):
    tu, vp, minutes = small_feed(6)
    raw, out = tmp_path / "raw", f"{tmp_path}/out"
    for m in minutes:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
    (raw / "trip_updates" / "noname.json").write_text(json.dumps({"entity": []}))
    (raw / "vehicle_positions" / name_of(minutes[2]).replace(".json", "x.json")).write_text("{}")
    broken = raw / "vehicle_positions" / name_of(minutes[1])
    broken.write_text("{not json")
    step = FeatureStream(spark, stops_frame(spark, NETWORK), out, f"{tmp_path}/state", FeatureConfig(), allowed_lateness=120)
    feature_stream(spark, str(raw), step, f"{tmp_path}/cp").awaitTermination()
    rejected = {(r.file_name, r.reason) for r in spark.read.parquet(f"{out}/rejected").collect()}
    assert (broken.name, "unreadable") in rejected and ("noname.json", "no minute") in rejected
    last = step.state.latest()
    pending = step.state.table(last, "pending").select("feed", "file_name").distinct().count()
    closed = step.state.meta(last)["closed"]
    done = sum(2 for m in minutes if m <= closed) - 1  # one of them was broken
    assert pending + done + len(rejected) == 2 * len(minutes) + 2


def test_ingest_stream_repeats_without_doubling(spark, tmp_path):
    tu, vp, minutes = small_feed(4)
    raw, out = tmp_path / "raw", f"{tmp_path}/out"
    for m in minutes:
        write_updates(raw, tu, m)
        write_vehicles(raw, vp, m)
    for checkpoint in ("one", "two"):  # the second run repeats batch 0 from the start
        ingest_stream(spark, str(raw), out, f"{tmp_path}/{checkpoint}",
                      feeds=("trip_updates", "vehicle_positions")).awaitTermination()
    assert spark.read.parquet(f"{out}/trip_updates").count() == len(tu)
    manifest = spark.read.parquet(f"{out}/manifest")
    assert manifest.filter("feed = 'vehicle_positions'").count() == 4
    table = spark.read.parquet(f"{out}/vehicle_positions")
    stream = replay_stream(spark, f"{out}/vehicle_positions", table.schema)
    query = stream.writeStream.format("memory").queryName("replayed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("replayed").count() == len(vp)


def test_clock_and_batch_features_agree_on_the_minute(spark):
    tu, vp, minutes = small_feed(3)
    rows = station_features(
        frame(spark, tu, TU), frame(spark, vp, VP),
        spark.createDataFrame([(m,) for m in minutes], "snapshot_minute long"),
        stops=stops_frame(spark, NETWORK),
    )
    local = rows.filter(rows.local_dt != clock.local_time("snapshot_timestamp", "Australia/Sydney"))
    assert local.count() == 0
