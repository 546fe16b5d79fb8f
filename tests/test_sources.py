import json
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from stopwise.functions import clock
from stopwise.schemas import TABLE_SCHEMAS
from stopwise.sources import documents, static, tables


def stop_time(stop, seq, at=None, delay=None):
    row = {"stop_id": stop, "stop_sequence": seq}
    if at is not None:
        row["arrival"] = {"time": at} if delay is None else {"time": at, "delay": delay}
    return row


def trip_document(ts, stops=(), **trip):
    base = {"trip_id": "T", "route_id": "R", "start_time": "08:00:00", "start_date": "20250306"}
    return {
        "header": {"timestamp": ts},
        "entity": [
            {"id": "1", "trip_update": {"trip": {**base, **trip}, "stop_time_update": list(stops)}},
            {"id": "2", "vehicle": {"stop_id": "X"}},
        ],
    }


def write(path, name, content):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(content if isinstance(content, str) else json.dumps(content))


def parsed(spark, feed, *docs):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "body string")
    return documents.parse_documents(texts, "body", feed)


@pytest.mark.parametrize("feed", ["alerts", "trip_updates", "vehicle_positions"])
def test_empty_and_header_only_documents_keep_the_schema(spark, feed):
    docs = parsed(spark, feed, {"header": {"timestamp": 0}, "entity": []}, {"header": {"timestamp": 0}})
    flat = documents.flatten(docs, feed)
    assert flat.columns == TABLE_SCHEMAS[feed].names
    assert flat.count() == 0


def test_trip_update_defaults(spark):
    doc = trip_document(5, [stop_time("A", 1), stop_time("B", 2, 100, 7.0)])
    rows = documents.flatten(parsed(spark, "trip_updates", doc), "trip_updates").collect()
    assert [(r.stop_id, r.direction_id, r.arrival_time, r.arrival_delay, r.departure_delay) for r in rows] == [
        ("A", 0, None, 0, 0),
        ("B", 0, 100, 7, 0),
    ]


def test_alerts_are_periods_times_entities(spark):
    alert = {
        "active_period": [{"start": 1, "end": 2}, {"start": 3}, {}],
        "informed_entity": [{"agency_id": "a"}, {"route_id": "r", "direction_id": 1}],
        "cause": 9,
        "header_text": {"translation": [{"text": "x"}, {"text": "y"}]},
    }
    docs = [
        {"header": {"timestamp": 1}, "entity": [{"id": i, "alert": a}]}
        for i, a in (
            ("three", alert),
            ("none", {**alert, "active_period": []}),
            ("open", {k: v for k, v in alert.items() if k != "active_period"}),
            ("nobody", {**alert, "informed_entity": []}),
        )
    ]
    flat = documents.flatten(parsed(spark, "alerts", *docs), "alerts")
    counts = {r[0]: r[1] for r in flat.groupBy("alert_entity_id").count().collect()}
    assert counts == {"three": 6, "open": 2}
    first = flat.filter("alert_entity_id = 'open'").first()
    assert (first.active_period_start, first.cause, first.header_text, first.description_text, first.url) == (
        None, "9", "x y", "", None,
    )


def test_incomplete_rows_are_set_aside(spark):
    good, bad = trip_document(5, [stop_time("A", 1)]), trip_document(5, [stop_time("A", None)])
    docs = parsed(spark, "trip_updates", good, bad)
    docs = docs.withColumns({"file_name": F.lit("f"), "snapshot_minute": F.lit(0)})
    assert documents.flatten(docs, "trip_updates").count() == 1
    assert documents.rejected(docs, "trip_updates").count() == 1
    seen = documents.manifest(docs, "trip_updates").first()
    assert (seen.n_rows, seen.n_rejected) == (1, 1)


@pytest.fixture
def raw(tmp_path):
    for minute, stops in ((49, [stop_time("A", 1, 9)]), (50, []), (51, [stop_time("B", 2, 9)])):
        name = f"2025_06_03_16_{minute}_00.json"
        ts = int(datetime(2025, 3, 6, 16, minute, 56, tzinfo=timezone.utc).timestamp())
        write(tmp_path / "raw/trip_updates", name, trip_document(ts, stops))
    write(tmp_path / "raw", "my_vehicle_position_now.json",
          {"header": {"timestamp": 1741279740}, "entity": [{"id": "v", "vehicle": {"stop_id": "A", "congestion_level": 2}}]})
    return tmp_path


def test_ingest_finds_filters_and_writes(spark, raw):
    root, out = f"{raw}/raw", f"{raw}/out"
    assert documents.find_feed_files(spark, root, "alerts") is None
    lost = tables.ingest_feeds(spark, root, out)
    assert lost == {"trip_updates": 0, "vehicle_positions": 0}
    assert {r.feed_type for r in tables.load_feeds(spark, out).collect()} == set(lost)
    manifest = spark.read.parquet(f"{out}/manifest")
    minutes = sorted(r[0] for r in tables.snapshot_minutes(manifest).collect())
    assert [clock_text(m) for m in minutes] == ["16:49", "16:50", "16:51"]
    pairs = {r.snapshot_minute: r.status for r in tables.paired_minutes(manifest).collect()}
    assert sorted(pairs.values()) == ["complete", "vehicle_positions missing", "vehicle_positions missing"]
    assert (raw / "out/trip_updates/year=2025/month=03/day=06").exists()
    assert tables.read_dated(spark, f"{out}/trip_updates", 1741279796, 1741279800).count() == 1


def test_ingest_again_changes_nothing_and_counts_its_own_rejects(spark, raw):
    root, out = f"{raw}/raw", f"{raw}/out"
    write(raw / "raw/trip_updates", "2025_06_03_16_52_00.json",
          trip_document(1741279976, [{"stop_sequence": 1}]))
    tables_of = [f"{out}/trip_updates", f"{out}/vehicle_positions", f"{out}/manifest", f"{out}/rejected/trip_updates"]
    lost = tables.ingest_feeds(spark, root, out)
    first = [sorted(map(str, spark.read.parquet(t).collect())) for t in tables_of]
    assert lost["trip_updates"] > 0 and all(first)
    assert tables.ingest_feeds(spark, root, out) == lost
    assert [sorted(map(str, spark.read.parquet(t).collect())) for t in tables_of] == first


def test_ingest_replaces_a_file_that_moved_to_another_date(spark, raw):
    root, out, name = f"{raw}/raw", f"{raw}/out", "2025_06_03_16_50_00.json"
    tables.ingest_feeds(spark, root, out, ["trip_updates"])
    before = spark.read.parquet(f"{out}/trip_updates")
    others = sorted(map(str, before.filter(F.col("file_name") != name).collect()))
    stops = [{"stop_sequence": 1, "stop_id": "A", "arrival": {"delay": 5, "time": 1741290000}}]
    write(raw / "raw/trip_updates", name, trip_document(1741279856 + 86400, stops))
    tables.ingest_feeds(spark, root, out, ["trip_updates"])
    after = spark.read.parquet(f"{out}/trip_updates")
    assert sorted(map(str, after.filter(F.col("file_name") != name).collect())) == others
    moved = after.filter(F.col("file_name") == name).collect()
    assert {r.snapshot_timestamp for r in moved} == {1741279856 + 86400}


@pytest.mark.parametrize("bound", ["2025-03-06 16:00:00", "2025-03-06T16:00:00Z", "nonsense"])
def test_a_range_bound_no_format_matches_is_refused(spark, raw, bound):
    with pytest.raises(ValueError, match="Invalid datetime"):
        documents.read_documents(spark, f"{raw}/raw/trip_updates/*.json", "trip_updates", bound)


def test_a_minute_is_found_when_its_header_is_of_the_day_before(spark, tmp_path):
    midnight = int(datetime(2025, 3, 7, tzinfo=timezone.utc).timestamp())
    df = spark.createDataFrame([(midnight - 4, midnight), (midnight + 70, midnight + 60)],
                               "snapshot_timestamp long, snapshot_minute long")
    tables.write_by_date(df, f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert [r.snapshot_timestamp for r in tables.at_minute(stored, midnight).collect()] == [midnight - 4]


def test_a_range_replaces_its_own_rows_only(spark, tmp_path):
    noon, path = int(datetime(2025, 3, 6, 12, tzinfo=timezone.utc).timestamp()), f"{tmp_path}/t"

    def put(first, last, value):
        rows = [(noon + 60 * i, value) for i in range(first, last + 1)]
        df = spark.createDataFrame(rows, "snapshot_timestamp long, v int")
        tables.replace_range(df, path, noon + 60 * first, noon + 60 * last)

    put(0, 9, 1)
    put(10, 19, 2)
    put(5, 12, 3)
    got = {(r.snapshot_timestamp - noon) // 60: r.v for r in spark.read.parquet(path).collect()}
    assert got == {i: 1 if i < 5 else 3 if i <= 12 else 2 for i in range(20)}
    assert spark.read.parquet(path).count() == 20


def clock_text(epoch):
    return datetime.fromtimestamp(epoch, timezone.utc).strftime("%H:%M")


def test_ingest_range_is_inclusive_and_needs_a_readable_name(spark, raw):
    docs = documents.read_documents(
        spark, f"{raw}/raw/trip_updates/*.json", "trip_updates",
        "2025_06_03_16_49_00", "2025_06_03_16_50_00",
    )
    assert docs.count() == 2
    loose = documents.read_documents(spark, f"{raw}/raw/*.json", "vehicle_positions", "2020-01-01")
    assert loose.count() == 0


def test_rows_go_to_their_own_london_day(spark, tmp_path):
    late = int(datetime(2025, 6, 3, 23, 30, tzinfo=timezone.utc).timestamp())
    df = spark.createDataFrame([(late,), (late - 86400,)], "snapshot_timestamp long")
    tables.write_by_date(df, f"{tmp_path}/t")
    days = sorted(p.name for p in tmp_path.glob("t/year=2025/month=06/day=*"))
    assert days == ["day=03", "day=04"]
    tables.write_by_date(df.limit(1), f"{tmp_path}/t", mode="overwrite")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            clock.clock_seconds(F.lit("25:10:05")).alias("secs"),
            clock.file_time(F.lit("2025_06_03_16_49_00.json")).cast("string").alias("name"),
            clock.file_time(F.lit("x2025_06_03_16_49_00.json")).isNull().alias("other"),
            clock.service_day(F.lit(1743874800 - 3600)).cast("string").alias("day"),
            clock.parse_time(F.lit("2025-01-02")).cast("string").alias("first"),
            clock.minute_of_parts(F.lit("2025-04-06-00-30"), F.lit(2025), F.lit(6), F.lit(4)).alias("bst"),
            clock.minute_of_parts(F.lit("2025-04-06-00-30"), F.lit(2025), F.lit(6), F.lit(5)).alias("off"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.secs == 90605
    assert row.name == "2025-03-06 16:49:00" and row.other
    assert row.day == "2025-04-05"
    assert row.first == "2025-02-01 00:00:00"
    assert row.bst == int(datetime(2025, 6, 3, 23, 30, tzinfo=timezone.utc).timestamp()) and row.off is None


def test_unreadable_time_argument_fails(spark):
    with pytest.raises(Exception, match="Invalid datetime format"):
        spark.range(1).select(clock.parse_time_strict(F.lit("tomorrow"))).collect()


def test_static_schedule_reads_marked_quoted_text(spark, tmp_path):
    write(tmp_path, "stop_times.txt", '﻿trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"01","25:10:05","25:11:00","007",3\n')
    write(tmp_path, "trips.txt", '﻿route_id,service_id,trip_id\n"R","S","01"\n"R","S","02"\n')
    rows = static.build_station_schedule(spark, str(tmp_path), f"{tmp_path}/out").collect()
    assert [tuple(r) for r in rows] == [("01", "S", "R", "007", 90605, 90660, 3)]


def test_replay_numbers_batches_in_time_order(spark):
    df = spark.createDataFrame([(t * 977 % 50_000, t) for t in range(2500)], "snapshot_timestamp long, id long")
    batches = tables.replay_batches(df, 400, order=("snapshot_timestamp", "id"))
    rows = sorted(batches.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 2501))
    times = [r.snapshot_timestamp for r in rows]
    assert times == sorted(times) and rows[-1].batch_id == 6


def test_replay_splits_one_crowded_second(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") < 15_000, 100).otherwise(F.col("id")).cast("long").alias("snapshot_timestamp"), "id"
    )
    batches = tables.replay_batches(df, 1000, order=("snapshot_timestamp", "id"))
    assert batches.groupBy("batch_id").count().filter("count <> 1000").count() == 0
    assert batches.filter("position <> id + 1").count() == 0


def test_a_file_read_again_opens_only_its_dates(spark, raw, monkeypatch):
    root, out = f"{raw}/raw", f"{raw}/out"
    stops = [{"stop_sequence": 1, "stop_id": "A", "arrival": {"delay": 5, "time": 1741290000}}]
    for days in range(1, 4):
        write(raw / "raw/trip_updates", f"2025_06_0{3 + days}_16_50_00.json", trip_document(1741279856 + 86400 * days, stops))
    tables.ingest_feeds(spark, root, out, ["trip_updates"])
    held = {}
    plain = tables.checkpointed

    def noted(df):
        files = {f for f in df.inputFiles() if "/out/trip_updates/" in f}
        if files:
            plan = df._jdf.queryExecution().executedPlan().toString()
            held["plan"], held["rows"] = plan, df.count()
        return plain(df)

    monkeypatch.setattr(tables, "checkpointed", noted)
    again = raw / "again/trip_updates"
    write(again, "2025_06_05_16_50_00.json", trip_document(1741279856 + 86400 * 2, []))
    tables.ingest_feeds(spark, str(raw / "again"), out, ["trip_updates"])
    assert held["rows"] == 0 and re.search(r"PartitionFilters: \[[^]]*make_date", held["plan"])
    assert not (raw / "out/trip_updates/year=2025/month=03/day=08").exists()  # its only document has no row now
    assert {p.name for p in (raw / "out/trip_updates/year=2025/month=03").iterdir() if p.is_dir()} == {"day=06", "day=07", "day=09"}


def test_minutes_of_the_header_if_asked_for(spark, raw):
    tables.ingest_feeds(spark, f"{raw}/raw", f"{raw}/out", ["trip_updates"], minute_rule="header")
    stored = spark.read.parquet(f"{raw}/out/trip_updates").collect()
    assert stored and all(r.snapshot_minute == r.snapshot_timestamp // 60 * 60 for r in stored)
    with pytest.raises(ValueError, match="minute rule"):
        tables.ingest_feeds(spark, f"{raw}/raw", f"{raw}/out", ["trip_updates"], minute_rule="body")
