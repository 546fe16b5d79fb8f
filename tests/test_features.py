import random

import feature_model as model
import pytest
from pyspark.sql import functions as F

from stopwise.config import FeatureConfig
from stopwise.operators import routes
from stopwise.plans.features import Network, feature_tables, station_features
from stopwise.streaming.features import next_carry

TU = (
    "snapshot_minute long, snapshot_timestamp long, trip_id string, route_id string,"
    " direction_id int, stop_sequence int, stop_id string, arrival_time long,"
    " departure_time long, arrival_delay int, departure_delay int"
)
VP = "snapshot_minute long, snapshot_timestamp long, stop_id string, direction_id int"
START = 1_743_800_400  # 2025-04-04 21:00 UTC; Sydney leaves daylight saving a day later


def frame(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def update(minute, arrival, trip="T1", stop="STOP", direction=0, delay=0, **more):
    row = dict(
        snapshot_minute=minute, snapshot_timestamp=minute, trip_id=trip, route_id="R",
        direction_id=direction, stop_sequence=1, stop_id=stop, arrival_time=arrival,
        departure_time=arrival + 30, arrival_delay=delay, departure_delay=0,
    )
    return {**row, **more}


def random_feed(seed, n_minutes=150, step=1500):
    rng = random.Random(seed)
    network = {
        ("R0", 0): ["A", "B", "C", "D"],
        ("R0", 1): ["D", "C", "B", "A"],
        ("R1", 0): ["C", "A", "E"],
    }
    tu, vp = [], []
    minutes = [START + step * i for i in range(n_minutes)]
    for m in minutes:
        if rng.random() < 0.05:
            continue
        for (route, direction), stops in network.items():
            for i, stop in enumerate(stops):
                for _ in range(rng.choice((0, 1, 1, 2))):
                    ahead = rng.choice((-5, -1, 0, 30, 400, 1500, 1500, 2800, 7300, 9000, 15000))
                    at = m + ahead
                    tu.append(
                        update(
                            m, at, trip=f"{route}{direction}{m // (step * rng.choice((1, 3)))}",
                            stop=stop, direction=direction, route_id=route, stop_sequence=i + 1,
                            delay=rng.choice((None, -400, -20, 0, 90, 250, 500)),
                            departure_delay=rng.randint(-350, 350),
                            departure_time=rng.choice((None, at + 20)),
                            snapshot_timestamp=m - rng.choice((0, 0, 30, -10)),
                        )
                    )
        if rng.random() < 0.8:
            for _ in range(rng.choice((1, 2, 25))):
                vp.append(
                    dict(snapshot_minute=m, snapshot_timestamp=m - rng.choice((-20, 0, 15, 65, 90, 130)),
                         stop_id=rng.choice("ABCDE"), direction_id=rng.choice((0, 1)))
                )
    return network, tu, vp, minutes


def stops_frame(spark, network):
    rows = [
        (r, d, s, i, i) for (r, d), stops in network.items() for i, s in enumerate(stops, 1)
    ]
    return spark.createDataFrame(
        rows, "route_id string, direction_id int, stop_id string, seq int, pos int"
    )


def assert_same(found, wanted):
    rows = {(r.snapshot_timestamp, r.stop_id, r.direction_id): r for r in found.collect()}
    assert set(rows) == set(wanted)
    for key, want in wanted.items():
        for short, name in model.NAMES.items():
            if short == "fresh" and want["arr"] is None:
                assert rows[key][name] is None
                continue
            assert model.same(want.get(short), rows[key][name]), (key, name, want.get(short), rows[key][name])


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_equals_a_loop_over_minutes(spark, seed):
    network, tu, vp, minutes = random_feed(seed)
    found = station_features(
        frame(spark, tu, TU), frame(spark, vp, VP),
        spark.createDataFrame([(m,) for m in minutes], "snapshot_minute long"),
        stops=stops_frame(spark, network),
    )
    wanted = model.run(tu, vp, minutes, network)
    assert sum(w["arr"] is not None for w in wanted.values()) > 300
    assert sum(w.get("m15") is not None for w in wanted.values()) > 10
    assert_same(found, wanted)


def test_runs_in_parts_equal_one_run(spark):
    network, tu, vp, minutes = random_feed(3, n_minutes=120)
    wanted = model.run(tu, vp, minutes, network)
    cfg = FeatureConfig(cut_lineage=True)
    net = Network.from_stops(stops_frame(spark, network), cfg)
    carry, parts = None, []
    for chosen in (minutes[:40], minutes[40:47], minutes[47:]):
        inside = set(chosen)
        result = feature_tables(
            frame(spark, [u for u in tu if u["snapshot_minute"] in inside], TU),
            frame(spark, [v for v in vp if v["snapshot_minute"] in inside], VP),
            spark.createDataFrame([(m,) for m in chosen], "snapshot_minute long"),
            net, cfg, carry,
        )
        parts.append(result.features)
        kept = next_carry(result, cfg)
        carry = type(kept)(kept.rows.checkpoint(), kept.lags.checkpoint())
        per_stop = carry.rows.groupBy("stop_id", "direction_id").count()
        assert per_stop.agg(F.max("count")).first()[0] <= 76
    assert_same(parts[0].union(parts[1]).union(parts[2]), wanted)


def test_input_order_does_not_matter_and_scope_keeps_networks_apart(spark):
    network, tu, vp, minutes = random_feed(4, n_minutes=30)
    rng = random.Random(0)
    wanted = model.run(tu, vp, minutes, network)
    rng.shuffle(tu)
    rng.shuffle(vp)
    cfg = FeatureConfig(scope=("network_id",), grid_salts=3)
    both = F.explode(F.array(F.lit("x"), F.lit("y"))).alias("network_id")
    found = station_features(
        frame(spark, tu, TU).select("*", both), frame(spark, vp, VP).select("*", both),
        spark.createDataFrame([(m,) for m in minutes], "snapshot_minute long").select("*", both),
        cfg, stops=stops_frame(spark, network).select("*", both),
    )
    for name in ("x", "y"):
        assert_same(found.filter(F.col("network_id") == name), wanted)


def _one_stop(spark, tu, vp, minutes):
    return {
        (r.snapshot_timestamp, r.stop_id): r
        for r in station_features(
            frame(spark, tu, TU), frame(spark, vp, VP),
            spark.createDataFrame([(m,) for m in minutes], "snapshot_minute long"),
            FeatureConfig(cut_lineage=False),
        ).collect()
    }


def test_repeated_trip_counts_once(spark):
    tu = [update(START, START + 60, "T0")] + [
        update(START + 60 * i, START + 60 * i + 120, "T1") for i in (1, 2, 3)
    ]
    rows = _one_stop(spark, tu, [], [START + 60 * i for i in range(4)])
    heads = [rows[START + 60 * i, "STOP"].headway_t for i in range(4)]
    assert heads == [None, 120.0, None, None]
    assert all(r.is_train_present == 0 for r in rows.values())


def test_missing_stop_becomes_a_gap_row(spark):
    tu = [update(START, START + 30), update(START, START + 40, stop="B"), update(START + 60, START + 90, "T2")]
    rows = _one_stop(spark, tu, [], [START, START + 60, START + 120])
    assert rows[START + 60, "B"].arrival_delay_t is None
    assert rows[START + 60, "B"].sin_hour is not None
    assert len(rows) == 6


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="snapshot_timestamp"):
        station_features(
            spark.createDataFrame([], "snapshot_minute long, stop_id string, direction_id int"),
            spark.createDataFrame([], VP), spark.createDataFrame([], "snapshot_minute long"),
            stops=spark.createDataFrame([], "route_id string, direction_id int, stop_id string, seq int, pos int"),
        )


def test_route_stops_take_the_smallest_sequence(spark):
    rows = [("R", 0, "A", 1), ("R", 0, "B", 2), ("R", 0, "B", 5), ("R", 0, "C", 3)]
    tu = spark.createDataFrame(rows, "route_id string, direction_id int, stop_id string, stop_sequence int")
    assert routes.route_map(routes.route_stops(tu)).first()["stops"] == ["A", "B", "C"]


def test_lags_by_place_in_the_feed(spark):
    """The last rows of a minute are those that stand last, also in a minute of more rows than are kept."""
    from stopwise.config import FeatureConfig
    from stopwise.operators import vehicles

    cfg = FeatureConfig(feed_order=("place",), cut_lineage=False)
    rows = [(m, m - (37 * p + m) % 500 + 20, p if p % 50 else None) for m in (6000, 6060, 6120) for p in range(90 if m == 6060 else 7)]
    found = vehicles.minute_lags(spark.createDataFrame(rows, "snapshot_minute long, snapshot_timestamp long, place int"), cfg)
    for row in found.collect():
        own = [(-1 if p is None else p, -max(m - t, 0)) for m, t, p in rows if m == row.snapshot_minute]
        assert row.lags == [-x for _, x in sorted(own)[-60:]]
    assert found.count() == 3
