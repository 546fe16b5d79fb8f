"""The feature rules as a plain loop over minutes, to check the plan against."""

from __future__ import annotations

import math
from datetime import datetime
from statistics import mean, stdev
from zoneinfo import ZoneInfo

import numpy as np

_ZONE = ZoneInfo("Australia/Sydney")


def _rank(u):
    return (
        abs(u["arrival_time"] - u["snapshot_minute"]),
        u["trip_id"],
        u["stop_sequence"],
        u["route_id"],
        u["arrival_time"],
        u["arrival_delay"],
        u["departure_delay"],
    )


def _clip(x):
    return max(-300.0, min(300.0, x))


def _q(values, q):
    return float(np.percentile(values, q))


def run(tu, vp, minutes, routes):
    """``routes``: {(route, direction): [stop, ...]}. Returns {(minute, stop, dir): row}."""
    keys = {(s, d) for (_, d), stops in routes.items() for s in stops}
    past = {k: [] for k in keys}  # real rows of the open segment
    ever = dict.fromkeys(keys, 0.0)  # last clipped delay ever
    last = {}
    lags, tolerance = [], 60
    out = {}
    for minute in sorted(minutes):
        rows = [
            dict(u, arrival_delay=float(u["arrival_delay"] or 0), departure_delay=float(u["departure_delay"] or 0))
            for u in tu
            if u["snapshot_minute"] == minute and u["snapshot_timestamp"] <= minute
        ]
        ahead = [u["arrival_time"] - minute for u in rows if u["arrival_time"] is not None]
        ahead = [a for a in ahead if a >= 0]
        window = min(max(7200, _q(ahead, 95) if ahead else 0), 14400)
        rows = [
            u
            for u in rows
            if u["arrival_time"] is not None and -1 <= u["arrival_time"] - minute <= window + 1
        ]
        rows.sort(key=_rank)
        for k in keys:
            out[minute, *k] = {"headway": None, "present": 0, "arr": None}
        if not rows:
            continue
        seen = [v for v in vp if v["snapshot_minute"] == minute]
        lags += sorted((max(minute - v["snapshot_timestamp"], 0) for v in seen), reverse=True)
        lags = lags[-60:]
        if lags:
            tolerance = max(60, int(_q(lags, 95)) + 10)
        nearest = {}
        for u in rows:
            k = (u["stop_id"], u["direction_id"])
            if k not in nearest:
                nearest[k] = dict(u)
            elif nearest[k]["departure_time"] is None:
                nearest[k]["departure_time"] = u["departure_time"]
        many = len({u["route_id"] for u in nearest.values()}) > 1
        for k in sorted(nearest):
            u, row = nearest[k], out[minute, *k]
            row["route_id"] = u["route_id"] if many else None
            if u["trip_id"] == last.get(k) or u["arrival_time"] - minute > 7200:
                continue
            if past[k]:
                a = datetime.fromtimestamp(past[k][-1]["at"], _ZONE)
                b = datetime.fromtimestamp(u["arrival_time"], _ZONE)
                if a.date() != b.date() and b.hour >= 3:
                    past[k] = []
            done = past[k]
            arr, dep = _clip(u["arrival_delay"]), _clip(u["departure_delay"])
            planned_at = u["arrival_time"] - u["arrival_delay"]
            gap = u["arrival_time"] - done[-1]["at"] if done else None
            headway = float(gap) if gap is not None and 0 < gap <= 3600 else None
            planned = planned_at - done[-1]["planned"] if done else None
            delays = [p["arr"] for p in done]
            headways = [p["headway"] for p in done if p["headway"] is not None][-60:]
            stops = routes[u["route_id"], k[1]]
            place = stops.index(k[0])
            before = [ever[s, k[1]] for s in stops[max(0, place - 2) : place]]
            after = []
            for s in stops[place + 1 : place + 3]:
                hits = [
                    x for x in rows if x["trip_id"] == u["trip_id"] and x["stop_id"] == s
                ]
                if hits:
                    gap_of = lambda x: abs(x["arrival_time"] - minute)
                    first = min(
                        hits,
                        key=lambda x: (gap_of(x), x["direction_id"], x["stop_sequence"],
                                       x["route_id"], x["arrival_time"], x["arrival_delay"]),
                    )
                    after.append(first["arrival_delay"])
            near = [
                v
                for v in seen
                if (v["stop_id"], v["direction_id"]) == k
                and minute - tolerance <= v["snapshot_timestamp"] <= minute
            ]
            newest = max((v["snapshot_timestamp"] for v in near), default=None)
            known = [p["veh"] for p in done if p["veh"] is not None]
            fresh = 86400
            if newest is not None:
                fresh = minute - newest
            elif known:
                fresh = minute - known[-1]
            row.update(
                arr=arr,
                dep=dep,
                headway=headway,
                rel=headway / planned if headway is not None and planned else None,
                dwell=None
                if u["departure_time"] is None
                else u["departure_delay"] - u["arrival_delay"],
                agrad=arr - (done[-1]["arr"] if done else 0.0),
                dgrad=dep - (done[-1]["dep"] if done else 0.0),
                m5=mean(delays[-5:]) if len(delays) >= 5 else None,
                s5=stdev(delays[-5:]) if len(delays) >= 5 else None,
                m15=mean(delays[-15:]) if len(delays) >= 15 else None,
                p90=_q(headways, 90) if headways else None,
                up=mean(before) if before else None,
                down=max(after) if after else None,
                present=int(newest is not None),
                fresh=float(min(fresh, 86400)),
            )
            done.append(
                {"at": u["arrival_time"], "planned": planned_at, "arr": arr, "dep": dep,
                 "headway": headway, "veh": newest}
            )
            ever[k], last[k] = arr, u["trip_id"]
    return out


NAMES = {
    "arr": "arrival_delay_t",
    "dep": "departure_delay_t",
    "headway": "headway_t",
    "rel": "rel_headway_t",
    "dwell": "dwell_delta_t",
    "agrad": "delay_arrival_grad_t",
    "dgrad": "delay_departure_grad_t",
    "m5": "delay_mean_5",
    "s5": "delay_std_5",
    "m15": "delay_mean_15",
    "p90": "headway_p90_60",
    "up": "upstream_delay_mean_2",
    "down": "downstream_delay_max_2",
    "present": "is_train_present",
    "fresh": "data_fresh_secs",
    "route_id": "route_id",
}


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, str):
        return a == b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
