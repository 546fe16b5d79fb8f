"""The registered queries once more, as plain SQL for the side-by-side check.

Written from the rules and not from the Spark plans: joins and window frames
where the engine uses aggregates, look-ups and chunked windows.
"""

from __future__ import annotations

import re

from stopwise.config import CENTRAL_STOPS
from stopwise.plans.surrogates import ORACLE_VIEWS

_NEAREST = "abs(off), trip_id, stop_sequence, route_id, arrival_time, arrival_delay, departure_delay"
_KEY = "stop_id, direction_id"


def _sydney(epoch: str) -> str:
    return f"timezone('Australia/Sydney', to_timestamp({epoch}))"


def _first(column: str) -> str:
    return (
        f"first_value({column} IGNORE NULLS) OVER (PARTITION BY snapshot_minute, {_KEY}"
        f" ORDER BY {_NEAREST} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        f" AS {column}"
    )


def _clip(column: str) -> str:
    return f"greatest(least({column}, 300.0), -300.0)"


_central = ", ".join(f"'{s}'" for s in CENTRAL_STOPS)

VIEWS = {
    **ORACLE_VIEWS,
    # -- routes
    "rstops": """
      SELECT route_id, direction_id, stop_id, min(stop_sequence) AS seq,
             row_number() OVER (PARTITION BY route_id, direction_id
                                ORDER BY min(stop_sequence), stop_id) AS pos
      FROM tu GROUP BY route_id, direction_id, stop_id""",
    "keys": "SELECT DISTINCT stop_id, direction_id FROM rstops",
    "edges": """
      SELECT a.stop_id AS a, b.stop_id AS b FROM rstops a JOIN rstops b
        ON a.route_id = b.route_id AND a.direction_id = b.direction_id AND abs(a.pos - b.pos) = 1""",
    "degrees": "SELECT a AS stop_id, count(DISTINCT b) AS node_degree FROM edges GROUP BY a",
    "graph": """
      SELECT stop_id, node_degree,
             CAST(node_degree >= (SELECT quantile_cont(node_degree, 0.9) FROM degrees) AS INTEGER)
               AS hub_flag
      FROM degrees""",
    # -- candidates
    "upd": """
      SELECT snapshot_minute, stop_id, direction_id, trip_id, route_id, stop_sequence,
             arrival_time, departure_time,
             CAST(coalesce(arrival_delay, 0) AS DOUBLE) AS arrival_delay,
             CAST(coalesce(departure_delay, 0) AS DOUBLE) AS departure_delay,
             arrival_time - snapshot_minute AS off
      FROM tu WHERE snapshot_timestamp <= snapshot_minute""",
    "win": """
      SELECT snapshot_minute,
             CAST(least(greatest(coalesce(quantile_cont(off, 0.95) FILTER (WHERE off >= 0), 7200.0),
                        7200.0), 14400.0) AS DOUBLE) AS future_window
      FROM upd GROUP BY snapshot_minute""",
    "fut": """
      SELECT upd.* FROM upd JOIN win USING (snapshot_minute)
      WHERE off >= -1 AND off <= future_window + 1""",
    "cand": f"""
      SELECT * FROM (
        SELECT snapshot_minute, {_KEY}, {_first("trip_id")}, {_first("route_id")},
               {_first("stop_sequence")}, {_first("arrival_time")}, {_first("departure_time")},
               {_first("arrival_delay")}, {_first("departure_delay")}, off,
               row_number() OVER (PARTITION BY snapshot_minute, {_KEY} ORDER BY {_NEAREST}) AS rn
        FROM fut) WHERE rn = 1""",
    "served": """
      SELECT snapshot_minute, count(DISTINCT route_id) > 1 AS many_routes
      FROM cand GROUP BY snapshot_minute""",
    # -- rows that count, and their segments
    "near": f"""
      SELECT *, trip_id IS DISTINCT FROM
                lag(trip_id) OVER (PARTITION BY {_KEY} ORDER BY snapshot_minute) AS is_real
      FROM cand WHERE off <= 7200""",
    "real0": f"""
      SELECT *, lag(arrival_time) OVER (PARTITION BY {_KEY} ORDER BY snapshot_minute) AS prev_arr
      FROM near WHERE is_real""",
    "real": f"""
      SELECT *, arrival_time - arrival_delay AS sched_arr,
             {_clip("arrival_delay")} AS arr, {_clip("departure_delay")} AS dep,
             sum(CASE WHEN prev_arr IS NOT NULL
                       AND CAST({_sydney("prev_arr")} AS DATE) <> CAST({_sydney("arrival_time")} AS DATE)
                       AND hour({_sydney("arrival_time")}) >= 3 THEN 1 ELSE 0 END)
               OVER (PARTITION BY {_KEY} ORDER BY snapshot_minute) AS seg
      FROM real0""",
    "hw0": """
      SELECT *, arrival_time - lag(arrival_time) OVER s AS gap,
             sched_arr - lag(sched_arr) OVER s AS planned
      FROM real WINDOW s AS (PARTITION BY stop_id, direction_id, seg ORDER BY snapshot_minute)""",
    "hw": """
      SELECT *, CAST(CASE WHEN gap BETWEEN 1 AND 3600 THEN gap END AS DOUBLE) AS headway_t,
             CASE WHEN gap BETWEEN 1 AND 3600 THEN gap / nullif(planned, 0) END AS rel_headway_t
      FROM hw0""",
    "roll": """
      SELECT *, arr - lag(arr, 1, 0.0) OVER s AS delay_arrival_grad_t,
             dep - lag(dep, 1, 0.0) OVER s AS delay_departure_grad_t,
             CASE WHEN count(arr) OVER w5 = 5 THEN avg(arr) OVER w5 END AS delay_mean_5,
             CASE WHEN count(arr) OVER w5 = 5 THEN stddev_samp(arr) OVER w5 END AS delay_std_5,
             CASE WHEN count(arr) OVER w15 = 15 THEN avg(arr) OVER w15 END AS delay_mean_15,
             list_aggregate((list(headway_t) FILTER (WHERE headway_t IS NOT NULL) OVER before)[-60:],
                            'quantile_cont', 0.9) AS headway_p90_60
      FROM hw
      WINDOW s AS (PARTITION BY stop_id, direction_id, seg ORDER BY snapshot_minute),
             w5 AS (PARTITION BY stop_id, direction_id, seg ORDER BY snapshot_minute
                    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
             w15 AS (PARTITION BY stop_id, direction_id, seg ORDER BY snapshot_minute
                     ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING),
             before AS (PARTITION BY stop_id, direction_id, seg ORDER BY snapshot_minute
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    # -- neighbours
    "hops": """
      SELECT a.route_id, a.direction_id, a.stop_id, b.stop_id AS other, b.pos - a.pos AS hop
      FROM rstops a JOIN rstops b
        ON a.route_id = b.route_id AND a.direction_id = b.direction_id
       AND abs(b.pos - a.pos) IN (1, 2)""",
    "up1": """
      SELECT r.snapshot_minute, r.stop_id, r.direction_id, h.other,
             coalesce(arg_max(p.arr, p.snapshot_minute), 0.0) AS known
      FROM real r JOIN hops h USING (route_id, direction_id, stop_id)
      LEFT JOIN real p ON p.stop_id = h.other AND p.direction_id = r.direction_id
       AND (p.snapshot_minute < r.snapshot_minute
            OR (p.snapshot_minute = r.snapshot_minute AND h.other < r.stop_id))
      WHERE h.hop < 0
      GROUP BY r.snapshot_minute, r.stop_id, r.direction_id, h.other""",
    "up": """
      SELECT snapshot_minute, stop_id, direction_id, avg(known) AS upstream_delay_mean_2
      FROM up1 GROUP BY snapshot_minute, stop_id, direction_id""",
    "down1": """
      SELECT r.snapshot_minute, r.stop_id, r.direction_id, f.arrival_delay,
             row_number() OVER (PARTITION BY r.snapshot_minute, r.stop_id, r.direction_id, h.other
                                ORDER BY abs(f.off), f.direction_id, f.stop_sequence, f.route_id,
                                         f.arrival_time, f.arrival_delay) AS rn
      FROM real r JOIN hops h USING (route_id, direction_id, stop_id)
      JOIN fut f ON f.snapshot_minute = r.snapshot_minute AND f.trip_id = r.trip_id
       AND f.stop_id = h.other
      WHERE h.hop > 0""",
    "down": """
      SELECT snapshot_minute, stop_id, direction_id, max(arrival_delay) AS downstream_delay_max_2
      FROM down1 WHERE rn = 1 GROUP BY snapshot_minute, stop_id, direction_id""",
    # -- vehicles
    "lagrows": """
      SELECT v.snapshot_minute, greatest(v.snapshot_minute - v.snapshot_timestamp, 0) AS lag,
             row_number() OVER (ORDER BY v.snapshot_minute,
                                greatest(v.snapshot_minute - v.snapshot_timestamp, 0) DESC) AS i
      FROM vp v JOIN served USING (snapshot_minute)""",
    "lagends": "SELECT snapshot_minute, max(i) AS last_i FROM lagrows GROUP BY snapshot_minute",
    "laghist": """
      SELECT e.snapshot_minute, list_sort(list(r.lag)) AS h
      FROM lagends e JOIN lagrows r ON r.i > e.last_i - 60 AND r.i <= e.last_i
      GROUP BY e.snapshot_minute""",
    "lagtol": """
      SELECT snapshot_minute, greatest(60, 10 + CAST(floor(
               CASE WHEN f < 0.5 THEN a + (b - a) * f ELSE b - (b - a) * (1 - f) END) AS BIGINT)) AS tol
      FROM (SELECT snapshot_minute, CAST(h[CAST(floor(p) AS BIGINT) + 1] AS DOUBLE) AS a,
                   CAST(h[CAST(ceil(p) AS BIGINT) + 1] AS DOUBLE) AS b, p - floor(p) AS f
            FROM (SELECT snapshot_minute, h, (len(h) - 1) * CAST(0.95 AS DOUBLE) AS p FROM laghist))""",
    "tol": """
      SELECT s.snapshot_minute, s.many_routes,
             coalesce(last_value(t.tol IGNORE NULLS) OVER (ORDER BY s.snapshot_minute
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 60) AS vp_tolerance
      FROM served s LEFT JOIN lagtol t USING (snapshot_minute)""",
    "veh": """
      SELECT v.snapshot_minute, v.stop_id, v.direction_id,
             max(v.snapshot_timestamp) AS vehicle_ts,
             arg_max(CAST(v.congestion_level AS DOUBLE),
                     (v.snapshot_timestamp, v.congestion_level, v.occupancy_status)) AS congestion_level,
             arg_max(CAST(v.occupancy_status AS DOUBLE),
                     (v.snapshot_timestamp, v.congestion_level, v.occupancy_status)) AS occupancy_status
      FROM vp v JOIN tol t USING (snapshot_minute)
      WHERE v.snapshot_timestamp <= v.snapshot_minute
        AND v.snapshot_timestamp >= v.snapshot_minute - t.vp_tolerance
      GROUP BY v.snapshot_minute, v.stop_id, v.direction_id""",
    "rveh": """
      SELECT r.*, v.vehicle_ts, v.congestion_level, v.occupancy_status,
             CASE WHEN v.vehicle_ts IS NULL THEN 0 ELSE 1 END AS is_train_present,
             least(86400.0, coalesce(
               r.snapshot_minute - v.vehicle_ts,
               r.snapshot_minute - last_value(v.vehicle_ts IGNORE NULLS) OVER (
                 PARTITION BY r.stop_id, r.direction_id, r.seg ORDER BY r.snapshot_minute
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 86400)) AS data_fresh_secs
      FROM roll r LEFT JOIN veh v USING (snapshot_minute, stop_id, direction_id)""",
    # -- everything together
    "feat": f"""
      SELECT m.snapshot_minute AS snapshot_timestamp, k.stop_id, k.direction_id,
             CASE WHEN s.many_routes THEN c.route_id END AS route_id,
             r.arr AS arrival_delay_t, r.dep AS departure_delay_t, r.headway_t, r.rel_headway_t,
             CASE WHEN r.departure_time IS NOT NULL THEN r.departure_delay - r.arrival_delay END
               AS dwell_delta_t,
             r.delay_arrival_grad_t, r.delay_departure_grad_t,
             u.upstream_delay_mean_2, d.downstream_delay_max_2,
             r.delay_mean_5, r.delay_std_5, r.delay_mean_15, r.headway_p90_60,
             sin(2 * pi() * hour({_sydney("m.snapshot_minute")}) / 24) AS sin_hour,
             cos(2 * pi() * hour({_sydney("m.snapshot_minute")}) / 24) AS cos_hour,
             CAST(isodow({_sydney("m.snapshot_minute")}) >= 6 AS INTEGER) AS day_type,
             coalesce(g.node_degree, 0) AS node_degree, coalesce(g.hub_flag, 0) AS hub_flag,
             r.congestion_level, r.occupancy_status,
             CAST(k.stop_id IN ({_central}) AS INTEGER) AS central_flag,
             coalesce(r.is_train_present, 0) AS is_train_present,
             r.data_fresh_secs
      FROM mins m CROSS JOIN keys k
      LEFT JOIN cand c ON c.snapshot_minute = m.snapshot_minute AND c.stop_id = k.stop_id
                      AND c.direction_id = k.direction_id
      LEFT JOIN served s ON s.snapshot_minute = m.snapshot_minute
      LEFT JOIN rveh r ON r.snapshot_minute = m.snapshot_minute AND r.stop_id = k.stop_id
                      AND r.direction_id = k.direction_id
      LEFT JOIN up u ON u.snapshot_minute = m.snapshot_minute AND u.stop_id = k.stop_id
                    AND u.direction_id = k.direction_id
      LEFT JOIN down d ON d.snapshot_minute = m.snapshot_minute AND d.stop_id = k.stop_id
                      AND d.direction_id = k.direction_id
      LEFT JOIN graph g ON g.stop_id = k.stop_id""",
}


def with_views(select: str) -> str:
    """``select`` under a WITH clause of the views it needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in VIEWS and word not in needed:
                needed.add(word)
                visit(VIEWS[word])

    visit(select)
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH {views}\n{select}" if views else select


def rounded(columns: str, digits: int = 6) -> str:
    """``round`` with the sign of zero dropped, for each listed column."""
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns.split())


# -- the small detector of the registered queries ------------------------------------------

HST_FEATURES = [
    "arrival_delay_t", "departure_delay_t", "headway_t", "rel_headway_t", "delay_arrival_grad_t",
    "delay_departure_grad_t", "upstream_delay_mean_2", "downstream_delay_max_2", "delay_mean_5",
    "delay_std_5", "delay_mean_15", "headway_p90_60", "sin_hour", "cos_hour", "day_type",
    "node_degree", "hub_flag", "congestion_level", "occupancy_status", "central_flag",
    "is_train_present",
]
_ACTIVE = [
    f for f in HST_FEATURES
    if f not in {"sin_hour", "cos_hour", "day_type", "node_degree", "hub_flag", "central_flag"}
]


def _tree_values(cfg) -> str:
    from stopwise.operators.spacetrees import build_trees

    feature, split = build_trees(
        cfg.n_trees, cfg.height, len(HST_FEATURES), cfg.seed, cfg.lower, cfg.upper
    )
    rows = [
        f"({t}, {n}, '{HST_FEATURES[feature[t, n]]}', CAST('{split[t, n]!r}' AS DOUBLE))"
        for t in range(cfg.n_trees)
        for n in range(1, 1 << cfg.height)
    ]
    return "SELECT * FROM (VALUES " + ", ".join(rows).replace("np.float64(", "").replace(
        ")'", "'"
    ) + ") v(tree, node, feature, split)"


def _walks(source: str, trees: str, height: int) -> str:
    """Leaf of every row of ``source`` (long: rid, feature, value) in every tree."""
    sql = f"SELECT r.rid, t.tree, 1 AS node FROM (SELECT DISTINCT rid FROM {source}) r, (SELECT DISTINCT tree FROM {trees}) t"
    for _ in range(height):
        sql = (
            f"SELECT w.rid, w.tree, 2 * w.node + CAST(x.value >= t.split AS INTEGER) AS node"
            f" FROM ({sql}) w JOIN {trees} t ON t.tree = w.tree AND t.node = w.node"
            f" JOIN {source} x ON x.rid = w.rid AND x.feature = t.feature"
        )
    return sql


def detector_views(cfg, name: str) -> dict[str, str]:
    """Views ``<name>_scores`` and ``<name>_flags`` of the detector with settings ``cfg``."""
    n, h, psi = name, cfg.height, cfg.window_size
    raw = "0.0"
    for depth in range(h, -1, -1):
        step = f"m{depth} * {2.0 ** depth}"
        raw = f"({step} + CASE WHEN m{depth} >= {0.1 * psi} THEN {raw} ELSE 0.0 END)"
    masses = "\n".join(
        f"LEFT JOIN {n}_mass m{d} ON m{d}.day = r.day AND m{d}.win = r.win - 1"
        f" AND m{d}.tree = w.tree AND m{d}.depth = {d} AND m{d}.node = w.node >> {h - d}"
        for d in range(h + 1)
    )
    picked = ", ".join(f"coalesce(m{d}.mass, 0) AS m{d}" for d in range(h + 1))
    top = cfg.n_trees * psi * (2.0 ** (h + 1) - 1)
    return {
        f"{n}_trees": _tree_values(cfg),
        f"{n}_win": f"SELECT rid, day, seq, (seq - 1) // {psi} AS win FROM det",
        f"{n}_walk": _walks("detlong", f"{n}_trees", h),
        f"{n}_mass": "\nUNION ALL\n".join(
            f"SELECT r.day, r.win, w.tree, {d} AS depth, w.node >> {h - d} AS node,"
            f" count(*) AS mass FROM {n}_walk w JOIN {n}_win r USING (rid)"
            f" GROUP BY r.day, r.win, w.tree, w.node >> {h - d}"
            for d in range(h + 1)
        ),
        f"{n}_scores": f"""
          SELECT d.rid, d.day, d.ts, d.stop_id, d.direction_id, d.seq,
                 CASE WHEN d.seq <= {psi} THEN 0.0 ELSE 1.0 - s.raw / {top} END AS anomaly_score
          FROM det d JOIN (
            SELECT rid, sum({raw}) AS raw FROM (
              SELECT w.rid, {picked} FROM {n}_walk w JOIN {n}_win r USING (rid) {masses})
            GROUP BY rid) s USING (rid)""",
        f"{n}_flags": f"""
          SELECT a.rid, a.day, a.ts, a.stop_id, a.direction_id, a.seq, a.anomaly_score,
                 CAST(a.seq >= {psi} AND count(b.rid) >=
                      floor({psi - 1} * CAST({cfg.threshold_quantile} AS DOUBLE)) + 1 AS INTEGER)
                   AS anomaly_flag
          FROM {n}_scores a LEFT JOIN {n}_scores b
            ON b.day = a.day AND b.seq > a.seq - {psi} AND b.seq <= a.seq
           AND b.anomaly_score < a.anomaly_score
          GROUP BY a.rid, a.day, a.ts, a.stop_id, a.direction_id, a.seq, a.anomaly_score""",
    }


VIEWS["det"] = f"""
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, stop_id, direction_id) AS seq,
         row_number() OVER (ORDER BY ts, stop_id, direction_id) AS rid
  FROM (SELECT CAST({_sydney("snapshot_timestamp")} - INTERVAL 3 HOUR AS DATE) AS day,
               snapshot_timestamp AS ts, stop_id, direction_id,
               {", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in HST_FEATURES)}
        FROM feat)
  WHERE {" + ".join(f"abs({f})" for f in _ACTIVE)} <> 0"""
VIEWS["detlong"] = f"UNPIVOT det ON {', '.join(HST_FEATURES)} INTO NAME feature VALUE value"


def explain_view(cfg, name: str, condition: str) -> str:
    """Top three score changes per explained row, one row per feature."""
    psi, h = cfg.window_size, cfg.height
    raw = "0.0"
    for depth in range(h, -1, -1):
        raw = (
            f"(m{depth} * {2.0 ** depth} + CASE WHEN m{depth} >= {0.1 * psi}"
            f" THEN {raw} ELSE 0.0 END)"
        )
    masses = "\n".join(
        f"LEFT JOIN {name}_mass m{d} ON m{d}.day = r.day AND m{d}.win = r.win - 1"
        f" AND m{d}.tree = w.tree AND m{d}.depth = {d} AND m{d}.node = w.node >> {h - d}"
        for d in range(h + 1)
    )
    picked = ", ".join(f"coalesce(m{d}.mass, 0) AS m{d}" for d in range(h + 1))
    top = cfg.n_trees * psi * (2.0 ** (h + 1) - 1)
    place = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(HST_FEATURES))
    return f"""
      SELECT rid, feature, contribution, row_number() OVER (
               PARTITION BY rid ORDER BY abs(contribution) DESC, CASE feature {place} END) AS rnk
      FROM (
        SELECT v.rid, v.zeroed AS feature,
               CASE WHEN s.seq <= {psi} THEN 0.0
                    ELSE s.anomaly_score - (1.0 - sum({raw}) / {top}) END AS contribution
        FROM (SELECT vw.vid, vw.tree, vw.node, {picked}, k.rid, k.zeroed
              FROM ({_walks("xlong", f"{name}_trees", h).replace("rid", "vid")}) vw
              JOIN xkeys k USING (vid)
              JOIN {name}_win r ON r.rid = k.rid
              {masses.replace("w.", "vw.")}) v
        JOIN {name}_scores s ON s.rid = v.rid
        GROUP BY v.rid, v.zeroed, s.seq, s.anomaly_score)"""
