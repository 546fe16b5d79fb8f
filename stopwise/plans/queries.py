"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.config import DetectorConfig, FeatureConfig
from stopwise.functions import clock
from stopwise.operators import labels, metrics, nearest, reports, routes, station, vehicles
from stopwise.plans import detect, features, oracles, tune
from stopwise.plans import surrogates as S
from stopwise.plans.lineage import checkpointed
from stopwise.sources import documents, static, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_DOUBLES = (
    "arrival_delay_t departure_delay_t headway_t rel_headway_t dwell_delta_t"
    " delay_arrival_grad_t delay_departure_grad_t upstream_delay_mean_2"
    " downstream_delay_max_2 delay_mean_5 delay_std_5 delay_mean_15 headway_p90_60"
    " sin_hour cos_hour congestion_level occupancy_status data_fresh_secs"
)


def rounded(columns: str, digits: int = 6) -> list:
    return [(F.round(c, digits) + 0.0).alias(c) for c in columns.split()]


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = oracles.with_views(sql)
        return query

    return add


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.station_features(
        S.trip_updates(spark, sf_dir), S.vehicles(spark, sf_dir), S.minutes(spark, sf_dir)
    )


@register(
    "station_features",
    f"""SELECT snapshot_timestamp, stop_id, direction_id, route_id, day_type, node_degree,
               hub_flag, central_flag, is_train_present, {oracles.rounded(_DOUBLES)} FROM feat""",
)
def station_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(
        "snapshot_timestamp",
        "stop_id",
        "direction_id",
        "route_id",
        "day_type",
        "node_degree",
        "hub_flag",
        "central_flag",
        "is_train_present",
        *rounded(_DOUBLES),
    )


# -- feeds ----------------------------------------------------------------------------------


def _entity_json(member: str, body: str) -> str:
    return f"""to_json(named_struct(
        'header', named_struct('timestamp', snapshot_timestamp),
        'entity', array(named_struct('id', cast(id AS string), '{member}', {body}),
                        named_struct('id', 'other', '{member}', if(false, {body}, null)))))"""


def _trip_update_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed texts, one per snapshot and trip, built from the flat rows."""
    nested = (
        S.trip_updates(spark, sf_dir)
        .groupBy(
            "snapshot_timestamp", "trip_id", "route_id", "direction_id", "start_date", "vehicle_id"
        )
        .agg(
            F.min("event_id").alias("id"),
            F.collect_list(
                F.expr(
                    """named_struct('stop_sequence', stop_sequence, 'stop_id', stop_id,
                       'arrival', named_struct('time', arrival_time, 'delay', arrival_delay),
                       'departure', named_struct('time', departure_time,
                                                 'delay', departure_delay))"""
                )
            ).alias("stops"),
        )
    )
    body = """named_struct(
        'trip', named_struct('trip_id', trip_id, 'route_id', route_id,
                             'direction_id', nullif(direction_id, 0),
                             'start_time', '00:00:00', 'start_date', start_date),
        'vehicle', named_struct('id', vehicle_id), 'stop_time_update', stops)"""
    return nested.selectExpr(f"{_entity_json('trip_update', body)} AS body")


@register(
    "tu_flatten",
    """SELECT snapshot_timestamp, trip_id, route_id, direction_id, start_time, start_date,
              vehicle_id, stop_sequence, stop_id, arrival_time, departure_time,
              coalesce(arrival_delay, 0) AS arrival_delay, departure_delay FROM tu""",
)
def tu_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.parse_documents(_trip_update_documents(spark, sf_dir), "body", "trip_updates")
    return documents.flatten(docs, "trip_updates")


@register(
    "vp_flatten",
    """SELECT snapshot_timestamp, CAST(NULL AS VARCHAR) AS trip_id, 'R1' AS route_id, direction_id,
              vehicle_id, latitude, CAST(NULL AS DOUBLE) AS longitude,
              CAST(NULL AS DOUBLE) AS bearing, CAST(NULL AS DOUBLE) AS speed,
              CAST(NULL AS INTEGER) AS current_stop_sequence,
              '2' AS current_status, stop_id, congestion_level, occupancy_status FROM vp""",
)
def vp_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = """named_struct(
        'trip', named_struct('route_id', 'R1', 'direction_id', direction_id),
        'vehicle', named_struct('id', vehicle_id), 'position', named_struct('latitude', latitude),
        'current_status', 2, 'stop_id', stop_id, 'congestion_level', int(congestion_level),
        'occupancy_status', int(occupancy_status), 'timestamp', 0)"""
    texts = S.vehicles(spark, sf_dir).withColumn("id", F.col("event_id"))
    texts = texts.selectExpr(f"{_entity_json('vehicle', body)} AS body")
    docs = documents.parse_documents(texts, "body", "vehicle_positions")
    return documents.flatten(docs, "vehicle_positions")


@register(
    "alert_flatten",
    """SELECT snapshot_timestamp, alert_entity_id, p.s AS active_period_start,
              p.e AS active_period_end, 'AG' AS agency_id, i.r AS route_id,
              CAST(NULL AS INTEGER) AS direction_id, cause, '2' AS effect,
              'Notice ' || alert_entity_id AS header_text, '' AS description_text,
              'http://' || alert_entity_id AS url
       FROM al
       CROSS JOIN LATERAL (SELECT unnest(CASE
            WHEN event_id % 3 = 0 THEN [{'s': NULL::BIGINT, 'e': NULL::BIGINT}]
            WHEN event_id % 3 = 1 THEN []
            ELSE [{'s': active_period_start, 'e': active_period_end},
                  {'s': active_period_start + 60, 'e': NULL::BIGINT}] END) AS p) q
       CROSS JOIN LATERAL (SELECT unnest([{'r': route_id}, {'r': NULL::VARCHAR}]) AS i) o""",
)
def alert_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = """named_struct(
        'active_period', CASE event_id % 3 WHEN 0 THEN NULL
            WHEN 1 THEN cast(array() AS array<struct<start:bigint,end:bigint>>)
            ELSE array(named_struct('start', active_period_start, 'end', active_period_end),
                       named_struct('start', active_period_start + 60, 'end', null)) END,
        'informed_entity', array(named_struct('agency_id', 'AG', 'route_id', route_id),
                                 named_struct('agency_id', 'AG', 'route_id', null)),
        'cause', int(cause), 'effect', 2,
        'header_text', named_struct('translation',
            array(named_struct('text', 'Notice'), named_struct('text', alert_entity_id))),
        'url', named_struct('translation',
            array(named_struct('text', concat('http://', alert_entity_id)))))"""
    texts = S.alerts(spark, sf_dir).withColumn("id", F.col("alert_entity_id"))
    texts = texts.selectExpr(f"{_entity_json('alert', body)} AS body")
    return documents.flatten(documents.parse_documents(texts, "body", "alerts"), "alerts")


@register(
    "snapshot_manifest",
    """SELECT snapshot_minute, 'vehicle_positions' AS feed,
              count(*) FILTER (WHERE event_type = 'view') AS n_rows, 0 AS n_rejected
       FROM ev GROUP BY snapshot_minute""",
)
def snapshot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every minute is seen, also those whose document holds no vehicle."""
    body = """named_struct('vehicle', named_struct('id', vehicle_id), 'stop_id', stop_id)"""
    filled = S.vehicles(spark, sf_dir).withColumns(
        {"id": F.col("event_id"), "snapshot_timestamp": F.col("snapshot_minute")}
    )
    filled = filled.selectExpr(
        "concat('v', event_id) AS file_name",
        "snapshot_minute",
        f"{_entity_json('vehicle', body)} AS body",
    )
    empty = S.minutes(spark, sf_dir).selectExpr(
        "concat('e', snapshot_minute) AS file_name",
        "snapshot_minute",
        "to_json(named_struct('header', named_struct('timestamp', snapshot_minute))) AS body",
    )
    docs = documents.parse_documents(filled.unionByName(empty), "body", "vehicle_positions")
    seen = documents.manifest(docs, "vehicle_positions")
    return seen.groupBy("feed", "snapshot_minute").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected")
    )


_NAME = "strftime(make_timestamp(e * 1000000), '%Y_%d_%m_%H_%M_%S')"


@register(
    "file_name_minutes",
    f"""SELECT DISTINCT {_NAME} || '.json' AS file_name, e - e % 60 AS utc_minute,
               CAST(epoch(timezone('Europe/London', make_timestamp((e - e % 60) * 1000000))) AS BIGINT)
                 AS snapshot_minute
        FROM ev WHERE event_type = 'view' AND e BETWEEN 1704672000 AND 1705708800""",
)
def file_name_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are read back into minutes; a range is chosen by name, ends included."""
    names = S.scores(spark, sf_dir).join(
        S.vehicles(spark, sf_dir).select("event_id"), "event_id", "left_semi"
    )
    stamp = F.date_format(clock.utc_time("ts"), clock.FILE_NAME_FORMAT)
    docs = names.select(F.concat(stamp, F.lit(".json")).alias("file_name")).distinct().unionByName(
        spark.createDataFrame([("not_a_time.json",)], "file_name string")
    )
    read = clock.file_time("file_name")
    chosen = docs.filter(
        (read >= clock.parse_time(F.lit("2024_08_01_00_00_00")))
        & (read <= clock.parse_time(F.lit("2024_20_01_00_00_00")))
    )
    minute = documents.with_snapshot_minute(
        chosen.withColumn("header", F.struct(F.lit(None).cast("long").alias("timestamp")))
    ).drop("header")
    utc = clock.epoch_of_utc(read)
    return minute.withColumn("utc_minute", utc - F.pmod(utc, F.lit(60)))


_SPELLINGS = (
    "%Y_%d_%m_%H_%M_%S", "%Y_%m_%d_%H_%M_%S", "%Y-%d-%mT%H:%M:%S", "%Y-%m-%dT%H:%M:%S",
    "%Y-%d-%m", "%Y-%m-%d",
)


@register(
    "cli_time_parse",
    f"""SELECT text, CAST(epoch(coalesce({", ".join(f"try_strptime(text, '{f}')" for f in _SPELLINGS)}))
                       AS BIGINT) AS epoch
        FROM (SELECT CASE event_id % 4 WHEN 0 THEN {_NAME}
                       WHEN 1 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%dT%H:%M:%S')
                       WHEN 2 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%d')
                       ELSE strftime(make_timestamp(e * 1000000), '%d/%m/%Y') END AS text FROM ev)""",
)
def cli_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = (clock.FILE_NAME_FORMAT, "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(F.col("event_id") % 4 == i, F.date_format(clock.utc_time("ts"), form)).otherwise(text)
    return S.scores(spark, sf_dir).select(text.alias("text")).select(
        "text", clock.epoch_of_utc(clock.parse_time("text")).alias("epoch")
    )


# Days are spread over the year so that both London and Sydney change their clocks.
_SPREAD = "e + user_id % 12 * 2592000"


@register(
    "partition_dates",
    f"""SELECT strftime(timezone('Europe/London', to_timestamp(e2)), '%Y') AS year,
               strftime(timezone('Europe/London', to_timestamp(e2)), '%m') AS month,
               strftime(timezone('Europe/London', to_timestamp(e2)), '%d') AS day,
               CAST(timezone('Australia/Sydney', to_timestamp(e2)) - INTERVAL 3 HOUR AS DATE)::VARCHAR
                 AS service_day,
               CAST(to_timestamp(e2) AS DATE)::VARCHAR AS utc_date, count(*) AS n
        FROM (SELECT {_SPREAD} AS e2 FROM ev) GROUP BY ALL""",
)
def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = S.spread_times(spark, sf_dir)
    return (
        spread.withColumns(clock.partition_columns("e2"))
        .withColumns(
            {
                "service_day": clock.service_day("e2").cast("string"),
                "utc_date": clock.utc_date("e2").cast("string"),
            }
        )
        .groupBy("year", "month", "day", "service_day", "utc_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.union_feeds(
        {
            "alerts": S.alerts(spark, sf_dir),
            "trip_updates": S.trip_updates(spark, sf_dir),
            "vehicle_positions": S.vehicles(spark, sf_dir),
        }
    )


_UNION = """SELECT 'alerts' AS feed_type, * FROM al UNION ALL BY NAME
            SELECT 'trip_updates' AS feed_type, * FROM tu UNION ALL BY NAME
            SELECT 'vehicle_positions' AS feed_type, * FROM vp"""


@register("feeds_union", _UNION)
def feeds_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir)


@register(
    "feed_value_counts",
    f"""SELECT feed_type, count(*) AS n, min(snapshot_timestamp) AS min_value,
               max(snapshot_timestamp) AS max_value FROM ({_UNION}) GROUP BY feed_type""",
)
def feed_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = _feeds(spark, sf_dir)
    ends = feeds.groupBy("feed_type").agg(
        F.min("snapshot_timestamp").alias("min_value"),
        F.max("snapshot_timestamp").alias("max_value"),
    )
    return reports.value_counts(feeds, "feed_type").join(ends, "feed_type")


@register(
    "feed_minute_lookup",
    f"""SELECT feed_type, event_id, stop_id FROM ({_UNION}) WHERE snapshot_minute = 1704103200""",
)
def feed_minute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.at_minute(_feeds(spark, sf_dir), 1704103200).select(
        "feed_type", "event_id", "stop_id"
    )


@register(
    "station_schedule",
    """SELECT c.trip_id, o.o_orderpriority AS service_id,
              CAST(o.o_custkey % 5 AS VARCHAR) AS route_id, c.stop_id, c.sched_arr,
              c.sched_arr + 45 AS sched_dep, c.stop_sequence
       FROM (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
                    CAST(min(l_suppkey) AS VARCHAR) AS stop_id,
                    (l_orderkey % 20 + l_linenumber) * 3600 + l_orderkey % 3600 AS sched_arr,
                    l_linenumber AS stop_sequence
             FROM lineitem GROUP BY l_orderkey, l_linenumber) c
       JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = c.trip_id""",
)
def station_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return static.station_schedule(S.stop_times(spark, sf_dir), S.trips(spark, sf_dir))


@register(
    "replay_batches",
    """SELECT event_id, row_number() OVER (ORDER BY snapshot_timestamp, event_id) AS position,
              (row_number() OVER (ORDER BY snapshot_timestamp, event_id) - 1) // 1000 AS batch_id
       FROM al WHERE snapshot_timestamp BETWEEN 1704153600 AND 1706400000""",
)
def replay_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.replay_batches(
        S.alerts(spark, sf_dir), 1000, 1704153600, 1706400000, ("snapshot_timestamp", "event_id")
    ).select("event_id", "position", "batch_id")


# -- routes ---------------------------------------------------------------------------------


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.route_stops(S.trip_updates(spark, sf_dir))


@register(
    "route_map",
    """SELECT route_id, direction_id, string_agg(stop_id, '>' ORDER BY pos) AS stops
       FROM rstops GROUP BY route_id, direction_id""",
)
def route_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.route_map(_stops(spark, sf_dir)).withColumn("stops", F.array_join("stops", ">"))


@register("node_degree_hub", "SELECT stop_id, node_degree, hub_flag FROM graph")
def node_degree_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.stop_graph(_stops(spark, sf_dir))


@register(
    "unmapped_keys",
    """SELECT stop_id, direction_id, count(*) AS n_rows FROM vp
       WHERE (stop_id, direction_id) NOT IN (
         SELECT (stop_id, direction_id) FROM rstops WHERE route_id = 'R0')
       GROUP BY stop_id, direction_id""",
)
def unmapped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = routes.stop_keys(_stops(spark, sf_dir).filter("route_id = 'R0'"))
    return routes.unmapped_keys(S.vehicles(spark, sf_dir), known)


@register(
    "minute_match",
    """SELECT m.snapshot_minute,
              CASE WHEN t.n IS NULL THEN 'trip_updates missing'
                   WHEN v.n IS NULL THEN 'vehicle_positions missing'
                   WHEN v.n = 0 THEN 'vehicle_positions empty' ELSE 'complete' END AS status
       FROM (SELECT DISTINCT snapshot_minute FROM ev WHERE event_type IN ('view', 'purchase')) m
       LEFT JOIN (SELECT snapshot_minute, count(*) AS n FROM ev WHERE event_type = 'purchase'
                  GROUP BY 1) t USING (snapshot_minute)
       LEFT JOIN (SELECT snapshot_minute, count(*) FILTER (WHERE k >= 40) AS n FROM ev
                  WHERE event_type = 'view' GROUP BY 1) v USING (snapshot_minute)""",
)
def minute_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = S.events(spark, sf_dir)

    def seen(feed: str, event_type: str, counted: str) -> DataFrame:
        rows = events.filter(F.col("event_type") == event_type)
        return rows.groupBy("snapshot_minute").agg(
            F.lit(feed).alias("feed"), F.expr(f"count_if({counted})").alias("n_rows")
        )

    manifest = seen("trip_updates", "purchase", "true").unionByName(
        seen("vehicle_positions", "view", "k >= 40")
    )
    return tables.paired_minutes(manifest).select("snapshot_minute", "status")


# -- parts of the features ------------------------------------------------------------------

_PLAIN = FeatureConfig(cut_lineage=False)


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.usable_updates(S.trip_updates(spark, sf_dir), _PLAIN)


@register("future_window", "SELECT snapshot_minute, round(future_window, 6) AS future_window FROM win")
def future_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.future_windows(_updates(spark, sf_dir), _PLAIN)
    return found.withColumn("future_window", F.round("future_window", 6))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return nearest.nearest_updates(updates, nearest.future_windows(updates, _PLAIN), _PLAIN)


@register(
    "nearest_forecast",
    """SELECT snapshot_minute, stop_id, direction_id, trip_id, route_id, stop_sequence,
              arrival_time, departure_time, arrival_delay, departure_delay FROM cand""",
)
def nearest_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).drop("offset")


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = station.mark_real(_candidates(spark, sf_dir), _PLAIN).filter("is_real")
    marked = marked.withColumn("vehicle_ts", F.lit(None).cast("long"))
    return station.rolling_features(station.segment_rows(marked, _PLAIN), _PLAIN)


_ROW = "snapshot_minute stop_id direction_id".split()


@register(
    "headway",
    f"SELECT snapshot_minute, stop_id, direction_id, seg, {oracles.rounded('headway_t rel_headway_t')} FROM hw",
)
def headway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir).select(*_ROW, "seg", *rounded("headway_t rel_headway_t"))


_GRADS = "delay_arrival_grad_t delay_departure_grad_t"


@register(
    "delay_gradients",
    f"""SELECT snapshot_minute, stop_id, direction_id, {oracles.rounded(_GRADS)},
               CASE WHEN departure_time IS NOT NULL THEN departure_delay - arrival_delay END
                 AS dwell_delta FROM roll""",
)
def delay_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir).select(*_ROW, *rounded(_GRADS), "dwell_delta")


_ROLLING = "delay_mean_5 delay_std_5 delay_mean_15"


@register(
    "rolling_delay",
    f"SELECT snapshot_minute, stop_id, direction_id, {oracles.rounded(_ROLLING)} FROM roll",
)
def rolling_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir).select(*_ROW, *rounded(_ROLLING))


@register(
    "headway_p90",
    f"SELECT snapshot_minute, stop_id, direction_id, {oracles.rounded('headway_p90_60')} FROM roll",
)
def headway_p90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir).select(*_ROW, *rounded("headway_p90_60"))


_AROUND = "upstream_delay_mean_2 downstream_delay_max_2"


@register(
    "upstream_downstream",
    f"""SELECT snapshot_timestamp, stop_id, direction_id, {oracles.rounded(_AROUND)} FROM feat
        WHERE upstream_delay_mean_2 IS NOT NULL OR downstream_delay_max_2 IS NOT NULL""",
)
def upstream_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    windows = nearest.future_windows(updates, _PLAIN)
    found = checkpointed(nearest.nearest_updates(updates, windows, _PLAIN))
    marked = station.mark_real(found, _PLAIN).filter("is_real")
    rows = station.segment_rows(marked, _PLAIN)
    near = routes.route_neighbours(_stops(spark, sf_dir))
    around = station.neighbour_features(
        station.upstream_delays(rows, near, _PLAIN),
        station.downstream_delays(
            rows, near, nearest.trip_stop_delays(updates, windows, _PLAIN), _PLAIN
        ),
        _PLAIN,
    )
    return around.select(
        F.col("snapshot_minute").alias("snapshot_timestamp"),
        "stop_id",
        "direction_id",
        *rounded(_AROUND),
    )


@register(
    "adaptive_lag",
    "SELECT snapshot_minute, vp_tolerance, 60 AS base FROM tol",
)
def adaptive_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = _candidates(spark, sf_dir).select("snapshot_minute").distinct()
    lags = vehicles.minute_lags(S.vehicles(spark, sf_dir), _PLAIN).join(
        served, "snapshot_minute", "left_semi"
    )
    found = vehicles.tolerances(served, lags, _PLAIN.vp_lag_secs, _PLAIN, "vp_tolerance")
    return found.withColumn("base", F.lit(60))


def _limit_sql(feed: str, base: int, only: str = "") -> str:
    """``snapshot_minute``, ``tol``: the limit after each minute that has rows, by the rows' place (``event_id``)."""
    return f"""
      WITH r AS (
        SELECT f.snapshot_minute, greatest(f.snapshot_minute - f.snapshot_timestamp, 0) AS lag,
               row_number() OVER (ORDER BY f.snapshot_minute, f.event_id,
                                  greatest(f.snapshot_minute - f.snapshot_timestamp, 0) DESC) AS i
        FROM {feed} f {only}),
      e AS (SELECT snapshot_minute, max(i) AS last_i FROM r GROUP BY snapshot_minute),
      h AS (SELECT e.snapshot_minute, list_sort(list(r.lag)) AS h
            FROM e JOIN r ON r.i > e.last_i - 60 AND r.i <= e.last_i GROUP BY e.snapshot_minute),
      q AS (SELECT snapshot_minute, CAST(h[CAST(floor(p) AS BIGINT) + 1] AS DOUBLE) AS a,
                   CAST(h[CAST(ceil(p) AS BIGINT) + 1] AS DOUBLE) AS b, p - floor(p) AS f
            FROM (SELECT *, (len(h) - 1) * CAST(0.95 AS DOUBLE) AS p FROM h))
      SELECT snapshot_minute, greatest({base}, 10 + CAST(floor(
               CASE WHEN f < 0.5 THEN a + (b - a) * f ELSE b - (b - a) * (1 - f) END) AS BIGINT)) AS tol
      FROM q"""


@register(
    "feed_limits",
    f"""SELECT s.snapshot_minute, t.tol AS tu_tolerance,
               coalesce(last_value(v.tol IGNORE NULLS) OVER (ORDER BY s.snapshot_minute
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 60) AS vp_tolerance
        FROM served s JOIN ({_limit_sql("tu", 180)}) t USING (snapshot_minute)
        LEFT JOIN ({_limit_sql("vp", 60, "JOIN served USING (snapshot_minute)")}) v
          USING (snapshot_minute)""",
)
def feed_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limits of both feeds when the last rows of a minute are those that stand last in it."""
    cfg = replace(_PLAIN, feed_order=("event_id",))
    tu, vp = S.trip_updates(spark, sf_dir), S.vehicles(spark, sf_dir)
    return vehicles.feed_limits(tu, vp, _candidates(spark, sf_dir), cfg)


@register(
    "vehicle_presence",
    """SELECT snapshot_minute, stop_id, direction_id, vehicle_ts, congestion_level,
              occupancy_status FROM veh""",
)
def vehicle_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = vehicles.latest_vehicles(S.vehicles(spark, sf_dir), _PLAIN)
    recent = F.col("vehicle_ts") >= F.col("snapshot_minute") - F.col("vp_tolerance")
    return (
        seen.join(adaptive_lag(spark, sf_dir), "snapshot_minute")
        .filter(recent)
        .drop("vp_tolerance", "base")
    )


# -- labels and metrics ---------------------------------------------------------------------

_EVENTS = "SELECT DISTINCT alert_entity_id, active_period_start, active_period_end, cause FROM al"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.build_events(S.alerts(spark, sf_dir))


@register("alert_events", _EVENTS)
def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


_LABELLED = f"""SELECT s.*, CAST(EXISTS (
    SELECT 1 FROM ({_EVENTS}) v WHERE v.active_period_start - 900 <= s.ts
       AND s.ts <= v.active_period_end) AS INTEGER) AS label FROM sc s"""


@register(
    "lead_labels",
    f"SELECT event_id, ts, stop_id, direction_id, anomaly_score, anomaly_flag, label FROM ({_LABELLED})",
)
def lead_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_scores(S.scores(spark, sf_dir), _events(spark, sf_dir)).drop(
        "arrival_delay_t", "departure_delay_t"
    )


def _delay_sql(two_sided: bool = False) -> str:
    wrap = "abs" if two_sided else ""
    test = " OR ".join(f"{wrap}(coalesce({c}, 0)) > 120" for c in ("arrival_delay_t", "departure_delay_t"))
    return f"SELECT *, CAST({test} AS INTEGER) AS label FROM sc"


@register("delay_labels", f"SELECT event_id, label FROM ({_delay_sql()})")
def delay_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_delays(S.scores(spark, sf_dir), 120).select("event_id", "label")


@register("delay_labels_two_sided", f"SELECT event_id, label FROM ({_delay_sql(True)})")
def delay_labels_two_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_delays(S.scores(spark, sf_dir), 120, two_sided=True).select(
        "event_id", "label"
    )


@register(
    "attached_delays",
    """SELECT s.event_id, coalesce(f.arrival_delay_t, 0.0) AS arrival_delay_t,
              coalesce(f.departure_delay_t, 0.0) AS departure_delay_t
       FROM sc s LEFT JOIN (
         SELECT snapshot_minute + 7200 AS ts, stop_id, direction_id, arr AS arrival_delay_t,
                dep AS departure_delay_t FROM real) f
       ON f.ts = s.ts - s.ts % 3600 AND f.stop_id = s.stop_id AND f.direction_id = s.direction_id""",
)
def attached_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = _rolled(spark, sf_dir).select(
        (F.col("snapshot_minute") + 7200).alias("snapshot_timestamp"),
        "stop_id",
        "direction_id",
        F.col("arr").alias("arrival_delay_t"),
        F.col("dep").alias("departure_delay_t"),
    )
    hourly = S.scores(spark, sf_dir).withColumn("ts", F.expr("ts - ts % 3600"))
    return labels.attach_delays(hourly, rolled).select(
        "event_id", "arrival_delay_t", "departure_delay_t"
    )


@register(
    "maintenance_excluded",
    f"""SELECT event_id, ts FROM (SELECT event_id, {_SPREAD} AS ts FROM ev)
        WHERE CAST(to_timestamp(ts) AS DATE) NOT IN (
          SELECT CAST(to_timestamp(snapshot_timestamp) AS DATE) FROM al WHERE cause IN ('9', '10'))""",
)
def maintenance_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alerts against times spread over the year: every day of the alerts has planned works."""
    scored = S.spread_times(spark, sf_dir).withColumnRenamed("e2", "ts")
    return labels.outside_planned_days(scored, S.alerts(spark, sf_dir)).select("event_id", "ts")


@register(
    "unplanned_events", f"SELECT * FROM ({_EVENTS}) WHERE cause NOT IN ('9', '10')"
)
def unplanned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.without_planned(_events(spark, sf_dir))


def _auc_sql(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
      SELECT {lead}coalesce((sum(CASE WHEN label = 1 THEN rnk END) - sum(label) * (sum(label) + 1) / 2.0)
               / nullif(sum(label) * CAST(sum(1 - label) AS DOUBLE), 0), 0.0) AS lead_time_roc_auc
      FROM (SELECT *, rank() OVER ({part} ORDER BY anomaly_score)
                      + (count(*) OVER ({part}{"," if by else "PARTITION BY"} anomaly_score) - 1) / 2.0 AS rnk
            FROM ({source})) {group}"""


def _precision_sql(source: str, k: int, by: str = "", tie: str = "ts, stop_id, direction_id") -> str:
    lead = f"{by}, " if by else ""
    return f"""
      SELECT {lead}avg(share) AS precision_at_k FROM (
        SELECT {lead}d, avg(label) AS share FROM (
          SELECT *, row_number() OVER (PARTITION BY {lead}d ORDER BY anomaly_score DESC, {tie}) AS rn
          FROM (SELECT *, CAST(to_timestamp(ts) AS DATE) AS d FROM ({source})))
        WHERE rn <= {k} GROUP BY {lead}d) {f"GROUP BY {by}" if by else ""}"""


def _fpr_sql(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""
      SELECT {lead}coalesce(count(*) FILTER (WHERE label = 0 AND anomaly_flag = 1)
             / nullif(CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE), 0), 0.0) AS fpr
      FROM ({source}) {f"GROUP BY {by}" if by else ""}"""


def _runs_sql(source: str, part: str, order: str) -> str:
    over = f"OVER (PARTITION BY {part} ORDER BY {order})"
    return f"""
      SELECT {part}, run, min(ts) AS started_at, min(ts) FILTER (WHERE anomaly_flag = 1) AS flagged_at
      FROM (SELECT *, sum(opens) {over} AS run
            FROM (SELECT *, CASE WHEN label = 1 AND coalesce(lag(label) {over}, 0) = 0
                                 THEN 1 ELSE 0 END AS opens FROM ({source})))
      WHERE label = 1 GROUP BY {part}, run"""


def _distinct_rows(scored: DataFrame) -> DataFrame:
    """One score per time, stop and direction, as a real run has."""
    return scored.groupBy("ts", "stop_id", "direction_id").agg(
        F.max("anomaly_score").alias("anomaly_score"),
        F.max("anomaly_flag").alias("anomaly_flag"),
        F.max("arrival_delay_t").alias("arrival_delay_t"),
        F.max("departure_delay_t").alias("departure_delay_t"),
    )


_SC1 = """SELECT ts, stop_id, direction_id, max(anomaly_score) AS anomaly_score,
                 max(anomaly_flag) AS anomaly_flag, max(arrival_delay_t) AS arrival_delay_t,
                 max(departure_delay_t) AS departure_delay_t
          FROM sc GROUP BY ts, stop_id, direction_id"""
_DELAYED = _delay_sql().replace("FROM sc", f"FROM ({_SC1})")
_LEAD = _LABELLED.replace("FROM sc s", f"FROM ({_SC1}) s")


def _delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_delays(_distinct_rows(S.scores(spark, sf_dir)), 120)


@register("roc_auc", f"SELECT round(lead_time_roc_auc, 6) AS lead_time_roc_auc FROM ({_auc_sql(_DELAYED)})")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(_delayed(spark, sf_dir)).select(*rounded("lead_time_roc_auc"))


@register("precision_at_k", f"SELECT round(precision_at_k, 6) AS precision_at_k FROM ({_precision_sql(_DELAYED, 50)})")
def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.precision_at_k(_delayed(spark, sf_dir)).select(*rounded("precision_at_k"))


@register("fpr", f"SELECT round(fpr, 6) AS fpr FROM ({_fpr_sql(_DELAYED)})")
def fpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.false_positive_rate(_delayed(spark, sf_dir)).select(*rounded("fpr"))


_FIRST = f"""
  SELECT v.*, (SELECT min(s.ts) FROM ({_SC1}) s WHERE s.anomaly_flag = 1
                 AND s.ts BETWEEN v.active_period_start AND v.active_period_end) AS detected_at
  FROM ({_EVENTS}) v
  WHERE v.active_period_start IS NOT NULL AND v.active_period_end IS NOT NULL"""
_MTTD_EVENTS = f"SELECT avg((detected_at - active_period_start) / 60.0) AS mttd FROM ({_FIRST})"


@register("first_detections", _FIRST)
def first_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.first_detections(
        _distinct_rows(S.scores(spark, sf_dir)), _events(spark, sf_dir)
    )


@register("mttd_events", f"SELECT round(mttd, 6) AS mttd FROM ({_MTTD_EVENTS})")
def mttd_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _distinct_rows(S.scores(spark, sf_dir))
    return metrics.mttd_events(scored, _events(spark, sf_dir)).select(*rounded("mttd"))


@register("label_runs", _runs_sql(_DELAYED, "stop_id, direction_id", "ts"))
def label_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_runs(_delayed(spark, sf_dir))


def _mttd_flags_sql(network: bool) -> str:
    source, part, order = _DELAYED, "stop_id, direction_id", "ts"
    if network:
        source, part, order = f"SELECT 1 AS one, * FROM ({_DELAYED})", "one", "ts, stop_id, direction_id"
    runs = _runs_sql(source, part, order)
    return f"SELECT avg((flagged_at - started_at) / 60.0) AS mttd FROM ({runs})"


@register("mttd_flags", f"SELECT round(mttd, 6) AS mttd FROM ({_mttd_flags_sql(False)})")
def mttd_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.mttd_flags(_delayed(spark, sf_dir)).select(*rounded("mttd"))


@register("mttd_flags_network", f"SELECT round(mttd, 6) AS mttd FROM ({_mttd_flags_sql(True)})")
def mttd_flags_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.mttd_flags(_delayed(spark, sf_dir), across="network")
    return found.select(*rounded("mttd"))


_METRICS = "lead_time_roc_auc precision_at_k mttd fpr"


@register(
    "metrics_alerts",
    f"""SELECT {oracles.rounded(_METRICS)} FROM ({_auc_sql(_LEAD)}), ({_precision_sql(_LEAD, 50)}),
               ({_MTTD_EVENTS}), ({_fpr_sql(_LEAD)})""",
)
def metrics_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _distinct_rows(S.scores(spark, sf_dir))
    return metrics.evaluate(scored, _events(spark, sf_dir)).select(*rounded(_METRICS))


@register(
    "metrics_delays",
    f"""SELECT {oracles.rounded(_METRICS)} FROM ({_auc_sql(_DELAYED)}),
               ({_precision_sql(_DELAYED, 50)}), ({_mttd_flags_sql(False)}), ({_fpr_sql(_DELAYED)})""",
)
def metrics_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _distinct_rows(S.scores(spark, sf_dir))
    return metrics.evaluate(scored, delay_threshold=120).select(*rounded(_METRICS))


@register(
    "label_errors",
    f"""SELECT CASE WHEN label = 1 THEN 'missed' ELSE 'spurious' END AS kind, ts, stop_id,
               direction_id, anomaly_score FROM ({_DELAYED}) WHERE label <> anomaly_flag""",
)
def label_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    delayed = _delayed(spark, sf_dir)
    missed = labels.false_negatives(delayed).withColumn("kind", F.lit("missed"))
    spurious = labels.false_positives(delayed).withColumn("kind", F.lit("spurious"))
    return missed.unionByName(spurious).select(
        "kind", "ts", "stop_id", "direction_id", "anomaly_score"
    )


# -- detector -------------------------------------------------------------------------------

SMALL = DetectorConfig(n_trees=4, height=3, window_size=32, threshold_quantile=0.9, seed=7)
WIDE = DetectorConfig(n_trees=4, height=3, window_size=24, threshold_quantile=0.8, seed=7)
_ALL_STOPS = detect.DetectorInput(stations=None)
oracles.VIEWS.update(oracles.detector_views(SMALL, "small"))
oracles.VIEWS.update(oracles.detector_views(WIDE, "wide"))


def _scored(spark: SparkSession, sf_dir: str, explain=None) -> DataFrame:
    feats = checkpointed(_features(spark, sf_dir))
    return detect.score_features(feats, SMALL, _ALL_STOPS, explain)


@register(
    "hst_scores",
    """SELECT day::VARCHAR AS day, ts, stop_id, direction_id, seq,
              round(anomaly_score, 9) AS anomaly_score FROM small_scores""",
)
def hst_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(
        F.col("day").cast("string").alias("day"),
        "ts",
        "stop_id",
        "direction_id",
        "seq",
        *rounded("anomaly_score", 9),
    )


@register(
    "hst_flags", "SELECT ts, stop_id, direction_id, anomaly_flag FROM small_flags"
)
def hst_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("ts", "stop_id", "direction_id", "anomaly_flag")


_EXPLAINED = "stop_id IS NOT NULL"  # all rows
oracles.VIEWS["xkeys"] = f"""
  SELECT row_number() OVER (ORDER BY d.rid, f.feature) AS vid, d.rid, f.feature AS zeroed
  FROM det d, (SELECT DISTINCT feature FROM detlong) f WHERE d.{_EXPLAINED}"""
oracles.VIEWS["xlong"] = """
  SELECT k.vid, l.feature, CASE WHEN l.feature = k.zeroed THEN 0.0 ELSE l.value END AS value
  FROM xkeys k JOIN detlong l ON l.rid = k.rid"""
oracles.VIEWS["explained"] = oracles.explain_view(SMALL, "small", _EXPLAINED)


def _explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, F.expr(_EXPLAINED)).filter("top_features IS NOT NULL")


@register(
    "hst_explain",
    """SELECT d.ts, d.stop_id, d.direction_id, x.rnk, x.feature,
              round(x.contribution, 9) + 0.0 AS contribution
       FROM explained x JOIN det d USING (rid) WHERE x.rnk <= 3""",
)
def hst_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _explained(spark, sf_dir)
        .select("ts", "stop_id", "direction_id", F.posexplode("top_features").alias("rnk", "top"))
        .select(
            "ts",
            "stop_id",
            "direction_id",
            (F.col("rnk") + 1).alias("rnk"),
            "top.feature",
            (F.round("top.contribution", 9) + 0.0).alias("contribution"),
        )
    )


@register(
    "driver_frequency",
    "SELECT feature, count(*) AS appearances FROM explained WHERE rnk <= 3 GROUP BY feature",
)
def driver_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.driver_frequency(_explained(spark, sf_dir))


@register(
    "run_summary",
    """SELECT count(*) AS snapshots, sum(flags) AS anomalies, round(avg(m), 6) AS mean_score
       FROM (SELECT ts, sum(anomaly_flag) AS flags, avg(anomaly_score) AS m
             FROM small_flags GROUP BY ts)""",
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.run_summary(_scored(spark, sf_dir)).select(
        "snapshots", "anomalies", *rounded("mean_score")
    )


GRID = {
    "n_trees": [4],
    "height": [3],
    "window_size": [24, 32],
    "threshold_quantile": [0.8, 0.9],
    "seed": 7,
}


def _grid_sql() -> str:
    rows = []
    for psi, q, view in ((24, 0.8, "wide"), (24, 0.9, "wide9"), (32, 0.8, "small8"), (32, 0.9, "small")):
        rows.append(
            f"SELECT {psi} AS window_size, {q} AS threshold_quantile, f.ts, f.stop_id, f.direction_id,"
            f" f.anomaly_score, f.anomaly_flag,"
            f" CAST(d.arrival_delay_t > 120 OR d.departure_delay_t > 120 AS INTEGER) AS label"
            f" FROM {view}_flags f JOIN det d USING (rid)"
        )
    return " UNION ALL ".join(rows)


oracles.VIEWS.update(
    oracles.detector_views(replace(WIDE, threshold_quantile=0.9), "wide9")
)
oracles.VIEWS.update(oracles.detector_views(replace(SMALL, threshold_quantile=0.8), "small8"))
oracles.VIEWS["gridrows"] = _grid_sql()
_BY = "window_size, threshold_quantile"
_GRID_METRICS = f"""
  SELECT {_BY}, {oracles.rounded(_METRICS)}
  FROM ({_auc_sql("SELECT * FROM gridrows", _BY)})
  JOIN ({_precision_sql("SELECT * FROM gridrows", 50, _BY)}) USING ({_BY})
  JOIN ({_fpr_sql("SELECT * FROM gridrows", _BY)}) USING ({_BY})
  LEFT JOIN (SELECT {_BY}, avg((flagged_at - started_at) / 60.0) AS mttd
        FROM ({_runs_sql("SELECT * FROM gridrows", _BY + ", stop_id, direction_id", "ts")})
        GROUP BY {_BY}) USING ({_BY})"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = checkpointed(_features(spark, sf_dir))
    return tune.grid_search(feats, GRID, _ALL_STOPS, delay_threshold=120)


@register("grid_search", _GRID_METRICS)
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("window_size", "threshold_quantile", *rounded(_METRICS))


@register(
    "grid_search_best",
    f"""SELECT {_BY}, lead_time_roc_auc FROM ({_GRID_METRICS})
        ORDER BY lead_time_roc_auc DESC, window_size, threshold_quantile LIMIT 1""",
)
def grid_search_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.best_config(_grid(spark, sf_dir)).select(
        "window_size", "threshold_quantile", *rounded("lead_time_roc_auc")
    )


# -- reports --------------------------------------------------------------------------------


@register(
    "station_rates",
    """SELECT stop_id, sum(anomaly_flag) AS total_anoms, count(*) AS total_snaps,
              round(sum(anomaly_flag) / CAST(count(*) AS DOUBLE), 6) AS rate FROM sc GROUP BY stop_id""",
)
def station_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.station_rates(S.scores(spark, sf_dir)).withColumn("rate", F.round("rate", 6))


@register(
    "high_confidence",
    """SELECT stop_id, count(*) FILTER (WHERE anomaly_score >= 0.99) AS n_high, count(*) AS total,
              round(count(*) FILTER (WHERE anomaly_score >= 0.99) / CAST(count(*) AS DOUBLE), 6)
                AS rate_high FROM sc GROUP BY stop_id""",
)
def high_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.high_confidence(S.scores(spark, sf_dir)).withColumn(
        "rate_high", F.round("rate_high", 6)
    )


@register(
    "top_anomalies",
    """SELECT event_id, ts, stop_id, direction_id, anomaly_score FROM sc
       ORDER BY anomaly_score DESC, ts, stop_id, direction_id, event_id LIMIT 10""",
)
def top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_anomalies(S.scores(spark, sf_dir)).select(
        "event_id", "ts", "stop_id", "direction_id", "anomaly_score"
    )


@register(
    "rows_of_top_stations",
    """SELECT event_id, stop_id FROM sc WHERE anomaly_score >= 0.99 AND stop_id IN (
         SELECT stop_id FROM sc GROUP BY stop_id
         ORDER BY count(*) FILTER (WHERE anomaly_score >= 0.99) DESC, stop_id LIMIT 3)""",
)
def rows_of_top_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rows_of_top_stations(S.scores(spark, sf_dir), n=3).select("event_id", "stop_id")


@register(
    "station_timelines",
    """SELECT stop_id, d::VARCHAR AS date, n_day, sum(n_day) OVER (PARTITION BY stop_id) AS n_anomalies,
              snapshots_ts
       FROM (SELECT stop_id, CAST(to_timestamp(ts) AS DATE) AS d, count(*) AS n_day,
                    string_agg(CAST(ts AS VARCHAR), ',' ORDER BY ts) AS snapshots_ts
             FROM sc WHERE anomaly_flag = 1 GROUP BY ALL)""",
)
def station_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = reports.station_timelines(S.scores(spark, sf_dir))
    return lines.select(
        "stop_id",
        F.col("date").cast("string").alias("date"),
        "n_day",
        "n_anomalies",
        F.array_join(F.col("snapshots_ts").cast("array<string>"), ",").alias("snapshots_ts"),
    )


@register(
    "score_histogram",
    """SELECT least(CAST(floor((anomaly_score - a) / (b - a) * 20) AS BIGINT), 19) AS bin, count(*) AS n
       FROM sc, (SELECT min(anomaly_score) AS a, max(anomaly_score) AS b FROM sc) GROUP BY 1""",
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(S.scores(spark, sf_dir), "anomaly_score", 20)


@register(
    "rate_histogram",
    """SELECT least(CAST(floor((rate - a) / (b - a) * 30) AS BIGINT), 29) AS bin, count(*) AS n
       FROM (SELECT stop_id, avg(anomaly_flag) AS rate FROM sc GROUP BY stop_id),
            (SELECT min(r) AS a, max(r) AS b FROM (SELECT avg(anomaly_flag) AS r FROM sc GROUP BY stop_id))
       GROUP BY 1""",
)
def rate_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(reports.station_rates(S.scores(spark, sf_dir)), "rate", 30)


@register(
    "label_prevalence",
    f"""SELECT sum(label) AS positives, count(*) AS total, round(avg(label), 6) AS rate
        FROM ({_delay_sql(True)})""",
)
def label_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labels.label_delays(S.scores(spark, sf_dir), 120, two_sided=True)
    return reports.label_prevalence(labelled).withColumn("rate", F.round("rate", 6))


def _describe_sql(source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
                   round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
                   CAST(max({c}) AS DOUBLE) AS max,
                   round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
                   round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
                   round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM {source}"""
        for c in columns.split()
    )


_STATS = "mean std q25 q50 q75"


@register("delay_describe", _describe_sql("sc", "arrival_delay_t departure_delay_t"))
def delay_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.describe(S.scores(spark, sf_dir), ["arrival_delay_t", "departure_delay_t"])
    return found.select("column", "count", "min", "max", *rounded(_STATS))


_PROFILED = {
    "event_id": "bigint", "snapshot_minute": "bigint", "snapshot_timestamp": "bigint",
    "stop_id": "string", "direction_id": "int", "vehicle_id": "string", "latitude": "double",
    "congestion_level": "string", "occupancy_status": "string",
}


def _profile_sql() -> str:
    parts = []
    for c, kind in _PROFILED.items():
        numeric = kind != "string"
        order = f"CAST({c} AS DOUBLE)" if numeric else c
        stats = (
            f"""round(avg({c}), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 2) AS std,
                CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, """
            + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.{q}), 6) AS q{q}" for q in (25, 50, 75))
            if numeric
            else ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in "mean std min max q25 q50 q75".split())
        )
        parts.append(
            f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count({c}) AS non_null,
                       count(DISTINCT {c}) AS n_unique,
                       round(100.0 * (count(*) - count({c})) / count(*), 1) AS pct_missing, {stats},
                       (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY o) FROM (
                          SELECT DISTINCT {c} AS v, {order} AS o FROM vp WHERE {c} IS NOT NULL
                          ORDER BY o LIMIT 10)) AS sample_values
                FROM vp"""
        )
    return " UNION ALL ".join(parts)


@register("column_profile", _profile_sql())
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = reports.column_profile(S.vehicles(spark, sf_dir).select(*_PROFILED))
    return profile.select(
        "column", "dtype", "non_null", "n_unique", "pct_missing", *rounded("mean", 4), *rounded("std", 2),
        "min", "max", *rounded("q25 q50 q75"), "sample_values",
    )


_FEED_COLUMNS = (
    "event_id snapshot_timestamp stop_id direction_id alert_entity_id active_period_end"
    " route_id cause trip_id departure_time arrival_delay vehicle_id latitude congestion_level"
).split()


@register(
    "column_presence",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT feed_type, '{c}' AS "column", round(avg(CAST({c} IS NOT NULL AS INTEGER)), 6)
              AS present_share FROM ({_UNION}) GROUP BY feed_type"""
        for c in _FEED_COLUMNS
    )
    + ") WHERE present_share >= 0.5",
)
def column_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = _feeds(spark, sf_dir).select("feed_type", *_FEED_COLUMNS)
    return reports.column_presence(feeds).withColumn("present_share", F.round("present_share", 6))


_RATED = (*_DOUBLES.split(), "day_type", "node_degree", "hub_flag", "central_flag", "is_train_present")


@register(
    "feature_null_rates",
    f"""SELECT snapshot_timestamp, count(*) AS n_rows,
               {", ".join(f"round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS {c}_null_rate" for c in _RATED)}
        FROM feat GROUP BY snapshot_timestamp""",
)
def feature_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = reports.feature_null_rates(_features(spark, sf_dir), _RATED)
    shares = " ".join(f"{c}_null_rate" for c in _RATED)
    return rates.select("snapshot_timestamp", "n_rows", *rounded(shares))


@register(
    "headway_qa",
    """SELECT snapshot_timestamp, CASE WHEN count(headway_t) > 0 THEN 'PASS' ELSE 'FAIL' END AS result
       FROM feat GROUP BY snapshot_timestamp""",
)
def headway_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.headway_check(_features(spark, sf_dir))


@register(
    "delay_quality",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(count({c}) / CAST(count(*) AS DOUBLE), 6) AS non_null_share,
                   CAST(count({c}) >= 0.95 * count(*) AS INTEGER) AS passes FROM tu"""
        for c in ("arrival_delay", "departure_delay")
    ),
)
def delay_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.non_null_shares(
        S.trip_updates(spark, sf_dir), ["arrival_delay", "departure_delay"]
    )
    return found.withColumn("non_null_share", F.round("non_null_share", 6))
