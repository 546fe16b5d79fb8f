"""The station-feature plan: feeds in, one row per minute, stop and direction out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import FeatureConfig
from stopwise.operators import nearest, routes, station, vehicles
from stopwise.plans.lineage import cut

FEATURE_COLUMNS = (
    "arrival_delay_t",
    "departure_delay_t",
    "headway_t",
    "rel_headway_t",
    "dwell_delta_t",
    "delay_arrival_grad_t",
    "delay_departure_grad_t",
    "upstream_delay_mean_2",
    "downstream_delay_max_2",
    "delay_mean_5",
    "delay_std_5",
    "delay_mean_15",
    "headway_p90_60",
    "sin_hour",
    "cos_hour",
    "day_type",
    "node_degree",
    "hub_flag",
    "congestion_level",
    "occupancy_status",
    "central_flag",
    "is_train_present",
    "data_fresh_secs",
)


@dataclass(frozen=True)
class Network:
    """Tables derived from the ordered stops of the routes."""

    keys: DataFrame
    neighbours: DataFrame
    graph: DataFrame

    @classmethod
    def from_stops(cls, stops: DataFrame, cfg: FeatureConfig) -> Network:
        # A few rows per route, read from the whole feed: made once, used many times.
        stops = cut(stops, cfg)
        return cls(
            keys=routes.stop_keys(stops, cfg.scope),
            neighbours=routes.route_neighbours(stops, cfg.scope),
            graph=routes.stop_graph(stops, cfg.scope),
        )


@dataclass(frozen=True)
class Carry:
    """What a run hands to the next one; see :func:`feature_tables`."""

    rows: DataFrame
    lags: DataFrame


@dataclass(frozen=True)
class FeatureTables:
    features: DataFrame
    rolled: DataFrame
    lags: DataFrame


def _require(df: DataFrame, name: str, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")


def feature_tables(
    tu: DataFrame,
    vp: DataFrame,
    minutes: DataFrame,
    network: Network,
    cfg: FeatureConfig = FeatureConfig(),
    carry: Carry | None = None,
) -> FeatureTables:
    """Features of ``minutes`` plus the tables a following run needs.

    ``tu`` and ``vp`` hold the rows of each minute's own files, marked with
    ``snapshot_minute``; ``minutes`` lists the minutes to put out.
    """
    _require(tu, "trip updates", [*cfg.minute_key, "snapshot_timestamp", "stop_id", "direction_id"])
    _require(vp, "vehicles", [*cfg.minute_key, "snapshot_timestamp", "stop_id", "direction_id"])

    wanted = minutes.select(*cfg.minute_key)
    updates = nearest.usable_updates(tu, cfg)
    # One row per minute, used by two reductions of the feed.
    windows = cut(nearest.future_windows(updates, cfg), cfg)
    found = nearest.nearest_updates(updates, windows, cfg)
    # Joined while both sides are still partitioned by the row key.
    seen = vehicles.latest_vehicles(vp, cfg)
    found = cut(
        found.join(seen, cfg.row_key, "left").join(wanted, cfg.minute_key, "left_semi"), cfg
    )

    served = found.groupBy(*cfg.minute_key).agg(
        (F.min("route_id") != F.max("route_id")).alias("many_routes")
    )
    lags = vehicles.minute_lags(vp, cfg).join(served, cfg.minute_key, "left_semi")
    active = served.select(*cfg.minute_key)
    if carry is not None:
        lags = lags.unionByName(carry.lags)
        active_or_old = active.union(carry.lags.select(*cfg.minute_key))
    else:
        active_or_old = active
    limits = vehicles.tolerances(active_or_old, lags, cfg.vp_lag_secs, cfg, "vp_tolerance")

    candidates = found.join(network.keys, cfg.stop_key, "left_semi")
    carried = carry.rows if carry is not None else None
    marked = station.mark_real(candidates, cfg, carried)
    context = served.join(limits, cfg.minute_key)
    recent = F.col("vehicle_ts") >= F.col("snapshot_minute") - F.col("vp_tolerance")
    marked = marked.join(context, cfg.minute_key).withColumns(
        {
            c: F.when(recent, F.col(c))
            for c in ("vehicle_ts", "congestion_level", "occupancy_status")
        }
    )
    marked = cut(marked.withColumn("route_shown", F.when(F.col("many_routes"), F.col("route_id"))), cfg)

    real = marked.filter("is_real").drop("is_real", "many_routes", "vp_tolerance")
    rows = station.segment_rows(real, cfg, carried)
    rolled = station.rolling_features(rows, cfg)

    up = station.upstream_delays(rows, network.neighbours, cfg)
    trip_delays = nearest.trip_stop_delays(updates, windows, cfg)
    down = station.downstream_delays(rows, network.neighbours, trip_delays, cfg)
    around = station.neighbour_features(up, down, cfg)

    shown = (
        rolled.filter("is_new")
        .join(around, cfg.row_key, "left")
        .withColumns(station.vehicle_features(cfg))
        .select(
            *cfg.row_key,
            F.col("route_shown").alias("route_id"),
            F.col("arr").alias("arrival_delay_t"),
            F.col("dep").alias("departure_delay_t"),
            "headway_t",
            "rel_headway_t",
            F.col("dwell_delta").alias("dwell_delta_t"),
            "delay_arrival_grad_t",
            "delay_departure_grad_t",
            "upstream_delay_mean_2",
            "downstream_delay_max_2",
            "delay_mean_5",
            "delay_std_5",
            "delay_mean_15",
            "headway_p90_60",
            "congestion_level",
            "occupancy_status",
            "is_train_present",
            "data_fresh_secs",
        )
    )
    # A suppressed candidate is a gap row that still shows its route.
    gaps = marked.filter("NOT is_real").select(
        *cfg.row_key, F.col("route_shown").alias("route_id")
    )
    filled = shown.unionByName(gaps, allowMissingColumns=True)

    grid = station.minute_key_grid(wanted, network.keys, cfg)
    features = (
        grid.join(filled, cfg.row_key, "left")
        .join(network.graph, [*cfg.scope, "stop_id"], "left")
        .withColumns(
            {
                **station.clock_features("snapshot_minute", cfg),
                "node_degree": F.coalesce("node_degree", F.lit(0)),
                "hub_flag": F.coalesce("hub_flag", F.lit(0)),
                "central_flag": F.col("stop_id").isin(*cfg.central_stops).cast("int"),
                "is_train_present": F.coalesce("is_train_present", F.lit(0)),
            }
        )
        .select(
            *cfg.scope,
            F.col("snapshot_minute").alias("snapshot_timestamp"),
            "stop_id",
            "direction_id",
            "route_id",
            *FEATURE_COLUMNS,
            "local_dt",
        )
    )
    return FeatureTables(features=features, rolled=rolled, lags=lags)


def station_features(
    tu: DataFrame,
    vp: DataFrame,
    minutes: DataFrame,
    cfg: FeatureConfig = FeatureConfig(),
    stops: DataFrame | None = None,
) -> DataFrame:
    """Features of every mapped stop and direction in every listed minute."""
    ordered = stops if stops is not None else routes.route_stops(tu, cfg.scope)
    return feature_tables(tu, vp, minutes, Network.from_stops(ordered, cfg), cfg).features
