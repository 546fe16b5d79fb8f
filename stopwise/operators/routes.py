"""Ordered stops of each route and direction, and the stop graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def route_stops(trip_updates: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per route, direction and stop with its place ``pos`` on the route.

    A stop seen under several sequence numbers takes the smallest. The aggregate
    runs before the shuffle, so only distinct stops move.
    """
    route = [*scope, "route_id", "direction_id"]
    stops = trip_updates.groupBy(*route, "stop_id").agg(F.min("stop_sequence").alias("seq"))
    order = Window.partitionBy(*route).orderBy("seq", "stop_id")
    return stops.select(*route, "stop_id", "seq", F.row_number().over(order).alias("pos"))


def route_map(stops: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Ordered list of stops per route and direction."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "stop_id")))
    return stops.groupBy(*scope, "route_id", "direction_id").agg(
        F.transform(listed, lambda s: s["stop_id"]).alias("stops")
    )


def stop_keys(stops: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Stop and direction pairs the feature table covers."""
    return stops.select(*scope, "stop_id", "direction_id").distinct()


def route_neighbours(stops: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Up to two stops before and two after each stop of a route and direction."""
    along = Window.partitionBy(*scope, "route_id", "direction_id").orderBy("pos")
    near = {
        "prev_1": F.lag("stop_id", 1).over(along),
        "prev_2": F.lag("stop_id", 2).over(along),
        "next_1": F.lead("stop_id", 1).over(along),
        "next_2": F.lead("stop_id", 2).over(along),
    }
    return stops.withColumns(near).select(
        *scope, "route_id", "direction_id", "stop_id", *near
    )


def stop_graph(stops: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Number of distinct neighbours per stop and whether it is a hub.

    A hub has at least the 90th percentile of all degrees. Stops without a
    neighbour are not part of the graph.
    """
    scope = list(scope)
    along = Window.partitionBy(*scope, "route_id", "direction_id").orderBy("pos")
    pairs = stops.select(
        *scope, F.col("stop_id").alias("a"), F.lead("stop_id").over(along).alias("b")
    ).filter(F.col("b").isNotNull())
    both = pairs.select(*scope, F.col("a").alias("stop_id"), F.col("b").alias("other")).union(
        pairs.select(*scope, F.col("b"), F.col("a"))
    )
    degrees = both.groupBy(*scope, "stop_id").agg(
        F.count_distinct("other").cast("int").alias("node_degree")
    )
    limit = F.percentile("node_degree", 0.9).alias("_limit")
    if scope:
        limited = degrees.join(degrees.groupBy(*scope).agg(limit), scope)
    else:
        limited = degrees.withColumn("_limit", degrees.agg(limit).scalar())
    return limited.withColumn(
        "hub_flag", (F.col("node_degree") >= F.col("_limit")).cast("int")
    ).drop("_limit")


def unmapped_keys(
    trip_updates: DataFrame, keys: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Stop and direction pairs in the feed that no route covers, with their row count."""
    key = [*scope, "stop_id", "direction_id"]
    seen = trip_updates.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return seen.join(keys, key, "left_anti")
