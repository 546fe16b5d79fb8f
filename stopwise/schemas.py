"""Schemas of the raw documents and of the flat tables."""

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT = _struct(translation=T.ArrayType(_struct(text=_S, language=_S)))
_TRIP = _struct(trip_id=_S, route_id=_S, direction_id=_I, start_time=_S, start_date=_S)
_STOP_TIME = _struct(time=_L, delay=_D)

_TRIP_UPDATE = _struct(
    trip=_TRIP,
    vehicle=_struct(id=_S),
    stop_time_update=T.ArrayType(
        _struct(stop_sequence=_I, stop_id=_S, arrival=_STOP_TIME, departure=_STOP_TIME)
    ),
)
_VEHICLE = _struct(
    trip=_TRIP,
    vehicle=_struct(id=_S),
    position=_struct(latitude=_D, longitude=_D, bearing=_D, speed=_D),
    current_stop_sequence=_I,
    current_status=_S,
    stop_id=_S,
    congestion_level=_S,
    occupancy_status=_S,
)
_ALERT = _struct(
    active_period=T.ArrayType(_struct(start=_L, end=_L)),
    informed_entity=T.ArrayType(_struct(agency_id=_S, route_id=_S, direction_id=_I)),
    cause=_S,
    effect=_S,
    header_text=_TEXT,
    description_text=_TEXT,
    url=_TEXT,
)


def _document(member: str, body: T.StructType) -> T.StructType:
    entity = T.StructType([T.StructField("id", _S), T.StructField(member, body)])
    return _struct(header=_struct(timestamp=_L), entity=T.ArrayType(entity))


FEEDS = ("alerts", "trip_updates", "vehicle_positions")

DOCUMENT_SCHEMAS = {
    "alerts": _document("alert", _ALERT),
    "trip_updates": _document("trip_update", _TRIP_UPDATE),
    "vehicle_positions": _document("vehicle", _VEHICLE),
}

TRIP_UPDATES = _struct(
    snapshot_timestamp=_L,
    trip_id=_S,
    route_id=_S,
    direction_id=_I,
    start_time=_S,
    start_date=_S,
    vehicle_id=_S,
    stop_sequence=_I,
    stop_id=_S,
    arrival_time=_L,
    departure_time=_L,
    arrival_delay=_I,
    departure_delay=_I,
)
VEHICLE_POSITIONS = _struct(
    snapshot_timestamp=_L,
    trip_id=_S,
    route_id=_S,
    direction_id=_I,
    vehicle_id=_S,
    latitude=_D,
    longitude=_D,
    bearing=_D,
    speed=_D,
    current_stop_sequence=_I,
    current_status=_S,
    stop_id=_S,
    congestion_level=_S,
    occupancy_status=_S,
)
ALERTS = _struct(
    snapshot_timestamp=_L,
    alert_entity_id=_S,
    active_period_start=_L,
    active_period_end=_L,
    agency_id=_S,
    route_id=_S,
    direction_id=_I,
    cause=_S,
    effect=_S,
    header_text=_S,
    description_text=_S,
    url=_S,
)
TABLE_SCHEMAS = {
    "alerts": ALERTS,
    "trip_updates": TRIP_UPDATES,
    "vehicle_positions": VEHICLE_POSITIONS,
}

STATION_SCHEDULE = _struct(
    trip_id=_S,
    service_id=_S,
    route_id=_S,
    stop_id=_S,
    sched_arr=_I,
    sched_dep=_I,
    stop_sequence=_I,
)
