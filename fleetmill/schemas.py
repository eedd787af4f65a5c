"""Schemas of sources and tables."""

from __future__ import annotations

#: One poll of the vehicle-position interface. Vehicle ids come as numbers or texts: read as text.
API_RESPONSE = "hr string, l array<struct<c:string,cl:int,sl:int,lt0:string,lt1:string,vs:array<struct<p:string,a:boolean,ta:string,py:double,px:double>>>>"

RAW_POSITIONS = (
    "vehicle_id string, line_code int, line_number string, line_direction int, latitude double, longitude double, "
    "is_accessible boolean, event_timestamp string, ingestion_timestamp string"
)
ENRICHED_POSITIONS = (
    "vehicle_id string, line_code int, line_number string, line_direction int, latitude double, longitude double, is_accessible boolean, "
    "event_ts timestamp, ingestion_ts timestamp, route_short_name string, route_long_name string, route_type int, h3_index bigint, "
    "hour_of_day int, is_weekday boolean, _event_date string"
)
STOP_ARRIVALS = (
    "vehicle_id string, stop_id string, route_id string, line_code int, arrival_time timestamp, latitude double, longitude double, "
    "distance_to_stop_m double, _event_date string"
)
ROUTES = "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string"
STOPS = "stop_id string, stop_name string, stop_lat double, stop_lon double"
STOP_TIMES = "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int"
TRIPS = "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int, shape_id string"
SHAPES = "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int"
CENSUS = (
    "tract_code string, municipality_code string, municipality_name string, population int, households int, avg_income_brl double, "
    "area_km2 double, centroid_lat double, centroid_lon double"
)
GTFS = {"routes": ROUTES, "stops": STOPS, "stop_times": STOP_TIMES, "trips": TRIPS, "shapes": SHAPES}
