"""Column mappings: operators work on any table that declares these names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripColumns:
    """Where the trip-level fields live."""

    ride_id: str = "ride_id"
    started_at: str = "started_at"
    ended_at: str = "ended_at"
    start_station: str = "start_station_id"
    end_station: str = "end_station_id"
    start_name: str = "start_station_name"
    end_name: str = "end_station_name"
    start_lat: str = "start_lat"
    start_lng: str = "start_lng"
    end_lat: str = "end_lat"
    end_lng: str = "end_lng"
    member: str = "member_casual"
    vehicle: str = "rideable_type"
    bike_id: str = "bike_id"
    reported_seconds: str = "reported_duration_seconds"
    duration: str = "duration_minutes"
    valid_demand: str = "valid_demand"
    valid_duration: str = "valid_duration"
    area: str = "area"
    file: str = "filename"


@dataclass(frozen=True)
class SeriesColumns:
    """Where an hourly series keeps its clock label, value and region."""

    timestamp: str = "timestamp"
    value: str = "rides"
    area: str = "area"


@dataclass(frozen=True)
class PredictionColumns:
    """Long-form prediction table: one row per (model, row)."""

    row: str = "source_row"
    fold: str = "fold"
    truth: str = "true_class"
    model: str = "model"
    score: str = "probability_p"
    label: str = "prediction"


TRIPS = TripColumns()
SERIES = SeriesColumns()
PREDICTIONS = PredictionColumns()

# The canonical trip schema, in source order.
CANONICAL_TRIP_COLUMNS = (
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id",
    "start_station_name", "end_station_id", "end_station_name", "start_lat",
    "start_lng", "end_lat", "end_lng", "member_casual", "bike_id",
    "reported_duration_seconds",
)
