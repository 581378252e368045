"""Sources: CSV loaders for the reference-shaped tables and the GeoJSON street reader."""

from .readers import (InputPaths, load_parking_meters, load_parking_tickets, load_street_segments,
                      read_csv, read_csv_by_position, register_trips, rename_ticket_columns,
                      trips_projection)
from .geojson import first_line_points, read_features, read_street_points

__all__ = [
    "InputPaths", "load_parking_meters", "load_parking_tickets", "load_street_segments",
    "read_csv", "read_csv_by_position", "register_trips", "rename_ticket_columns",
    "trips_projection", "first_line_points", "read_features", "read_street_points",
]
