"""Sources and sinks: headed CSV (the reference's only format) and the
canonical views that bind the social questions to the driver's tables."""

from murmuration.sources.csv import (
    csv_table,
    read_access,
    read_centers,
    read_friends,
    read_people,
    read_points,
    write_csv,
)

__all__ = [
    "csv_table", "read_access", "read_centers", "read_friends", "read_people",
    "read_points", "write_csv",
]
