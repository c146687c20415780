"""Sources (S1-S9): files, inline collections, sequences and the driver's
parquet tables, batch and streaming."""

from .files import (CAR_FIELDS, read_car_text, read_key_millis, read_lines,
                    read_user_behavior, USER_BEHAVIOR_SCHEMA)
from .inline import from_elements, sequence, timestamped_events
from .tables import TABLES, load, table_path

__all__ = [
    "CAR_FIELDS", "read_car_text", "read_key_millis", "read_lines", "read_user_behavior",
    "USER_BEHAVIOR_SCHEMA", "from_elements", "sequence", "timestamped_events", "TABLES",
    "load", "table_path",
]
