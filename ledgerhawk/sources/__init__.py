"""Sources and sinks: daily files, the landing area, warehouse tables."""

from .fixtures import fixture_landing, read_table
from .landing import (
    cast_rejects,
    conform,
    drop_blank,
    land,
    land_many,
    read_daily,
    read_landing,
    split_late,
)

__all__ = [n for n in dir() if not n.startswith("_")]
