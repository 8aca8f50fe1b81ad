"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from .columns import (
    changed,
    falling_flag,
    full_name,
    on_day,
    result_code,
    seconds_of_day,
    within,
)

__all__ = [
    "changed",
    "falling_flag",
    "full_name",
    "on_day",
    "result_code",
    "seconds_of_day",
    "within",
]
