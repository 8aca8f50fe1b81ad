"""Structured Streaming driver for daily transaction files."""

from .daily_files import start_daily_file_stream

__all__ = ["start_daily_file_stream"]
