"""Readers of the text sources."""

from .files import (
    bad_lines,
    list_archive,
    number_lines,
    parse_lines,
    read_archive,
    read_messages,
    read_service_log,
    stream_messages,
)

__all__ = [
    "bad_lines",
    "list_archive",
    "number_lines",
    "parse_lines",
    "read_archive",
    "read_messages",
    "read_service_log",
    "stream_messages",
]
