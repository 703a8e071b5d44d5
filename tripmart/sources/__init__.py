"""Readers, writers and table views."""

from tripmart.sources.lines import (
    assign_schema,
    drop_header,
    keep_arity,
    parse_lines,
    read_trips,
    read_zones,
    strip_quotes,
)
from tripmart.sources.reports import read_report, run_path, write_report
from tripmart.sources.staging import read_staged_trips, stage_trips

__all__ = [
    "assign_schema",
    "drop_header",
    "keep_arity",
    "parse_lines",
    "read_report",
    "read_staged_trips",
    "read_trips",
    "read_zones",
    "run_path",
    "stage_trips",
    "strip_quotes",
    "write_report",
]
