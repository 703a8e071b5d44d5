from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_count(line: str | Column, separator: str = ",") -> Column:
    """Number of separated fields in a line, trailing blanks included.

    Counts separators by byte length, so the arity test never builds the array
    that the projection after it has to build anyway.
    """
    line = _column(line)
    without = F.replace(line, F.lit(separator), F.lit(""))
    width = len(separator.encode("utf-8"))
    dropped = F.octet_length(line) - F.octet_length(without)
    return (dropped / F.lit(width)).cast("int") + 1


def without_quotes(c: str | Column) -> Column:
    return F.replace(_column(c), F.lit('"'), F.lit(""))


def epoch_date(c: str | Column) -> Column:
    """Unix seconds to DATE in the session time zone, with no text in between."""
    return F.to_date(F.timestamp_seconds(_column(c)))


def route_label(origin: str | Column, destination: str | Column, separator: str = " to ") -> Column:
    return F.concat_ws(separator, _column(origin), _column(destination))


def rank_order(measure: str, *ties: str) -> list[Column]:
    """Largest measure first, ties broken by key so that every cut is repeatable."""
    return [F.col(measure).desc(), *(F.col(t).asc() for t in ties)]
