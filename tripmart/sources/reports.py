"""Result reports as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmart.schemas import REPORT_HEADINGS


def run_path(base: str, run_id: str, report: str) -> str:
    """Directory of one report of one run; the caller names the run."""
    if ":" in run_id or "/" in run_id:
        raise ValueError(f"a run id may hold neither ':' nor '/': {run_id!r}")
    return f"{base.rstrip('/')}/{run_id}/{report}"


def write_report(
    report: DataFrame,
    path: str,
    *,
    single_file: bool = False,
    headings: dict[str, str] = REPORT_HEADINGS,
) -> None:
    """Write a report, replacing an earlier one.

    Adaptive execution already folds a small result into one file and keeps a
    large one spread. ``single_file`` asks for exactly one file; it is for
    aggregates of a few rows, since one task then writes all of them.
    """
    named = report.withColumnsRenamed({c: h for c, h in headings.items() if c in report.columns})
    if single_file:
        named = named.coalesce(1)
    named.write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a report back under the column names of the results."""
    columns = {heading: c for c, heading in REPORT_HEADINGS.items()}
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.withColumnsRenamed({h: c for h, c in columns.items() if h in rows.columns})
