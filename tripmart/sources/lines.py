"""Delimited text to typed tables.

Two ways to cut a line:

``strict_split``  cut at every comma, quotes have no meaning (the default);
``csv``           quoted fields may hold commas.

Both keep only lines with exactly as many fields as the schema, drop every copy
of the header line and turn numbers that do not parse into nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import field_count, without_quotes
from tripmart.schemas import TRIP_SCHEMA, ZONE_SCHEMA

LINE = "value"
MODES = ("strict_split", "csv")


def keep_arity(lines: DataFrame, n: int, separator: str = ",") -> DataFrame:
    return lines.filter(field_count(LINE, separator) == n)


def drop_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Drop every line equal to the header.

    Without a given header the first line is taken for it, which costs a one-row
    job; give the text where it is known.
    """
    if header is None:
        first = lines.select(LINE).first()
        if first is None:
            return lines
        header = first[LINE]
    return lines.filter(F.col(LINE) != header)


def split_fields(lines: DataFrame, names: list[str], separator: str = ",") -> DataFrame:
    fields = F.split(F.col(LINE), separator, -1)
    return lines.select(*(F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)))


def parse_csv_fields(lines: DataFrame, names: list[str], separator: str = ",") -> DataFrame:
    """Quote-aware split; lines with another number of fields are dropped.

    Keeps the line as ``value`` next to the fields.
    """
    text = ", ".join(f"`{name}` STRING" for name in (*names, "_rejected"))
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_rejected",
        "sep": separator,
    }
    parsed = lines.select(LINE, F.from_csv(F.col(LINE), text, options).alias("f"))
    kept = parsed.filter(F.col("f._rejected").isNull())
    # the csv parser reads a blank as null; a blank stays an empty string here
    return kept.select(LINE, *(F.coalesce(F.col(f"f.{n}"), F.lit("")).alias(n) for n in names))


def strip_quotes(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    chosen = set(rows.columns if columns is None else columns)
    return rows.select(
        *(without_quotes(c).alias(c) if c in chosen else F.col(c) for c in rows.columns)
    )


def assign_schema(rows: DataFrame, schema: T.StructType, float32: bool = False) -> DataFrame:
    """Type string columns; text that does not parse becomes null.

    ``float32`` narrows the measures to 32 bits, which only serves to replay
    results that were computed that way.
    """

    def typed(field: T.StructField) -> Column:
        kind = field.dataType
        if isinstance(kind, T.StringType):
            return F.col(field.name)
        if float32 and isinstance(kind, T.DoubleType):
            kind = T.FloatType()
        return F.col(field.name).try_cast(kind).alias(field.name)

    return rows.select(*(typed(field) for field in schema.fields))


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    *,
    mode: str = "strict_split",
    header: str | None = None,
    quoted: bool = False,
    float32: bool = False,
) -> DataFrame:
    """Lines (one string column ``value``) to a typed table.

    Without ``header`` the first line that has the right number of fields in the
    given mode is taken for it. Of several files that finds only the header that
    the first one has; give the text where others differ.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    names = schema.fieldNames()
    if mode == "csv":
        rows = drop_header(parse_csv_fields(lines, names), header).drop(LINE)
    else:
        kept = drop_header(keep_arity(lines, len(names)), header)
        rows = split_fields(kept, names)
        if quoted:
            rows = strip_quotes(rows)
    return assign_schema(rows, schema, float32)


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    *,
    mode: str = "strict_split",
    header: str | None = None,
    float32: bool = False,
) -> DataFrame:
    return parse_lines(
        spark.read.text(path), TRIP_SCHEMA, mode=mode, header=header, float32=float32
    )


def read_zones(
    spark: SparkSession,
    path: str | list[str],
    *,
    mode: str = "strict_split",
    header: str | None = None,
) -> DataFrame:
    return parse_lines(spark.read.text(path), ZONE_SCHEMA, mode=mode, header=header, quoted=True)
