"""Size, schema and first rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(rows: DataFrame, name: str = "row_count") -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def schema_report(rows: DataFrame) -> DataFrame:
    """One row per column: position, name, type, values that are not null, and the row count.

    All counts come from one pass.
    """
    fields = rows.schema.fields
    counted = rows.agg(
        F.count("*").alias("row_count"),
        *(F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)),
    )
    columns = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, field in enumerate(fields)
        )
    )
    return counted.select(F.inline(columns), "row_count")


def preview(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows, in the given order if there is one."""
    return (rows.orderBy(*order) if order else rows).limit(n)
