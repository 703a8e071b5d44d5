"""A lookup side of a join together with what is known about its size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Dimension:
    """``small`` means counted and found within the broadcast bounds."""

    rows: DataFrame
    small: bool

    @classmethod
    def measure(
        cls,
        rows: DataFrame,
        *,
        max_rows: int = BROADCAST_ROWS,
        max_bytes: int = BROADCAST_BYTES,
    ) -> Dimension:
        """Count the rows, and the bytes of their text unless the rows are already too many."""
        return cls(rows, rows.count() <= max_rows and _text_bytes(rows) <= max_bytes)

    def side(self, rows: DataFrame) -> DataFrame:
        """Hint a projection of this dimension; a large one is left to Spark's own choice."""
        return F.broadcast(rows) if self.small else rows


def _text_bytes(rows: DataFrame) -> int:
    width = F.octet_length(F.concat_ws("", *(F.col(c).cast("string") for c in rows.columns)))
    return rows.agg(F.sum(width.cast("long"))).first()[0] or 0
