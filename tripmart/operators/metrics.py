"""Counts, sums and means over trips grouped by trip and zone columns."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dimension import Dimension
from tripmart.operators.enrich import enrich

LIMB = 10**7
LOCATIONS = ("pickup_location", "dropoff_location")


class Metric(Protocol):
    """An aggregate that is taken in two steps."""

    name: str

    def partial(self) -> dict[str, Column]: ...

    def merged(self) -> Column: ...


@dataclass(frozen=True)
class Count:
    name: str
    where: Column | None = None

    def partial(self) -> dict[str, Column]:
        n = F.count("*") if self.where is None else F.count_if(self.where)
        return {f"{self.name}_n": n}

    def merged(self) -> Column:
        return F.sum(f"{self.name}_n")


@dataclass(frozen=True)
class Total:
    """``digits`` sums decimals of so many places (six at most) exactly, in any order of the rows.

    Each value is rounded to the places first; one that is no number is null. Rows are
    summed as whole numbers of the last place, in four limbs of seven digits, which
    stay longs for 10^11 rows a group; only the partial sums meet as wide decimals.
    """

    name: str
    column: str
    digits: int | None = None

    def partial(self) -> dict[str, Column]:
        if self.digits is None:
            return {f"{self.name}_s": F.sum(self.column)}
        low, high = _places(F.col(self.column), self.digits)
        limbs = [limb for half in (low, high) for limb in (half % LIMB, _whole(half, LIMB))]
        return {f"{self.name}_s{i}": F.sum(limb) for i, limb in enumerate(limbs)}

    def merged(self) -> Column:
        if self.digits is None:
            return F.sum(f"{self.name}_s")
        kind = f"decimal(38,{self.digits})"
        limbs = [
            F.sum(F.col(f"{self.name}_s{i}").cast("decimal(20,0)"))
            * F.lit(Decimal(LIMB**i).scaleb(-self.digits))
            for i in range(4)
        ]
        return reduce(add, (limb.cast(kind) for limb in limbs)).cast("double")


def _whole(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def _places(value: Column, digits: int) -> tuple[Column, Column]:
    """``value`` in units of the last of ``digits`` places: its last 14 digits, and those before.

    Rounded half up, as a cast to decimal does. Numbers below 10^14 units that are clearly
    nearer to one unit than to the next need no decimal; a double errs by 0.03 units there.
    """
    units = value.try_cast("double") * float(10**digits)
    nearest = F.rint(units)
    clear = (F.abs(units) < float(LIMB**2)) & (F.abs(units - nearest) < 0.45)
    exact = value.try_cast(f"decimal(28,{digits})") * F.lit(Decimal(10**digits))
    exact = exact.cast("decimal(28,0)")
    step = F.lit(Decimal(LIMB**2))
    low = F.when(clear, nearest.try_cast("long")).otherwise((exact % step).cast("long"))
    high = F.when(clear, F.lit(0).cast("long")).otherwise(F.call_function("div", exact, step))
    return low, high


@dataclass(frozen=True)
class Mean:
    name: str
    column: str

    def partial(self) -> dict[str, Column]:
        return {f"{self.name}_s": F.sum(self.column), f"{self.name}_n": F.count(self.column)}

    def merged(self) -> Column:
        return F.try_divide(F.sum(f"{self.name}_s"), F.sum(f"{self.name}_n"))


def aggregate_trips(
    trips: DataFrame,
    pickup: Dimension,
    dropoff: Dimension,
    *,
    by: dict[str, Column],
    trip_columns: list[str],
    metrics: list[Metric],
) -> DataFrame:
    """Group enriched trips by ``by`` (name to expression) and take the metrics.

    The trips are aggregated by location first: what meets the zones has one row
    per location pair and ``trip_columns`` (the trip columns that ``by`` reads),
    however many trips one location holds, and so does what is shuffled. A
    location that occurs twice in a dimension counts twice. The size of the
    dimensions only decides whether Spark is told to broadcast them.
    """
    keys = [expression.alias(name) for name, expression in by.items()]
    parts = [part.alias(name) for m in metrics for name, part in m.partial().items()]
    by_location = _grouped(trips, [F.col(c) for c in (*LOCATIONS, *trip_columns)], parts)
    enriched = enrich(by_location, pickup, dropoff)
    return _grouped(enriched, keys, [m.merged().alias(m.name) for m in metrics])


def count_trips(
    trips: DataFrame,
    pickup: Dimension,
    dropoff: Dimension,
    name: str,
    where: Column | None = None,
) -> DataFrame:
    """One row: the number of enriched trips that ``where``, over zone columns, picks.

    Counted by location pair before the zone joins.
    """
    pairs = enrich(trips.groupBy(*LOCATIONS).agg(F.count("*").alias("n")), pickup, dropoff)
    chosen = pairs if where is None else pairs.filter(where)
    return chosen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def _grouped(rows: DataFrame, keys: list[Column], values: list[Column]) -> DataFrame:
    """Distinct keys where there is nothing to aggregate."""
    return rows.groupBy(*keys).agg(*values) if values else rows.select(*keys).distinct()
