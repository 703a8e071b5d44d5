from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators import (
    Dimension,
    Graph,
    Metric,
    aggregate_trips,
    enrich,
    trip_edges,
    with_calendar,
    zone_vertices,
)


def _with_role(role: str, name: str) -> Column:
    return F.concat(F.lit(f"{role}:"), F.col(name).cast("string"))


@dataclass(frozen=True)
class Mart:
    """Trips with the dimension of each end; every report starts here.

    ``trips`` carry a DATE and its ``month``. ``pickup`` and ``dropoff`` are
    usually one and the same dimension.
    """

    trips: DataFrame
    pickup: Dimension
    dropoff: Dimension
    shared: dict[str, DataFrame] | None = field(default=None, compare=False)

    @classmethod
    def of(
        cls,
        trips: DataFrame,
        pickup: DataFrame,
        dropoff: DataFrame | None = None,
        *,
        year: bool = False,
        share: bool = False,
    ) -> Mart:
        """Trips with ``date`` in unix seconds, or staged trips, which have a month.

        ``share`` takes the aggregates that reports have in common only once.
        """
        dated = trips if "month" in trips.columns else with_calendar(trips, year)
        if year and "year" not in dated.columns:
            dated = dated.withColumn("year", F.year("date"))
        start = Dimension.measure(pickup)
        end = start if dropoff is None else Dimension.measure(dropoff)
        return cls(dated, start, end, {} if share else None)

    @property
    def enriched(self) -> DataFrame:
        return enrich(self.trips, self.pickup, self.dropoff)

    def graph(self) -> Graph:
        """Zones as vertices. Two dimensions are one id space: ids carry their role then."""
        edges = trip_edges(self.trips)
        if self.dropoff is self.pickup:
            return Graph(Dimension(zone_vertices(self.pickup.rows), self.pickup.small), edges)
        roles = {"src": ("pickup", self.pickup), "dst": ("dropoff", self.dropoff)}
        vertices = [
            zone_vertices(zones.rows).withColumn("id", _with_role(role, "id"))
            for role, zones in roles.values()
        ]
        small = self.pickup.small and self.dropoff.small
        tagged = edges.select(*(_with_role(role, end).alias(end) for end, (role, _) in roles.items()))
        return Graph(Dimension(vertices[0].unionByName(vertices[1]), small), tagged)

    def family(self, name: str, full: Callable[[], DataFrame]) -> DataFrame | None:
        """The aggregate that several reports share, once, if this mart shares them.

        A shared aggregate is held in memory and on disk until ``release``.
        """
        if self.shared is None:
            return None
        if name not in self.shared:
            self.shared[name] = full().persist()
        return self.shared[name]

    def release(self) -> None:
        for rows in (self.shared or {}).values():
            rows.unpersist()
        if self.shared is not None:
            self.shared.clear()

    def report(
        self,
        by: dict[str, Column | str],
        trip_columns: list[str],
        *metrics: Metric,
        trips: DataFrame | None = None,
    ) -> DataFrame:
        keys = {n: F.col(e) if isinstance(e, str) else e for n, e in by.items()}
        return aggregate_trips(
            self.trips if trips is None else trips,
            self.pickup,
            self.dropoff,
            by=keys,
            trip_columns=trip_columns,
            metrics=list(metrics),
        )
