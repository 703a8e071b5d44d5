"""Column expressions, all JVM-side."""

from tripmart.functions.columns import (
    epoch_date,
    field_count,
    rank_order,
    route_label,
    without_quotes,
)

__all__ = ["epoch_date", "field_count", "rank_order", "route_label", "without_quotes"]
