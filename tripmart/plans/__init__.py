"""The named reports, each composed from the operators."""

from tripmart.plans.catalog import ROW_TABLES, Settings, catalog
from tripmart.plans.mart import Mart

__all__ = ["ROW_TABLES", "Mart", "Settings", "catalog"]
