"""Sources: lake zones and the test adapter view."""

from blotter.sources.fixture import ADAPTER_SQL, adapter_raw, raw_incidents
from blotter.sources.zones import (
    read_curated,
    read_raw_csv,
    read_result,
    read_table,
    union_tables,
)

__all__ = ["ADAPTER_SQL", "adapter_raw", "raw_incidents", "read_curated", "read_raw_csv",
           "read_result", "read_table", "union_tables"]
