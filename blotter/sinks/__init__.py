"""Sinks: partitioned CURATED writes and skip-if-present ANALYTICS tables."""

from blotter.sinks.writers import write_curated, write_result, write_results

__all__ = ["write_curated", "write_result", "write_results"]
