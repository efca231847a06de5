"""Jobs that materialise the published tables, the dashboard's tables, plan inspection."""

from blotter.plans.jobs import run_aggregates, run_analytics, run_batch, run_clean, run_risk

__all__ = ["run_aggregates", "run_analytics", "run_batch", "run_clean", "run_risk"]
