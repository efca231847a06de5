"""Write PLANS.md: the executed physical plans of the core operators, with notes.

    python tests/plans_report.py [/root/testdata/sf0.01]

Plans are printed after execution (``explain()`` then shows the adaptive final
plan, with reused exchanges and subqueries) over a curated zone written to a
scratch folder from the adapter view.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blotter.operators.aggregate import avg_count_per_bucket, monthly_density  # noqa: E402
from blotter.operators.clean import clean_incidents, curated_view  # noqa: E402
from blotter.operators.cube import daily_cube  # noqa: E402
from blotter.operators.risk import context_risk_scores  # noqa: E402
from blotter.operators.shared import shared_counts  # noqa: E402
from blotter.plans.inspect import plan_text  # noqa: E402
from blotter.plans.jobs import run_clean  # noqa: E402
from blotter.profile import ADAPTER_PROFILE as P  # noqa: E402
from blotter.session import local_session  # noqa: E402
from blotter.sources.fixture import raw_incidents  # noqa: E402
from blotter.sources.zones import read_curated  # noqa: E402

NOTES = {
    "clean_for_write": "The clean job's plan before the file writer: parsing and filter, one "
                       "rebalancing exchange by year (which adaptive execution splits and "
                       "coalesces to the advisory size), and a per-task sort by (year, area, "
                       "date). The date is parsed in the filter and again in the output.",
    "daily_cube": "One scan reading 4 columns (+ the `year` partition column); partial "
                  "count before the only exchange, so a hot area is combined map-side.",
    "shared_counts": "Cube and context counts from one scan: `Expand` emits each row once per "
                     "grouping set, a partial aggregate combines them before one exchange.",
    "context_risk_scores": "Final adaptive plan: the statistics are one scalar subquery "
                           "(`ReusedSubquery` for its other uses) whose input is a "
                           "`ReusedExchange` of the context-count shuffle: one scan, no join.",
    "avg_by_area_week": "Two exchanges: (area, year, week) after a partial count, then area "
                        "over the small bucket table.",
    "heatmap_1996": "A year filter becomes a `PartitionFilters` entry: only `year=1996` is "
                    "listed and read.",
}


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    scratch = tempfile.mkdtemp(prefix="blotter-plans-")
    run_clean(spark, raw_incidents(spark, sf_dir), f"{scratch}/curated", P)
    cur = curated_view(read_curated(spark, f"{scratch}/curated"), P)
    frames = {
        "clean_for_write": clean_incidents(raw_incidents(spark, sf_dir), P).hint("rebalance", "year")
        .sortWithinPartitions("year", P.entity, P.date_out),
        "daily_cube": daily_cube(cur, P),
        "shared_counts": shared_counts(cur, P),
        "context_risk_scores": context_risk_scores(cur, P),
        "avg_by_area_week": avg_count_per_bucket(cur, P.entity, P.date_out, "week"),
        "heatmap_1996": monthly_density(cur.filter(F.col("year") == 1996), P.date_out, P.entity,
                                        P.lat, P.lon),
    }
    out = ["# PLANS", "",
           f"Executed physical plans over the curated zone built from `{sf_dir}` "
           "(`tests/plans_report.py` regenerates this file).", ""]
    for name, df in frames.items():
        df.collect()
        text = plan_text(df, "simple")
        if "== Initial Plan ==" in text:
            text = text.split("+- == Initial Plan ==")[0]
        out += [f"## {name}", "", NOTES[name], "", "```", text.rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
