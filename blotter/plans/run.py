"""The batch jobs as a program, for ``spark-submit`` or ``python -m blotter.plans.run``.

    run.py clean     --lake URI --raw URI [--clean-mode overwrite|years]
    run.py aggregate --lake URI [--mode ignore|overwrite]
    run.py risk      --lake URI [--mode ignore|overwrite]
    run.py analytics --lake URI [--mode ignore|overwrite]
    run.py batch     --lake URI --raw URI

The lake holds ``curated`` and ``analytics``; the raw export is CSV with a
header. The written tables are printed, one ``name<TAB>path`` per line.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from blotter.plans.jobs import run_aggregates, run_analytics, run_batch, run_clean, run_risk
from blotter.profile import REFERENCE_PROFILE
from blotter.session import RECOMMENDED_CONF

JOBS = ("clean", "aggregate", "risk", "analytics", "batch")


def arguments(argv: Sequence[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="run.py", description="Incident lake jobs")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--lake", required=True, help="folder or URI that holds curated/ and analytics/")
    p.add_argument("--raw", help="raw CSV export (clean and batch)")
    p.add_argument("--mode", choices=("ignore", "overwrite"), default="ignore", help="result tables that are there: keep or replace")
    p.add_argument("--clean-mode", choices=("overwrite", "years"), default="overwrite", help="replace CURATED or only the years read")
    p.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="format of CURATED and of the results")
    p.add_argument("--max-year", type=int, default=REFERENCE_PROFILE.max_year, help="last year that is kept")
    args = p.parse_args(argv)
    if args.job in ("clean", "batch") and not args.raw:
        p.error(f"{args.job} needs --raw")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    """Run one job; returns table name -> path."""
    profile = REFERENCE_PROFILE.with_(max_year=args.max_year)
    lake = args.lake.rstrip("/")
    curated, results = f"{lake}/curated", f"{lake}/analytics"
    if args.job == "batch":
        return run_batch(spark, args.raw, lake, profile, mode=args.mode, fmt=args.format, clean_mode=args.clean_mode)
    if args.job == "clean":
        return {"curated": run_clean(spark, args.raw, curated, profile, mode=args.clean_mode, fmt=args.format)}
    job = {"aggregate": run_aggregates, "risk": run_risk, "analytics": run_analytics}[args.job]
    return job(spark, curated, results, profile, mode=args.mode, fmt=args.format, curated_fmt=args.format)


def main(argv: Sequence[str] | None = None) -> int:
    args = arguments(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"incident-lake-{args.job}").getOrCreate()
    for key, value in RECOMMENDED_CONF.items():  # what spark-submit set stays; static settings are the submitter's
        if spark.conf.isModifiable(key) and spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    for name, path in run(spark, args).items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
