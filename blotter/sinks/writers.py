"""Writers for the CURATED and ANALYTICS zones.

``mode="ignore"`` is the reference's "compute only when the output is absent":
Spark checks the path before it runs the query, so nothing is computed or
written when the table is already there (even as an empty directory). Use
``overwrite`` after new data arrives, since ``ignore`` keeps stale results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame


def write_curated(df: DataFrame, path: str, *, partition_col: str = "year",
                  mode: str = "overwrite", rebalance: bool = True,
                  max_records_per_file: int | None = None, fmt: str = "parquet",
                  cluster_by: Sequence[str] = ()) -> None:
    """Write incidents partitioned by ``partition_col``.

    * ``mode="overwrite"`` replaces the whole zone, whatever the session's
      partition overwrite setting; ``mode="years"`` replaces only the partitions
      present in ``df`` and keeps the others. Other modes are Spark's own.
    * ``rebalance`` (default) shuffles once with ``REBALANCE(partition_col)``:
      adaptive execution coalesces small partitions and splits a year that holds
      most rows into files of about
      ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Without it every input
      split writes a file per year it holds, which at many splits means
      splits x years small files; use it only for a few splits.
    * ``cluster_by`` sorts each task's rows by the partition column and these
      columns before writing (local and spillable), so that Parquet statistics
      let later filters skip row groups.
    """
    writer_df = df.hint("rebalance", partition_col) if rebalance else df
    if cluster_by:
        writer_df = writer_df.sortWithinPartitions(partition_col, *cluster_by)
    w = writer_df.write.mode("overwrite" if mode == "years" else mode).partitionBy(partition_col)
    w = w.option("partitionOverwriteMode", "dynamic" if mode == "years" else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_result(df: DataFrame, base: str, name: str, *, mode: str = "ignore",
                 fmt: str = "parquet", partition_by: str | None = None) -> str:
    """Write one ANALYTICS table to ``{base}/{name}``; returns the path."""
    path = f"{base.rstrip('/')}/{name}"
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_results(results: Mapping[str, DataFrame], base: str, *, mode: str = "ignore",
                  fmt: str = "parquet", concurrency: int = 4) -> dict[str, str]:
    """Write independent result tables as concurrent Spark jobs; returns name -> path.

    Each table is its own job; submitting several at once lets the scheduler
    fill idle cores while small jobs wait on their last task. The first
    failure is raised after all submitted jobs end.
    """
    if concurrency <= 1 or len(results) <= 1:
        return {n: write_result(df, base, n, mode=mode, fmt=fmt) for n, df in results.items()}
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        futures = {n: pool.submit(write_result, df, base, n, mode=mode, fmt=fmt)
                   for n, df in results.items()}
        return {n: f.result() for n, f in futures.items()}
