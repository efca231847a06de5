"""Distributed ranking helpers against brute-force window functions on small tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from blotter.operators.ranking import running_total, top_k_counts_per_group, top_k_with_ties
from conftest import SF_SMALL


def _orders(spark):
    # Small, skewed integer counts with many ties: orders per (customer, priority).
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def test_top_k_with_ties_equals_rank(spark):
    df = _orders(spark)
    for k in (1, 3, 10, 50):
        got = {tuple(r) for r in top_k_with_ties(df, "n", k).collect()}
        ranked = df.withColumn("r", F.rank().over(Window.orderBy(F.col("n").desc())))
        want = {tuple(r) for r in ranked.filter(F.col("r") <= k).drop("r").collect()}
        assert got == want, k


def test_top_k_counts_per_group_equals_rank(spark):
    df = _orders(spark)
    for k in (1, 2, 5):
        got = {tuple(r) for r in top_k_counts_per_group(df, ["o_orderpriority"], "n", k).collect()}
        w = Window.partitionBy("o_orderpriority").orderBy(F.col("n").desc())
        want = {tuple(r) for r in df.withColumn("r", F.rank().over(w))
                .filter(F.col("r") <= k).drop("r").collect()}
        assert got == want, k


def test_running_total_equals_window_sum(spark):
    df = _orders(spark)
    order = [F.col("n").desc(), F.col("o_custkey").asc(), F.col("o_orderpriority").asc()]
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = {tuple(r) for r in df.withColumn("cum", F.sum("n").over(w))
            .withColumn("pos", F.row_number().over(Window.orderBy(*order))).collect()}
    for ranges in (7, None):  # explicit ranges, and ranges coalesced by AQE
        got = {tuple(r) for r in running_total(df, {"cum": "n", "pos": "1"}, order,
                                               num_ranges=ranges).collect()}
        assert got == want, ranges
