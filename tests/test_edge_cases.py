"""Constant columns, shares out of range, samples by key."""

from proseledger.operators.profile import mixed_stats
from proseledger.operators.shares import group_shares


def test_mixed_stats_constant_column(spark):
    df = spark.createDataFrame([(1, 5, 2), (2, 5, 4), (3, 5, 9)], "a int, b int, c int")
    for accuracy in (None, 1000):
        row = mixed_stats(df, "a", "b", "c", accuracy).first()
        assert row.corr_length_words is None and row.median_rating == 4.0 and row.mean_length == 2.0


def test_mixed_stats_approximate_is_one_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    plan = mixed_stats(df, "o_orderkey", "o_custkey", "o_totalprice", 1000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_share_out_of_range_is_null(spark):
    df = spark.createDataFrame([("a", 100), ("b", -99)], "g string, x int")
    assert {r.g: r.percent_of_total for r in group_shares(df, "g", "x").collect()} == {"a": None, "b": None}
