"""Plan shapes: what is read, what is shuffled, and that nothing runs in one task."""

import re

import pytest
from pyspark.sql import functions as F

from proseledger.operators import aggregates, windows
from proseledger.operators.shares import group_shares, share_of_total
from proseledger.plans.inspect import plan_text
from proseledger.plans.registry import QUERIES


@pytest.fixture(scope="module")
def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def plan(df):
    return plan_text(df, "simple")


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan(df))


ORDER = ["o_orderdate", "o_orderkey"]


def test_summary_reads_one_column_and_filters_before_matching(documents):
    text = plan(aggregates.sentiment_summary(documents))
    assert "ReadSchema: struct<text:string>" in text
    assert "PushedFilters: [IsNotNull(text)]" in text
    assert text.index("Project [length") < text.index("Filter (isnotnull")
    assert "partial_avg" in text
    # Read from the top: the sort, and below it the grouping.
    assert exchanges(aggregates.sentiment_summary(documents)) == ["rangepartitioning", "hashpartitioning"]


def test_five_aggregates_scan_once(documents):
    text = plan(aggregates.five_aggregates(documents))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<text:string>" in text


def test_windows_over_one_id_share_a_shuffle(orders):
    df = windows.running_sum(orders, ["o_custkey", "o_orderpriority"], ORDER, "o_totalprice")
    df = windows.moving_avg(df, ["o_custkey"], ORDER, "o_totalprice")
    df = windows.prev_next(df, ["o_custkey"], ORDER, "o_totalprice")
    assert exchanges(df) == ["hashpartitioning"]


def test_groups_known_to_be_small_are_not_counted(orders, monkeypatch):
    from proseledger.operators import skew

    monkeypatch.setattr(skew, "large_groups", None)
    df = windows.running_sum(orders, ["o_custkey"], ORDER, "o_totalprice", max_group_rows=None)
    assert exchanges(df) == ["hashpartitioning"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("share_of_total")] + ["window_report"])
def test_no_window_over_the_whole_table(spark, sf, name):
    text = plan(QUERIES[name].run(spark, sf))
    for window in re.findall(r"Window \[.*", text):
        assert re.search(r"\], \[\w", window), window


def test_shares_reuse_the_grouped_sums(orders):
    df = group_shares(orders, "o_orderpriority", "o_totalprice")
    df.collect()
    assert "ReusedExchange" in plan(df)
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan(df)


def test_shares_on_rows_do_not_shuffle_the_rows(orders):
    df = share_of_total(orders, "o_orderpriority", "o_totalprice")
    assert "BroadcastHashJoin" in plan(df) and "hashpartitioning" not in plan(df)


def test_top_k_does_not_sort_everything(documents):
    from proseledger.operators.frequency import top_values

    df = top_values(documents.withColumn("n", F.length("text")), "n")
    assert "TakeOrderedAndProject" in plan(df) and "rangepartitioning" not in plan(df)


def test_all_fields_in_one_scan(documents):
    from proseledger.functions.extract import extraction_stats
    from proseledger.operators.correlation import correlations
    from proseledger.operators.profile import basic_summary

    for df in (
        extraction_stats(documents),
        basic_summary(documents, ["doc_id", "n_chars"]),
        correlations(documents, ["doc_id", "n_chars"]),
    ):
        assert plan(df).count("FileScan") == 1


def test_no_python_in_the_plans_but_for_the_python_label(spark, sf):
    for name in ("text_features", "extract_features", "sentiment_category", "profile", "rank_in_group"):
        assert "Python" not in plan(QUERIES[name].run(spark, sf)), name
    assert "ArrowEvalPython" in plan(QUERIES["sentiment_category_udf"].run(spark, sf))


def test_joins_are_equijoins(spark, sf):
    for name, query in QUERIES.items():
        if name.startswith(("rank", "running", "moving", "lag", "share", "window", "reconcile", "quantile")):
            text = plan(query.run(spark, sf))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
