"""Queries for wide, large or growing tables: many columns, many values, two tables, files that are added."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.correlation import correlations
from ..operators.frequency import heavy_hitters, top_words
from ..operators.incremental import profile_files
from ..operators.reconcile import differences
from ..sources.shared import new_path
from .query import Query, comparable, table

MANY = 100


def _many_columns() -> dict[str, Column]:
    """A hundred columns of line items: four measures bent and shifted, each NULL on rows of its own."""
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    made = {}
    for i in range(MANY):
        value = F.col(measures[i % 4]) * (1 + i % 7) + F.pmod(F.col("l_orderkey") * (i + 3), F.lit(101 + i))
        made[f"c{i}"] = F.when(F.pmod(F.col("l_orderkey") + i, F.lit(5 + i % 11)) != 0, value)
    return made


def run_many_correlations(spark, folder):
    columns = _many_columns()
    df = table(spark, folder, "lineitem").select(*[c.alias(name) for name, c in columns.items()])
    return comparable(correlations(df, list(columns)).select("col1", "col2", "corr"), 6)


def _many_correlations_sql() -> str:
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    columns = ", ".join(
        f"CASE WHEN (l_orderkey + {i}) % {5 + i % 11} <> 0 "
        f"THEN {measures[i % 4]} * {1 + i % 7} + l_orderkey * {i + 3} % {101 + i} END AS c{i}"
        for i in range(MANY)
    )
    pairs = list(combinations_with_replacement(range(MANY), 2))
    first, second = (", ".join(f"'c{p[k]}'" for p in pairs) for k in (0, 1))
    corr = ", ".join(f"round(corr(c{a}, c{b}), 6)" for a, b in pairs)
    return f"""
        SELECT unnest([{first}]) AS col1, unnest([{second}]) AS col2, unnest([{corr}]) AS corr
        FROM (SELECT {columns} FROM lineitem)"""


def run_heavy_hitters(spark, folder):
    """The commonest order dates: thousands of different ones, most of them candidates for nothing."""
    df = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return heavy_hitters(df, "month", 10)


def run_heavy_hitters_uncertain(spark, folder):
    """Customers by orders: no one stands out, so every value is counted in the end."""
    df = table(spark, folder, "orders").select("o_custkey")
    return heavy_hitters(df, "o_custkey", 10, tracked=128)


def _changed_orders(spark, folder):
    """Orders with some rows gone, some changed, some twice and some with a NULL."""
    columns = ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"]
    df = table(spark, folder, "orders").select(*columns)
    key = F.col("o_orderkey")
    other = df.where(key % 97 != 0).withColumn(
        "o_orderpriority", F.when(key % 89 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    )
    return df, other.unionByName(df.where(key % 101 == 0))


def run_differences(spark, folder):
    return comparable(differences(*_changed_orders(spark, folder)), 4)


DIFFERENCES_SQL = """
    WITH a AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders),
    b AS (SELECT o_orderkey, o_custkey,
                 CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_totalprice
          FROM a WHERE o_orderkey % 97 <> 0
          UNION ALL SELECT * FROM a WHERE o_orderkey % 101 = 0)
    SELECT o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 4) AS o_totalprice,
           CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows
    FROM (SELECT *, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b)
    GROUP BY 1, 2, 3, 4 HAVING sum(l) <> sum(r)"""


def run_same(spark, folder):
    """How many rows differ between the line items and the same dealt anew: none."""
    df = table(spark, folder, "lineitem")
    return differences(df, df.repartition(7)).agg(F.count("*").alias("differing_rows"))


# The last is the same wherever it is known.
FILE_NUMBERS = ["o_totalprice", "o_custkey", "half"]


def run_profile_files(spark, folder):
    """The profile of orders in two folders, the second added after the first was profiled."""
    half = F.when(F.col("o_orderkey") % 2 == 0, 5.25)
    df = table(spark, folder, "orders").withColumn("half", half).select("o_orderkey", *FILE_NUMBERS)
    first, second, states = (new_path(spark, name) for name in ("files", "files", "states"))
    df.where("o_orderkey % 3 <> 0").repartition(3).write.parquet(first)
    df.where("o_orderkey % 3 = 0").write.parquet(second)
    profile_files(spark, [first], FILE_NUMBERS, states).collect()
    profiled = profile_files(spark, [first, second], FILE_NUMBERS, states)
    kept = ["column", "count", "mean", "stddev", "min", "max", "skewness", "kurtosis", "null_count", "range", "cv"]
    return comparable(profiled.select(*kept), 4)


def _profile_files_sql(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    spread = f"var_pop({v})"
    moment = f"(SELECT avg(power({column} - m, {{}})) FROM r, (SELECT avg({v}) AS m FROM r))"
    return f"""
        SELECT '{column}' AS "column", count({v}) AS "count", round(avg({v}), 4) AS mean,
               round(stddev_samp({v}), 4) AS stddev, round(min({v}), 4) AS "min", round(max({v}), 4) AS "max",
               CASE WHEN {spread} > 0 THEN round({moment.format(3)} / power({spread}, 1.5), 4) END AS skewness,
               CASE WHEN {spread} > 0 THEN round({moment.format(4)} / power({spread}, 2) - 3, 4) END AS kurtosis,
               count(*) - count({v}) AS null_count, round(max({v}) - min({v}), 4) AS "range",
               round(CASE WHEN avg({v}) = 0 THEN 0 ELSE stddev_samp({v}) / avg({v}) * 100 END, 4) AS cv
        FROM r"""


QUERIES = {
    "correlations_many_columns": Query(run_many_correlations, _many_correlations_sql()),
    "top_words": Query(
        lambda spark, folder: top_words(table(spark, folder, "documents"), "text", 20),
        """SELECT word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
           GROUP BY word ORDER BY "count" DESC, word LIMIT 20""",
    ),
    "heavy_hitters": Query(
        run_heavy_hitters,
        """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS "count" FROM orders
           GROUP BY 1 ORDER BY "count" DESC, month LIMIT 10""",
    ),
    "heavy_hitters_uncertain": Query(
        run_heavy_hitters_uncertain,
        'SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY 1 ORDER BY "count" DESC, o_custkey LIMIT 10',
    ),
    "table_differences": Query(run_differences, DIFFERENCES_SQL),
    "table_differences_none": Query(run_same, "SELECT CAST(0 AS BIGINT) AS differing_rows"),
    "profile_files": Query(
        run_profile_files,
        "WITH r AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 5.25 END AS half FROM orders) "
        + " UNION ALL ".join(_profile_files_sql(c) for c in FILE_NUMBERS),
    ),
}
