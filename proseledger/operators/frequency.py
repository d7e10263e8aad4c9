"""How often values occur.

Counting is ``groupBy().count()``, which combines before the shuffle, so one
value on a third of all rows is one row per task by the time it is sent. Where there are very many
different values, ``heavy_hitters`` finds the commonest without sending them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import store

# Values that a summary of frequent items follows.
TRACKED = 20_000
# Summaries of the tasks meet in so many groups before they meet in one.
MERGE_GROUPS = 64


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Every value of a column with its number of rows."""
    return df.groupBy(column).agg(F.count("*").alias("count"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k commonest values; among equally common ones the smaller come first."""
    return value_counts(df, column).orderBy(F.desc("count"), F.asc(column)).limit(k)


def heavy_hitters(df: DataFrame, column: str, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The rows of ``top_values``, with a shuffle that does not grow with the number of different values.

    First a summary of frequent items per task (``approx_top_k_accumulate``), combined in two
    steps. It names 2 * k + 100 candidates, and a value that it does not name occurs no oftener than
    the least of them, or 7 rows in ``tracked``. Then the candidates alone are counted. The
    result stands if the k-th of them occurs oftener than any other value can, or if
    the candidates are all values; else every value is counted as in ``top_values``.

    Two scans: store a column that is dear to compute. To the driver come the candidates.
    """
    if dict(df.dtypes)[column].startswith(("array", "map", "struct", "binary", "variant")):
        return top_values(df, column, k)
    value = df.select(F.col(column).alias("_value"))
    grouped = value.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))).groupBy("_group").agg(
        F.expr(f"approx_top_k_accumulate(_value, {tracked})").alias("_summary"), F.count("*").alias("_n")
    )
    # Grouped by a constant, as there is nothing to combine in an empty table.
    combined = grouped.withColumn("_all", F.lit(True)).groupBy("_all").agg(F.expr(f"approx_top_k_combine(_summary, {tracked})").alias("_summary"), F.sum("_n").alias("_n"))
    candidates = 2 * k + 100
    found = combined.select(F.expr(f"approx_top_k_estimate(_summary, {min(candidates, tracked)})").alias("items"), "_n").first()
    if found is None:
        return top_values(df, column, k)
    total = found["_n"]
    items = [item for item in found["items"] if item["item"] is not None]
    other = 7 * total / tracked
    if len(items) >= candidates:
        other = max(other, min(item["count"] for item in items))
    schema = f"_value {value.dtypes[0][1]}"
    # At most 2 * k + 100 values and NULL.
    named = F.broadcast(df.sparkSession.createDataFrame([(item["item"],) for item in items] + [(None,)], schema))
    named = named.withColumnRenamed("_value", "_named")
    counted = value.join(named, F.col("_value").eqNullSafe(F.col("_named")), "left_semi")
    counted = store(counted.groupBy("_value").agg(F.count("*").alias("count")), "candidates")
    counts = sorted((row["count"] for row in counted.select("count").collect()), reverse=True)
    if sum(counts) < total and (len(counts) < k or counts[k - 1] <= other):
        return top_values(df, column, k)
    named = counted.select(F.col("_value").alias(column), "count")
    return named.orderBy(F.desc("count"), F.asc(column)).limit(k)


def top_words(df: DataFrame, text: str = "text", k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The k commonest pieces of a split on single spaces, by ``heavy_hitters``."""
    words = df.select(F.explode(F.split(text, " ")).alias("word"))
    return heavy_hitters(words, "word", k, tracked)


def frequency_distribution(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k commonest values of a column with their share of all rows in percent."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("count")).scalar()
    shares = counts.withColumn("percent", F.try_divide(F.col("count") * 100, total))
    top = shares.orderBy(F.desc("count"), F.asc(column)).limit(k)
    return top.select(
        F.lit(column).alias("column"),
        F.col(column).cast("string").alias("value"),
        "count",
        "percent",
    )


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """The commonest value of a column, its rows and their share; the smaller value on a tie."""
    return frequency_distribution(df, column, 1).select(
        "column",
        F.col("value").alias("mode"),
        F.col("count").alias("mode_frequency"),
        "percent",
    )


def word_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    """Every piece of a split on single spaces with its number of occurrences."""
    words = df.select(F.explode(F.split(text, " ")).alias("word"))
    return value_counts(words, "word")
