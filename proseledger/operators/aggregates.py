"""Grouped and whole-table aggregates. Each is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.labels import bucketize
from ..functions.text import has_positive, word_count


def sentiment_summary(df: DataFrame, text: str = "text", longer_than: int = 50) -> DataFrame:
    """By positive flag, over texts longer than the limit: mean length, rows, mean words."""
    column = F.col(text)
    return (
        df.select(
            F.length(column).alias("review_length"),
            word_count(column).alias("word_count"),
            has_positive(column).alias("has_positive"),
        )
        .where(F.col("review_length") > longer_than)
        .groupBy("has_positive")
        .agg(
            F.avg("review_length").alias("avg_length"),
            F.count("*").alias("review_count"),
            F.avg("word_count").alias("avg_words"),
        )
        .orderBy("has_positive")
    )


def average_length(df: DataFrame, text: str = "text") -> DataFrame:
    """Mean text length over the texts that are not NULL."""
    return df.agg(F.avg(F.length(text)).alias("avg_length"))


def positive_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of texts with a positive word."""
    flag = has_positive(F.col(text))
    return df.agg(F.count_if(flag == 1).alias("positive_count"))


def length_summary(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of rows and mean, least and greatest text length."""
    length = F.length(text)
    return df.agg(
        F.count("*").alias("total_reviews"),
        F.avg(length).alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
    )


def table_summary(df: DataFrame, id: str, amount: str) -> DataFrame:
    """Number of rows, distinct ids, total and mean amount."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.countDistinct(id).alias("unique_ids"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("average_amount"),
    )


def category_counts(
    df: DataFrame, value: str, bounds: Sequence[float], labels: Sequence[str]
) -> DataFrame:
    """Rows per bucket of a numeric column."""
    label = bucketize(F.col(value), bounds, labels)
    return df.groupBy(label.alias("category")).agg(F.count("*").alias("count"))


def five_aggregates(df: DataFrame, text: str = "text", k: int = 10) -> DataFrame:
    """The five text aggregates from one scan, as rows (metric, key, value).

    Mean length, number of positive texts, the k commonest word counts and the k
    commonest lengths (ties by value), and rows per length category.

    The texts are read and matched once, down to one row per distinct (length,
    word count, flag); each of these then counts towards all five.
    """
    column = F.col(text)
    n, length = F.col("n"), F.col("review_length")
    cells = (
        df.select(
            F.length(column).alias("review_length"),
            word_count(column).alias("word_count"),
            has_positive(column).alias("has_positive"),
        )
        .groupBy("review_length", "word_count", "has_positive")
        .agg(F.count("*").alias("n"))
    )
    bounds, labels = fixed.LENGTH_3

    def towards(metric: str, number: Column | None = None, label: Column | None = None) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            (F.lit(None) if number is None else number).cast("long").alias("number"),
            (F.lit(None) if label is None else label).cast("string").alias("label"),
        )

    shares = F.array(
        towards("avg_length"),
        towards("positive_count"),
        towards("word_count", number=F.col("word_count")),
        towards("review_length", number=length),
        towards("length_category", label=bucketize(length, bounds, labels)),
    )
    counted = (
        cells.select(F.inline(shares), n, length, "has_positive")
        .groupBy("metric", "number", "label")
        .agg(
            F.sum(n).alias("n"),
            F.sum(n * F.col("has_positive")).alias("positive"),
            F.sum(n * length).alias("characters"),
            F.sum(F.when(length.isNotNull(), n)).alias("known"),
        )
    )
    commonest_first = Window.partitionBy("metric").orderBy(F.desc("n"), F.asc("number"))
    metric, place = F.col("metric"), F.row_number().over(commonest_first)
    # No metric but the two top lists has more rows than there are categories, NULL included.
    kept = counted.withColumn("place", place).where(F.col("place") <= max(k, len(labels) + 1))
    kept = kept.where((F.col("place") <= k) | ~metric.isin("word_count", "review_length"))
    value = (
        F.when(metric == "avg_length", F.try_divide("characters", "known"))
        .when(metric == "positive_count", F.col("positive").cast("double"))
        .otherwise(n.cast("double"))
    )
    return kept.select(
        "metric", F.coalesce("label", F.col("number").cast("string")).alias("key"), value.alias("value")
    )
