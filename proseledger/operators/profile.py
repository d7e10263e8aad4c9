"""Statistical profile of numeric columns, one row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import reused, store
from .correlation import pearson
from .quantiles import QUANTILES, at_fractions, long_form, quantiles, select_ranks
from .skew import MAX_GROUP_ROWS

MOMENTS = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev,
    "min": F.min,
    "max": F.max,
}
SHAPE = {"skewness": F.skewness, "kurtosis": F.kurtosis}


def _moments(df: DataFrame, columns: Sequence[str], statistics: dict) -> DataFrame:
    """One row per column. The columns are turned into rows first and grouped: one
    aggregate per column and statistic side by side soon has more fields than
    Spark compiles, and is then interpreted."""
    number = F.col("value")
    return (
        long_form(df, columns)
        .groupBy("column")
        .agg(
            F.count("*").alias("rows"),
            *[f(number).alias(name) for name, f in statistics.items()],
        )
    )


def basic_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, least and greatest value per column."""
    return _moments(df, columns, MOMENTS).drop("rows")


def profile(
    df: DataFrame,
    columns: Sequence[str],
    accuracy: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    persist: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    selected: DataFrame | None = None,
) -> DataFrame:
    """The full profile per column (no rows for a table without rows).

    ``basic_summary`` plus skewness and excess kurtosis (population), NULL and
    non-NULL rows, quantiles, range, interquartile range and coefficient of
    variation in percent (0 for a mean of 0).

    Moments take one scan of the columns, quantiles two. ``persist`` is how the columns
    are kept in between; None suits a table that holds them ready to be read.
    Where rows of ``select_ranks`` at the fractions are at hand they can be given as ``selected``.

    Values are taken as doubles, so integers above 2^53 lose their last digits;
    ``typed_order_statistics`` keeps them.
    """
    with reused(df.select(*columns), persist) as numbers:
        # Both tables have one row per profiled column.
        moments = store(_moments(numbers, columns, {**MOMENTS, **SHAPE}), "moments")
        if selected is not None:
            at = at_fractions(selected, QUANTILES)
        elif accuracy is not None:
            at = store(quantiles(numbers, columns, QUANTILES, accuracy), "quantiles")
        else:
            # What was counted inside the brackets is stored; the scans are over.
            at = at_fractions(select_ranks(numbers, columns, list(QUANTILES.values()), None, max_group_rows), QUANTILES)
    both = moments.join(F.broadcast(at), "column", "left")
    variation = F.when(F.col("mean") == 0, 0.0).otherwise(F.try_divide("stddev", "mean") * 100)
    return both.select(
        "column",
        *MOMENTS,
        *SHAPE,
        *QUANTILES,
        (F.col("rows") - F.col("count")).alias("null_count"),
        F.col("count").alias("non_null_count"),
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("q3") - F.col("q1")).alias("iqr"),
        variation.alias("cv"),
    )


def profile_highlights(profiled: DataFrame, correlated: DataFrame, modes: DataFrame) -> DataFrame:
    """Greatest maximum, greatest variation, strongest correlation and commonest category.

    Rows (finding, subject, value); the inputs are results of ``profile``,
    ``correlations`` and ``mode_of``. A column's correlation with itself does not count.
    """
    pair = F.concat_ws(" / ", "col1", "col2")
    strength = F.abs(F.col("corr"))

    def best(table: DataFrame, finding: str, subject, value) -> DataFrame:
        value = value.cast("double")
        return table.agg(
            F.lit(finding).alias("finding"),
            F.max_by(subject, F.struct(value, subject)).alias("subject"),
            F.max(value).alias("value"),
        )

    name = F.col("column")
    category = F.concat_ws(" / ", "column", "mode")
    others = correlated.where((F.col("col1") != F.col("col2")) & F.col("corr").isNotNull())
    return (
        best(profiled.where(F.col("max").isNotNull()), "largest_feature", name, F.col("max"))
        .unionByName(
            best(profiled.where(F.col("cv").isNotNull()), "most_variable_feature", name, F.col("cv"))
        )
        .unionByName(best(others, "strongest_correlation", pair, strength))
        .unionByName(best(modes, "most_common_category", category, F.col("mode_frequency")))
    )


def mixed_stats(
    df: DataFrame, length: str, words: str, rating: str, accuracy: int | None = None
) -> DataFrame:
    """Mean, deviation and skewness of one column, mean of another, their correlation,
    and the median of a third (NULL for the correlation with a constant column).

    With ``accuracy`` all of it is one aggregate of one scan; the exact median
    needs the distinct values counted first.
    """
    approximate = accuracy is not None
    middle = F.percentile_approx(rating, 0.5, accuracy) if approximate else F.lit(None)
    stats = df.agg(
        F.avg(length).alias("mean_length"),
        F.stddev(length).alias("std_length"),
        F.skewness(length).alias("skew_length"),
        F.avg(words).alias("mean_words"),
        pearson(F.col(length), F.col(words)).alias("corr_length_words"),
        middle.cast("double").alias("median_rating"),
    )
    if approximate:
        return stats
    median = quantiles(df, [rating], {"median": 0.5}).select("median").scalar()
    return stats.withColumn("median_rating", median)
