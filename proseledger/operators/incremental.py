"""Profiles of growing tables: what each file adds is kept, so that only new files are read.

The state of a file is one row per column: the rows, the moments, the extremes and a
summary of the ranks. States of any files combine to the profile of all of them.
A file is known by its path, size and time of change, so a file that was written
anew counts as a new one, and states of files that are gone are passed over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quantiles import QUANTILES

# A rank of the combined summaries is right within about 0.4 % (of all rows).
SUMMARY_SIZE = 1024
FILE = ["_path", "_size", "_changed"]


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_path": F.col("_metadata.file_path"),
            "_size": F.col("_metadata.file_size"),
            "_changed": F.col("_metadata.file_modification_time"),
        }
    )


def file_states(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file and column of a table read from files: what the file adds to a profile."""
    values = _with_file(df).select(*FILE, *[F.col(c).cast("double").alias(c) for c in columns])
    number = F.col("value")
    rows = values.unpivot(FILE, list(columns), "column", "value").groupBy(*FILE, "column").agg(
        F.count("*").alias("rows"),
        F.count(number).alias("n"),
        F.avg(number).alias("mean"),
        F.var_pop(number).alias("variance"),
        F.skewness(number).alias("skewness"),
        F.kurtosis(number).alias("kurtosis"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
        F.kll_sketch_agg_double(number, F.lit(SUMMARY_SIZE)).alias("ranks"),
    )
    # Sums of powers of the deviations from the file's mean.
    n, variance = F.col("n"), F.col("variance")
    return rows.select(
        *FILE, "column", "rows", "n", "mean",
        (n * variance).alias("m2"),
        F.when(variance > 0, F.col("skewness") * n * F.pow(variance, 1.5)).otherwise(F.when(n > 0, 0.0)).alias("m3"),
        F.when(variance > 0, (F.col("kurtosis") + 3) * n * variance * variance).otherwise(F.when(n > 0, 0.0)).alias("m4"),
        "least", "most", F.when(n > 0, F.col("ranks")).alias("ranks"),
    )


def combined(states: DataFrame) -> DataFrame:
    """The profile of all files whose states these are: the columns of ``profile``.

    Moments and extremes are those of the rows; quantiles are right in rank within
    about 0.4 %. Means are taken from the mean of all, which loses no digits to large values.
    """
    some = F.col("n") > 0
    of_column = Window.partitionBy("column")
    # One row per file and column.
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(of_column), F.sum("n").over(of_column))
    d, n = F.col("_d"), F.col("n")
    apart = states.withColumn("_mean", mean).withColumn("_d", F.when(some, F.col("mean") - F.col("_mean")))
    at = F.array(*[F.lit(f) for f in QUANTILES.values()])
    sums = apart.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("count"),
        F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("m4"),
        F.min("least").alias("min"),
        F.max("most").alias("max"),
        F.kll_merge_agg_double("ranks", F.lit(SUMMARY_SIZE)).alias("ranks"),
    )
    count = F.col("count")
    ranks = F.when(count > 0, F.kll_sketch_get_quantile_double("ranks", at))
    wide = sums.withColumn("_at", ranks).select(
        "column", "rows", "count", "mean", "min", "max",
        F.when(count > 1, F.sqrt(F.try_divide("m2", count - 1))).alias("stddev"),
        (F.sqrt(count) * F.try_divide("m3", F.pow("m2", 1.5))).alias("skewness"),
        (count * F.try_divide("m4", F.col("m2") * F.col("m2")) - 3).alias("kurtosis"),
        *[F.col("_at")[i].alias(name) for i, name in enumerate(QUANTILES)],
    )
    variation = F.when(F.col("mean") == 0, 0.0).otherwise(F.try_divide("stddev", "mean") * 100)
    return wide.select(
        "column", "count", "mean", "stddev", "min", "max", "skewness", "kurtosis", *QUANTILES,
        (F.col("rows") - count).alias("null_count"), count.alias("non_null_count"),
        (F.col("max") - F.col("min")).alias("range"), (F.col("q3") - F.col("q1")).alias("iqr"),
        variation.alias("cv"),
    )


def profile_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], state_path: str) -> DataFrame:
    """The profile of all rows of Parquet files, of which only those not seen before are read.

    ``state_path`` is a folder that keeps the states from run to run, one row per file and
    column; a run adds those of its new files. The states of files already there must hold the
    same columns. Two runs at a time may both read a new file; its states are used once.
    """
    files = _with_file(spark.read.parquet(*paths)).select(*FILE).distinct()
    known = None
    try:
        known = spark.read.parquet(state_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    new = files if known is None else files.join(known.select(*FILE).distinct(), FILE, "left_anti")
    # Names of files, to be read by the next job.
    fresh = [row["_path"] for row in new.select("_path").collect()]
    if fresh:
        states = file_states(spark.read.parquet(*fresh), columns)
        states.write.mode("append").parquet(state_path)
    states = spark.read.parquet(state_path).where(F.col("column").isin(list(columns)))
    return combined(states.join(files, FILE, "left_semi").dropDuplicates([*FILE, "column"]))
