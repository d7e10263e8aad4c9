"""Made-up review columns for tables that lack them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(key: str | None) -> Column:
    """The given key column, or else an id per row: unique, but not consecutive and not
    the same when the table is partitioned differently."""
    return F.col(key) if key else F.monotonically_increasing_id()


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that looks random and depends on key and seed alone.

    ``rand`` depends on where a row lies in its partition, so a task that is run
    again after a lost executor can draw other numbers. This can't.
    """
    steps = 1 << 53
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(steps)) / F.lit(float(steps))


def with_synthetic_columns(df: DataFrame, key: str | None = None, seed: int = 0) -> DataFrame:
    """Add review_id, review_date, user_id, rating in [6, 10) and helpful_votes in 0..49."""
    number = F.col("review_id")
    return df.withColumn("review_id", row_key(key)).withColumns(
        {
            "review_date": F.date_add(
                F.lit("2024-01-01").cast("date"), F.pmod(number, F.lit(365)).cast("int")
            ),
            "user_id": F.concat(
                F.lit("user_"), (F.pmod(number, F.lit(100)) + 1).cast("string")
            ),
            "rating": uniform(number, seed) * 4 + 6,
            "helpful_votes": (uniform(number, seed + 1) * 50).cast("int"),
        }
    )
