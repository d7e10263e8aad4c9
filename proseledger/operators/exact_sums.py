"""Grouped sums and means of doubles with the same bits for any order and partitioning of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import LOWEST, PIECES, is_finite, pieces_from, rounded, top_bin


def binned(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sums of the pieces of a column: keys, ``_bin``, ``_sum``, ``_special``, ``_rows``, ``_known``.

    One scan; a task sends a row per group and magnitude of its values. The rows of
    several tables, or of parts of one, may be put together.
    """
    x = F.col(value).cast("double")
    usable = F.when(is_finite(x), x)
    rows = df.select(
        *keys, x.alias("_x"), usable.alias("_usable"),
        F.coalesce(top_bin(usable), F.lit(LOWEST + PIECES - 1)).alias("_top"),
    )
    names = [f"_p{i}" for i in range(PIECES)]
    sums = rows.groupBy(*keys, "_top").agg(
        *[F.sum(F.coalesce(p, F.lit(0))).alias(n) for n, p in zip(names, pieces_from(F.col("_usable"), F.col("_top")))],
        F.sum(F.when(F.col("_usable").isNull(), F.col("_x"))).alias("_special"),
        F.count("*").alias("_rows"),
        F.count("_x").alias("_known"),
    )

    def piece(i: int):
        # Rows are counted with the first piece only.
        first = [F.col(c) if i == 0 else F.lit(None).cast(t) for c, t in
                 (("_special", "double"), ("_rows", "long"), ("_known", "long"))]
        return F.struct(
            (F.col("_top") - i).alias("_bin"), F.col(names[i]).alias("_sum"),
            *[c.alias(n) for c, n in zip(first, ("_special", "_rows", "_known"))],
        )

    return sums.select(*keys, F.inline(F.array(*[piece(i) for i in range(PIECES)])))


def sums_of(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group of ``binned`` rows: ``sum`` (NULL without values), ``mean``, ``rows`` and ``known`` rows."""
    by_bin = pieces.groupBy(*keys, "_bin").agg(
        *[F.sum(c).alias(c) for c in ("_sum", "_special", "_rows", "_known")]
    )
    # A group has at most about a hundred bins.
    listed = F.sort_array(F.collect_list(F.struct(F.col("_bin").alias("bin"), F.col("_sum").alias("sum"))), asc=False)
    groups = by_bin.groupBy(*keys).agg(
        listed.alias("_pieces"), F.sum("_special").alias("_special"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_known"), F.lit(0)).alias("known"),
    )
    total = F.coalesce(F.col("_special") + 0.0, rounded(F.col("_pieces")))
    return groups.withColumn("sum", F.when(F.col("known") > 0, total)).select(
        *keys, "sum", F.try_divide("sum", "known").alias("mean"), "rows", "known"
    )


def exact_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group (or for the whole table, without keys): ``sum``, ``mean``, ``rows``, ``known``.

    The sum is exact before it is rounded to a double, so it has the same bits however the rows
    are ordered and spread; the mean is that sum by the rows that are not NULL.
    """
    return sums_of(binned(df, keys, value), keys)
