"""Agreement of two computations of the same result.

``reconcile`` lines up rows by key and tells where values differ. ``differences`` compares whole tables as
multisets: checksums that don't depend on the order of rows say which ranges of a hash differ,
and only rows in those ranges are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import store

# Ranges of the first level, and of each differing range in the second.
RANGES = 4096
# More differing ranges than this are not split: most rows differ then.
MAX_SPLIT = 100_000


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Every key of either side, both sides' values, and whether they agree.

    ``keys`` must be unique on each side. Numbers agree within the tolerance,
    everything else when equal; NULL agrees with NULL. A key that one side lacks
    does not agree.
    """
    numeric = {"int", "bigint", "smallint", "tinyint", "float", "double"}
    types = dict(left.dtypes)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"_{name}_{k}") for k in keys],
            *[F.col(v).alias(f"{name}_{v}") for v in values],
            F.lit(True).alias(f"_in_{name}"),
        )

    def agrees(value: str) -> Column:
        a, b = F.col(f"left_{value}"), F.col(f"right_{value}")
        if types[value] in numeric or types[value].startswith("decimal"):
            close = F.abs(a - b) <= tolerance
            return a.eqNullSafe(b) | F.coalesce(close, F.lit(False))
        return a.eqNullSafe(b)

    on = [F.col(f"_left_{k}").eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = side(left, "left").join(
        side(right, "right"), reduce(lambda a, b: a & b, on), "full_outer"
    )
    both = F.col("_in_left").isNotNull() & F.col("_in_right").isNotNull()
    return joined.select(
        *[F.coalesce(f"_left_{k}", f"_right_{k}").alias(k) for k in keys],
        *[F.col(f"{s}_{v}") for v in values for s in ("left", "right")],
        reduce(lambda a, b: a & b, [agrees(v) for v in values], both).alias("matches"),
    )


def _marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with two hashes: one says the range, the other goes into the checksum.

    A hash passes over NULLs, so which columns are NULL is hashed too.
    """
    nulls = [F.isnull(c) for c in columns]
    return df.select(
        *columns,
        F.xxhash64(*columns, *nulls).alias("_range"),
        F.xxhash64(F.lit(1), *nulls, *columns).alias("_check"),
    )


def _ranges(level: int) -> list[Column]:
    numbers = [F.pmod(F.col("_range"), F.lit(RANGES)), F.pmod(F.shiftrightunsigned("_range", 32), F.lit(RANGES))]
    return numbers[:level]


def _differing(left: DataFrame, right: DataFrame, level: int) -> DataFrame:
    """The ranges whose checksums differ between the tables."""

    names = [f"_r{i}" for i in range(level)]

    def sums(df: DataFrame, sign: int) -> DataFrame:
        low, high = F.col("_check").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("_check", 32)
        return df.groupBy(*[c.alias(n) for c, n in zip(_ranges(level), names)]).agg(
            (sign * F.count("*")).alias("_n"), (sign * F.sum(low)).alias("_low"), (sign * F.sum(high)).alias("_high")
        )

    both = sums(left, 1).unionByName(sums(right, -1)).groupBy(*names).agg(
        *[F.sum(c).alias(c) for c in ("_n", "_low", "_high")]
    )
    return store(both.where("_n <> 0 or _low <> 0 or _high <> 0").select(*names), "differing")


def differences(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that one table has oftener than the other: the columns, ``left_rows`` and ``right_rows``.

    Both are taken as multisets of rows (of all columns, or those named), so neither needs a
    key, repeated rows count, and NULL equals NULL. Equal tables are told equal by one scan of each, with a
    shuffle of one row per task and range of hashes; else the differing ranges are split once
    more, and the rows in what still differs are counted. Two tables that differ are taken for
    equal only if 64-bit hashes agree in every range.

    The tables must have the same names and types (no maps); the order of columns doesn't matter.
    """
    if columns is None:
        if set(left.columns) != set(right.columns):
            raise ValueError("the tables have different columns")
        columns = left.columns
    if left.select(*columns).dtypes != right.select(*columns).dtypes:
        raise ValueError("the tables have columns of different types")
    left, right = _marked(left, columns), _marked(right, columns)
    found = _differing(left, right, 1)
    level = 1
    if found.isEmpty():
        left, right = left.limit(0), right.limit(0)
    else:
        # RANGES rows at most.
        inside = [_within(df, F.broadcast(found), 1) for df in (left, right)]
        finer = _differing(*inside, 2)
        if finer.count() <= MAX_SPLIT:
            found, level = finer, 2
        left, right = (_within(df, F.broadcast(found), level) for df in (left, right))
    counted = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sums = counted.groupBy(*columns).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    return sums.where("left_rows <> right_rows")


def _within(df: DataFrame, ranges: DataFrame, level: int) -> DataFrame:
    """The rows in some ranges."""
    same = reduce(lambda a, b: a & b, [c == ranges[f"_r{i}"] for i, c in enumerate(_ranges(level))])
    return df.join(ranges, same, "left_semi")
