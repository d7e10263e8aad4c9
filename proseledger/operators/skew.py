"""Groups too large for one task.

A window gives every row of a group to one task. That is right for most groups
and hopeless for one that holds a third of the table. ``by_group_size`` counts
the rows per group first. Small groups take the ordinary window. The rows of
large groups are range-partitioned by (group, order) into chunks of about
``max_group_rows`` rows. Each chunk is a task and worked on by itself, and what a
chunk must know of those before it comes from a table with one row per (group,
chunk). A shuffle from chunk to chunk has an index entry for each pair of them,
and each task reports to the driver, so a low limit makes no more than
``MAX_CHUNKS`` chunks before these have ``MAX_GROUP_ROWS`` rows each.

As chunks are contiguous in (group, order), there are at most large groups +
chunks pairs of group and chunk. That table, and the one of the large groups,
is broadcast if both its rows and its bytes allow, else joined by a shuffle on
keys that no longer have many rows each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import shared_folder, store

# A group up to this size is left to one task: about 100 MB of narrow rows.
MAX_GROUP_ROWS = 1_000_000
# More chunks than this only where each would have more than MAX_GROUP_ROWS rows.
MAX_CHUNKS = 500
# A table of groups is broadcast up to this many rows and bytes.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20
# What a row of such a table may have besides the key: a few numbers.
VALUE_BYTES = 64
CHUNK = "_chunk"


def key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """About how many bytes the key of a row takes."""
    kinds = dict(df.dtypes)
    of_text = [k for k in keys if kinds[k].startswith(("string", "binary"))]
    fixed = F.lit(16 * len(keys))
    return reduce(add, [F.coalesce(F.octet_length(k), F.lit(0)) for k in of_text], fixed)


def most_rows(widest: int, max_rows: int | None = None) -> int:
    """How many rows with keys of at most so many bytes may be broadcast."""
    limit = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    return max(1, min(limit, MAX_BROADCAST_BYTES // (widest + VALUE_BYTES)))


class Large(NamedTuple):
    """The groups that are too large, how many they are and how many rows they hold."""

    # Keys and number of rows ("_rows").
    groups: DataFrame
    number: int
    rows: int
    chunks: int
    # Bytes of the widest key.
    widest: int
    # Whether no row is in any other group.
    all_rows: bool

    @property
    def parts(self) -> int:
        """No more pairs of (group, chunk) than this have rows."""
        return self.number + self.chunks

    def is_small(self, rows: int) -> bool:
        """Whether a table of so many rows, each with a group's key, may be broadcast."""
        return rows <= most_rows(self.widest)


def join_on_groups(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast: bool = False,
) -> DataFrame:
    """Join a table with one row per group to rows of the group. NULL keys match NULL keys."""
    other = {key: f"_{key}_of_group" for key in keys}
    table = table.withColumnsRenamed(other)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    joined = rows.join(F.broadcast(table) if broadcast else table, same, how)
    return joined.drop(*other.values())


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The number of rows ("_rows") per group."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows"))


def chunks_of(rows: int, max_group_rows: int) -> int:
    """Into how many chunks the rows of large groups are cut."""
    most = max(MAX_CHUNKS, ceil(rows / MAX_GROUP_ROWS))
    return max(2, min(ceil(rows / max_group_rows), most))


def large_groups(
    df: DataFrame, keys: Sequence[str], max_group_rows: int, sizes: DataFrame | None = None
) -> Large | None:
    """Groups with more rows than the limit; None if there are none.

    One pass over the table, or over its ``group_sizes`` if they are given. What is stored has a row per large group, and one for all others together.
    """
    sizes = group_sizes(df, keys) if sizes is None else sizes
    is_large = F.col("_rows") > max_group_rows
    own = [F.when(is_large, F.col(k)).alias(k) for k in keys]
    counted = sizes.groupBy(*own, is_large.alias("_large")).agg(F.sum("_rows").alias("_rows"))
    counted = store(counted, "group_sizes")
    groups = counted.where("_large").drop("_large")
    number, rows, widest, others = counted.agg(
        F.count_if("_large"),
        F.sum(F.when(F.col("_large"), F.col("_rows"))),
        F.max(F.when(F.col("_large"), key_bytes(groups, keys))),
        F.count_if(~F.col("_large")),
    ).first()
    if number == 0:
        return None
    return Large(groups, number, rows, chunks_of(rows, max_group_rows), widest, others == 0)


def split(df: DataFrame, keys: Sequence[str], found: Large) -> tuple[DataFrame, DataFrame]:
    """The rows of small groups, and those of large ones.

    Where there are too many large groups to be broadcast, only the heaviest
    are, which by their share of the rows can't be too many; the others are too
    light to skew the shuffle they are joined by.
    """
    groups = found.groups.drop("_rows")
    if found.is_small(found.number):
        return tuple(join_on_groups(df, groups, keys, how, True) for how in ("left_anti", "left_semi"))
    is_heavy = F.col("_rows") > found.rows // most_rows(found.widest)
    heavy, light = (found.groups.where(c).drop("_rows") for c in (is_heavy, ~is_heavy))
    others = join_on_groups(df, heavy, keys, "left_anti", broadcast=True)
    large = join_on_groups(df, heavy, keys, "left_semi", broadcast=True).unionByName(
        join_on_groups(others, light, keys, "left_semi")
    )
    return join_on_groups(others, light, keys, "left_anti"), large


def by_group_size(
    df: DataFrame,
    keys: Sequence[str],
    max_group_rows: int | None,
    small: Callable[[DataFrame], DataFrame],
    large: Callable[[DataFrame, Large], DataFrame],
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``small`` on the rows of small groups and ``large`` on the rows of large ones.

    The table is read once to count, unless its ``group_sizes`` are given, and once for either kind of group it has:
    store it first if it is dear to compute, or not the same each time. Where it
    has both kinds the result is stored, so that in a chain of operators none
    evaluates those before it again. The shared folder is demanded whatever the
    sizes, so that a job does not start to fail when its data grow.
    No limit (None) means that the caller knows all groups to be small: nothing
    is counted then.
    """
    if max_group_rows is None:
        return small(df)
    shared_folder(df.sparkSession)
    found = large_groups(df, keys, max_group_rows, sizes)
    if found is None:
        return small(df)
    if found.all_rows:
        return large(df, found)
    rest, heavy = split(df, keys, found)
    return store(small(rest).unionByName(large(heavy, found)), "by_group_size")


def in_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunks: int
) -> DataFrame:
    """Add the number of the (group, order) range each row falls in, a partition for each.

    Two evaluations may cut the ranges at different rows, so the result must go
    through ``store`` before it is used twice.
    """
    ranged = df.repartitionByRange(chunks, *[F.col(k) for k in keys], *order)
    numbered = ranged.withColumn(CHUNK, F.spark_partition_id())
    return numbered.repartitionById(chunks, F.col(CHUNK))


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    weight: str,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Add the columns of a one-row-per-group table, a few numbers, to every row of its group.

    ``weight`` is the column with the group's number of rows; it is not added.
    A table within the limits of rows and bytes is broadcast. Of a larger one only the heaviest
    groups are, which by their share of all rows can't be more than the limit;
    the others are too light to skew the shuffle they are joined by.
    """
    table = store(table, "groups")
    groups, total, widest = table.agg(
        F.count("*"), F.sum(weight), F.max(key_bytes(table, keys))
    ).first()
    limit = most_rows(widest or 0, max_broadcast_rows)
    if groups <= limit:
        return join_on_groups(rows, table.drop(weight), keys, broadcast=True)
    is_heavy = F.col(weight) > total // limit
    heavy = table.where(is_heavy).drop(weight)
    light = table.where(~is_heavy).drop(weight)
    others = join_on_groups(rows, heavy.select(*keys), keys, "left_anti", broadcast=True)
    return join_on_groups(rows, heavy, keys, broadcast=True).unionByName(
        join_on_groups(others, light, keys)
    )
