"""Comparing the sets of a bucket in the tasks, so that no row is written per pair.

A bucket whose sets are in several components is a *place*, or several if it is large:
it is cut into blocks, and each pair of blocks is a place of its own. In a place sets of different
components are compared, and what comes out are links that join two components: one less than these at
most, however many pairs there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach

# A bucket of more rows or elements than this is cut into blocks.
BLOCK_ROWS = 2_000
BLOCK_TOKENS = 2_000_000


def in_places(members: DataFrame, bucket: str, block_rows: int) -> DataFrame:
    """(place, bucket, side, fp, comp) from members (bucket, fp, n, comp) of the buckets with several components.

    ``side`` tells which of a place's two blocks a row is in, 0 or 1; 2 is the pair of a block with itself.
    """
    mixed = members.groupBy(bucket).agg(
        F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.count("*").alias("_rows"), F.sum("n").alias("_n")
    )
    blocks = F.ceil(F.greatest(F.col("_rows") / block_rows, F.col("_n") / BLOCK_TOKENS))
    mixed = mixed.where("_low < _high").select(bucket, "_rows", blocks.alias("_blocks"))
    inside = attach(members, mixed, [bucket], "_rows").withColumn(
        "_block", F.pmod(F.xxhash64("fp"), F.col("_blocks"))
    )
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    side = F.when(F.col("_block") == F.col("_other"), 2).when(F.col("_block") < F.col("_other"), 0).otherwise(1)
    # A member goes to all pairs of blocks that hold its own.
    return inside.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).select(
        F.xxhash64(bucket, low, high).alias("place"), bucket, side.cast("int").alias("side"), "fp", "comp"
    )


def by_place(of_place: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """Work on the rows of each place as one table, for rows sorted by place."""

    def rows(batches):
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            place = batch.column("place").to_numpy()
            if not len(place):
                continue
            begin = 0
            for end in np.append(np.flatnonzero(np.diff(place)) + 1, len(place)).tolist():
                if rest and rest[0].column("place")[0].as_py() != place[begin]:
                    yield from of_place(pa.Table.from_batches(rest))
                    rest = []
                rest.append(batch[begin:end])
                begin = end
        if rest:
            yield from of_place(pa.Table.from_batches(rest))

    return rows


def larger_components(side, n, comp, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a place with those of larger components that its size allows.

    Each component is held against all larger ones, so a place that is nearly one costs little.
    """
    parts, which, rows = np.unique(comp, return_inverse=True, return_counts=True)
    rank = np.empty(len(parts), np.int64)
    rank[np.argsort(rows, kind="stable")] = np.arange(len(parts))
    rank = rank[which]
    for at in np.flatnonzero(rank < len(parts) - 1):
        other = np.flatnonzero(
            (rank > rank[at])
            & ((side != side[at]) | (side == 2))
            & (100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at]))
        )
        if len(other):
            yield at, other


def _joined(found: np.ndarray, at: int, other: int) -> bool:
    """Join two components of a place; False if they were one already."""

    def root(x: int) -> int:
        while found[x] != x:
            found[x] = found[found[x]]
            x = found[x]
        return x

    a, b = root(at), root(other)
    found[max(a, b)] = min(a, b)
    return a != b


def links_of(table: pa.Table, candidates, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) by whole sets among candidates (a row, several others) that join components of a place.

    The table has fp, n, comp and ``tokens``, sorted as unsigned numbers.
    """
    fp, n = table.column("fp").to_numpy(), table.column("n").to_numpy()
    whole = [t.values.to_numpy().view(np.uint64) for t in table.column("tokens")]
    found = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1]
    joined = np.arange(found.max() + 1)
    left, right = [], []
    for at, other in candidates:
        mine = whole[at]
        for begin in range(0, len(other), 256):
            part = other[begin:begin + 256]
            tokens = np.concatenate([whole[o] for o in part])
            place = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
            starts = np.append(0, np.cumsum(n[part])[:-1])
            common = np.add.reduceat((mine[place] == tokens).astype(np.int64), starts)
            enough = 100 * common >= percent * (n[at] + n[part] - common)
            for o in part[enough].tolist():
                if _joined(joined, int(found[at]), int(found[o])):
                    left.append(min(fp[at], fp[o]))
                    right.append(max(fp[at], fp[o]))
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])
