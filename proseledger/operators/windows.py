"""Window operators that hold up when one group is most of the table.

``order`` is a list of sort columns and must end in a unique one, so that no
two rows of a group are equal and results don't depend on chance.

Windows over one key and order are *parts* of one pass. Where groups are small a
part is an ordinary window. Large groups are cut into chunks once for all parts:
each part says what it needs from inside a chunk, the rows are stored with all
of that, and then each part adds what its chunks carry to the chunks behind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import exact as exactly
from ..sources.shared import store
from .skew import (
    CHUNK,
    MAX_GROUP_ROWS,
    Large,
    by_group_size,
    in_chunks,
    join_on_groups,
)

BEFORE = Window.unboundedPreceding


def columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


class Part(NamedTuple):
    """Window columns over one key and order."""

    # On rows whose groups are whole.
    whole: Callable[[DataFrame], DataFrame]
    # What each row of a chunk needs from its chunk.
    inside: Callable[[], dict[str, Column]]
    # The results, from the stored rows of all chunks with what is inside; drops what it doesn't return.
    across: Callable[[DataFrame, Large], DataFrame]


def in_one_pass(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    parts: Sequence[Part],
    max_group_rows: int | None = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """All parts, which share keys and order, with one shuffle of the rows.

    ``sizes`` is a table of the rows per group (keys and ``_rows``) if there is one already.
    """

    def small(rows: DataFrame) -> DataFrame:
        for part in parts:
            rows = part.whole(rows)
        return rows

    def large(rows: DataFrame, found: Large) -> DataFrame:
        inside = {}
        for part in parts:
            inside |= part.inside()
        chunked = in_chunks(rows, keys, order, found.chunks).withColumns(inside)
        chunked = store(chunked, "chunks")
        for part in parts:
            chunked = part.across(chunked, found)
        return chunked.drop(CHUNK)

    return by_group_size(df, keys, max_group_rows, small, large, sizes)


def running_sum_part(
    keys: Sequence[str], order: Sequence[Column], value: str, name: str, within: Sequence[str] = (),
    bins: range | None = None,
) -> Part:
    """Sum of ``value`` from the first row of the group up to this one, by ``keys`` and ``within``.

    With ``bins`` the sum is exact before it is rounded, so it has the same bits however the rows are cut.
    """
    groups = [*keys, *within]
    helpers = [f"_here_{name}"] if bins is None else [f"_here_{name}_{i}" for i in range(len(bins) + 1)]

    def summands() -> list[Column]:
        return [F.col(value)] if bins is None else exactly.pieces_in(F.col(value), bins)

    def result(sums: list[Column]) -> Column:
        return sums[0] if bins is None else exactly.rounded_bins(sums, bins)

    def upto_here(*partition: str) -> list[Column]:
        window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(BEFORE, Window.currentRow)
        return [F.sum(s).over(window) for s in summands()]

    def whole(rows: DataFrame) -> DataFrame:
        if bins is None:
            return rows.withColumn(name, upto_here(*groups)[0])
        rows = rows.withColumns(dict(zip(helpers, upto_here(*groups))))
        return rows.withColumn(name, result([F.col(h) for h in helpers])).drop(*helpers)

    def inside() -> dict[str, Column]:
        return dict(zip(helpers, upto_here(CHUNK, *groups)))

    def across(chunked: DataFrame, found: Large) -> DataFrame:
        earlier = Window.partitionBy(*groups).orderBy(CHUNK).rowsBetween(BEFORE, -1)
        sums = [F.sum(s).alias(f"_of{h}") for s, h in zip(summands(), helpers)]
        carried = chunked.groupBy(*groups, CHUNK).agg(*sums).select(
            *groups, CHUNK, *[F.sum(f"_of{h}").over(earlier).alias(f"_before{h}") for h in helpers]
        )
        # Without further keys there is a row per chunk and large group; else they are counted.
        is_small = found.is_small(found.parts)
        if within:
            carried = store(carried, "carried")
            is_small = found.is_small(carried.count())
        joined = join_on_groups(chunked, carried, [*groups, CHUNK], broadcast=is_small)
        total = [F.coalesce(F.col(f"_before{h}") + F.col(h), f"_before{h}", h) for h in helpers]
        return joined.withColumn(name, result(total)).drop(*helpers, *[f"_before{h}" for h in helpers])

    return Part(whole, inside, across)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    name: str = "cumulative_sum",
    max_group_rows: int | None = MAX_GROUP_ROWS,
    exact: bool = False,
) -> DataFrame:
    """Sum of ``value`` from the first row of the group up to this one.

    Sums of doubles depend in their last digits on how the rows are cut into chunks. With
    ``exact`` they don't: the sum is exact before it is rounded, at the cost of
    one more scan of the column and a window for every 20 bits its values span.
    """
    order = columns(order)
    bins = exactly.bins_of(df, value) if exact else None
    part = running_sum_part(keys, order, value, name, bins=bins)
    return in_one_pass(df, keys, order, [part], max_group_rows)


def near_rows_part(
    keys: Sequence[str],
    order: Sequence[Column],
    inputs: Sequence[str],
    reach: int,
    outputs: Callable[[WindowSpec], dict[str, Column]],
) -> Part:
    """Window columns that look at most ``reach`` rows to either side.

    ``outputs`` builds the columns from an ordered window; they may read only
    ``inputs``. In a large group the rows within ``2 * reach`` of a chunk's ends
    are also kept in a table of their own. A row within ``reach`` of an end has
    all its neighbours next to it there, across chunks, so the same columns
    computed on that table are right for it; any other row has all of them in
    its chunk.
    """

    def whole(rows: DataFrame) -> DataFrame:
        return rows.withColumns(outputs(Window.partitionBy(*keys).orderBy(*order)))

    def inside() -> dict[str, Column]:
        whole = Window.partitionBy(CHUNK, *keys)
        window = whole.orderBy(*order)
        return {
            **outputs(window),
            "_place": F.row_number().over(window),
            "_size": F.count("*").over(whole),
        }

    def across(chunked: DataFrame, found: Large) -> DataFrame:
        def near_end(distance: int) -> Column:
            place = F.col("_place")
            return (place <= distance) | (F.col("_size") - place < distance)

        ends = chunked.where(near_end(2 * reach)).select(*keys, CHUNK, "_place", *inputs)
        across = outputs(Window.partitionBy(*keys).orderBy(CHUNK, "_place"))
        ends = ends.select(
            *keys, CHUNK, "_place", F.struct(*[c.alias(n) for n, c in across.items()]).alias("_at_end")
        )
        # Places of one chunk are different rows, so a shuffle by them is even.
        kinds = dict(chunked.dtypes)
        narrow = not any(kinds[i].startswith(("string", "binary", "array", "map", "struct")) for i in inputs)
        is_small = narrow and found.is_small(4 * reach * found.parts)
        joined = join_on_groups(chunked, ends, [*keys, CHUNK, "_place"], "left", is_small)
        chosen = {n: F.when(near_end(reach), F.col(f"_at_end.{n}")).otherwise(F.col(n)) for n in across}
        return joined.withColumns(chosen).drop("_place", "_size", "_at_end")

    return Part(whole, inside, across)


def near_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    inputs: Sequence[str],
    reach: int,
    outputs: Callable[[WindowSpec], dict[str, Column]],
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``near_rows_part`` by itself."""
    order = columns(order)
    return in_one_pass(df, keys, order, [near_rows_part(keys, order, inputs, reach, outputs)], max_group_rows)


def _mean_of_last(value: str, n: int, name: str) -> Callable[[WindowSpec], dict[str, Column]]:
    return lambda window: {
        name: F.avg(value).over(window.rowsBetween(1 - n, Window.currentRow))
    }


def _neighbours(value: str) -> Callable[[WindowSpec], dict[str, Column]]:
    return lambda window: {
        f"prev_{value}": F.lag(value, 1).over(window),
        f"next_{value}": F.lead(value, 1).over(window),
    }


def _with_change(df: DataFrame, value: str) -> DataFrame:
    before = F.col(f"prev_{value}")
    change = F.when(before.isNull(), 0.0).otherwise(F.col(value) - before)
    return df.withColumn(f"{value}_change", change)


def moving_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    n: int = 3,
    name: str | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean of ``value`` over this row and the n - 1 before it, fewer at the start."""
    outputs = _mean_of_last(value, n, name or f"moving_avg_{n}")
    return near_rows(df, keys, order, [value], n - 1, outputs, max_group_rows)


def prev_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value one row before, the value one row after, and the change from before.

    The change is 0 where there is no value before.
    """
    near = near_rows(df, keys, order, [value], 1, _neighbours(value), max_group_rows)
    return _with_change(near, value)


def moving_avg_and_neighbours_part(
    keys: Sequence[str], order: Sequence[Column], value: str, n: int = 3
) -> Part:
    """``moving_avg`` and ``prev_next`` over the same windows."""
    mean, neighbours = _mean_of_last(value, n, f"moving_avg_{n}"), _neighbours(value)

    def outputs(window: WindowSpec) -> dict[str, Column]:
        return {**mean(window), **neighbours(window)}

    part = near_rows_part(keys, order, [value], max(n - 1, 1), outputs)
    return part._replace(
        whole=lambda rows: _with_change(part.whole(rows), value),
        across=lambda chunked, found: _with_change(part.across(chunked, found), value),
    )


def moving_avg_and_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    n: int = 3,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``moving_avg`` and ``prev_next`` over the same windows, in one go."""
    order = columns(order)
    return in_one_pass(df, keys, order, [moving_avg_and_neighbours_part(keys, order, value, n)], max_group_rows)


def ranks_part(group: Sequence[str], value: str, tiebreak: Sequence[str]) -> Part:
    """Rank and dense rank within the group, highest value first, over rows in that order and ``tiebreak``'s."""
    highest = F.col(value).desc()

    def whole(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(highest)
        return rows.withColumns(
            {
                "rank_in_group": F.rank().over(window).cast("long"),
                "dense_rank_in_group": F.dense_rank().over(window).cast("long"),
            }
        )

    def inside() -> dict[str, Column]:
        by_value = Window.partitionBy(CHUNK, *group).orderBy(highest)
        return {
            "_place": F.row_number().over(Window.partitionBy(CHUNK, *group).orderBy(highest, *columns(tiebreak))),
            "_rank": F.rank().over(by_value),
            "_dense": F.dense_rank().over(by_value),
        }

    def across(chunked: DataFrame, found: Large) -> DataFrame:
        joined = join_on_groups(
            chunked, _rank_offsets(chunked, group, value), [*group, CHUNK],
            broadcast=found.is_small(found.parts),
        )
        goes_on = F.col("_continues") & (F.col("_dense") == 1)
        return joined.withColumns(
            {
                "rank_in_group": F.when(goes_on, F.col("_open_rank")).otherwise(
                    F.col("_rows_before") + F.col("_rank")
                ),
                "dense_rank_in_group": F.col("_values_before") + F.col("_dense"),
            }
        ).drop(
            "_place", "_rank", "_dense",
            "_continues", "_open_rank", "_rows_before", "_values_before",
        )

    return Part(whole, inside, across)


def ranks(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tiebreak: Sequence[str],
    max_group_rows: int | None = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Rank and dense rank within the group, highest value first, equal values alike.

    ``tiebreak`` only lets equal values of a large group spread over chunks; the
    ranks don't depend on it.
    """
    order = [F.col(value).desc(), *columns(tiebreak)]
    return in_one_pass(df, group, order, [ranks_part(group, value, tiebreak)], max_group_rows, sizes)


def _rank_offsets(chunked: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """One row per (group, chunk): what to add to the ranks counted inside the chunk.

    A chunk *continues* if its first value is the last one of the chunk before:
    then that value is counted once for both, and its rank is the one it has in
    the chunk where it first occurs.
    """
    summary = chunked.groupBy(*group, CHUNK).agg(
        F.count("*").alias("_rows"),
        F.max("_dense").alias("_values"),
        F.max("_rank").alias("_last_rank"),
        F.min_by(value, "_place").alias("_first"),
        F.max_by(value, "_place").alias("_last"),
    )
    by_chunk = Window.partitionBy(*group).orderBy(CHUNK)
    upto = by_chunk.rowsBetween(BEFORE, Window.currentRow)
    earlier = by_chunk.rowsBetween(BEFORE, -1)
    continues = F.lag(CHUNK).over(by_chunk).isNotNull() & F.col("_first").eqNullSafe(
        F.lag("_last").over(by_chunk)
    )
    summary = summary.withColumns(
        {
            "_continues": continues,
            "_rows_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        }
    )
    counted_twice = F.sum(F.col("_continues").cast("long")).over(upto)
    values = F.coalesce(F.sum("_values").over(earlier), F.lit(0)) - counted_twice
    # The rank of a chunk's last value; unknown here if that value came in from before.
    came_in = F.col("_continues") & (F.col("_values") == 1)
    own_last_rank = F.when(~came_in, F.col("_rows_before") + F.col("_last_rank"))
    open_rank = F.last(own_last_rank, ignorenulls=True).over(earlier)
    return summary.select(
        *group, CHUNK, "_continues", "_rows_before",
        values.alias("_values_before"), open_rank.alias("_open_rank"),
    )
