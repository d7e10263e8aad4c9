"""Share of each group in the total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import store
from .exact_sums import binned, sums_of
from .skew import MAX_BROADCAST_ROWS, attach


def group_shares(df: DataFrame, group: str, amount: str, exact: bool = False) -> DataFrame:
    """One row per group: its sum, the total of all groups, its share in percent.

    With amounts of both signs a share may be out of the range of decimal(5,2): NULL then.
    With ``exact`` the sums don't depend on how the rows are spread (``exact_sums``).
    """
    return _shares(df, group, amount, exact).drop("_rows")


def with_percent(groups: DataFrame, total=None) -> DataFrame:
    """Add the total of all ``group_sum`` (or the one given) and each one's share of it in percent."""
    total = groups.agg(F.sum("group_sum")).scalar() if total is None else total
    percent = F.try_divide("group_sum", "total_sum") * 100
    return groups.withColumn("total_sum", total).withColumn(
        "percent_of_total", percent.try_cast("decimal(5,2)")
    )


def _shares(df: DataFrame, group: str, amount: str, exact: bool) -> DataFrame:
    if exact:
        # The total comes from the groups' pieces, not from their rounded sums.
        pieces = store(binned(df, [group], amount), "binned")
        groups = sums_of(pieces, [group]).select(group, F.col("sum").alias("group_sum"), F.col("rows").alias("_rows"))
        return with_percent(groups, sums_of(pieces, []).select("sum").scalar())
    groups = df.groupBy(group).agg(
        F.sum(amount).alias("group_sum"), F.count("*").alias("_rows")
    )
    return with_percent(groups)


def share_of_total(
    df: DataFrame, group: str, amount: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS, exact: bool = False
) -> DataFrame:
    """Every row with its group's sum, the total and the group's share in percent.

    A grouped sum joined back, not a window: the rows themselves are not shuffled
    as long as the groups are few enough to broadcast.
    """
    return attach(df, _shares(df, group, amount, exact), [group], "_rows", max_broadcast_rows)
