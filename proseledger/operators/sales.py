"""The whole window report on a table whose columns play known roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.roles import Roles
from ..sources.shared import store
from . import windows
from .shares import with_percent
from .skew import MAX_GROUP_ROWS, attach


def with_date_parts(df: DataFrame, date: str) -> DataFrame:
    """Add the parsed date (NULL where it is none), its month and its year."""
    kind = dict(df.dtypes)[date]
    parsed = F.try_to_date(date) if kind == "string" else F.to_date(date)
    return df.withColumn(f"{date}_ts", parsed).withColumns(
        {"month": F.month(f"{date}_ts"), "year": F.year(f"{date}_ts")}
    )


def window_report(
    df: DataFrame, roles: Roles, tiebreak: str, max_group_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Every row with running sum, moving mean, ranks, neighbours and share of total.

    The rows per (id, group) are counted once, which gives the sizes of all groups and the sums
    that shares need. Then the rows are shuffled twice: by id, for the running sum, the moving mean and
    the neighbours, and by group for the ranks; large groups or not. ``tiebreak`` is a unique column.
    """
    order = [F.col(f"{roles.date}_ts"), F.col(tiebreak)]
    id_, group, amount = roles.id, roles.group, roles.amount
    df = with_date_parts(df, roles.date)
    pairs = df.groupBy(id_, group).agg(F.count("*").alias("_rows"), F.sum(amount).alias("_sum"))
    pairs = store(pairs, "pairs")
    by_id, by_group = (pairs.groupBy(k).agg(F.sum("_rows").alias("_rows")) for k in (id_, group))
    parts = [
        windows.moving_avg_and_neighbours_part([id_], order, amount),
        windows.running_sum_part([id_], order, amount, "cumulative_sum", within=[group]),
    ]
    df = windows.in_one_pass(df, [id_], order, parts, max_group_rows, by_id)
    df = windows.ranks(df, [group], amount, [tiebreak], max_group_rows, by_group)
    sums = pairs.groupBy(group).agg(F.sum("_sum").alias("group_sum"), F.sum("_rows").alias("_rows"))
    return attach(df, with_percent(sums), [group], "_rows")
