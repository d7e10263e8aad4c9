"""Which column of a table plays which part, found by name."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .synthetic import row_key, uniform


class Roles(NamedTuple):
    date: str
    amount: str
    id: str
    group: str


# The roles of a sales table, a review table and a table that is neither.
SALES = Roles("order_date", "amount", "customer_id", "region")
REVIEWS = Roles("review_date", "rating", "user_id", "helpful_votes")
DEFAULT = Roles("transaction_date", "amount", "customer_id", "region")

# Fixed value: what the name of a text column has in it.
TEXT_NAME = re.compile("review|text", re.IGNORECASE)


def find_text_column(df: DataFrame) -> str:
    """The first column named like a text column, or else the first string column."""
    named = [field.name for field in df.schema if TEXT_NAME.search(field.name)]
    strings = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    if not named and not strings:
        raise ValueError("the table has no text column")
    return (named + strings)[0]


def with_roles(df: DataFrame, key: str | None = None, seed: int = 0) -> tuple[DataFrame, Roles]:
    """The table and its roles: those of the first kind whose date column it has.

    A table of neither kind gets columns for the default roles: one date and one
    group for all rows, an id of its own for each, and an amount in [0, 1000).
    """
    for known in (SALES, REVIEWS):
        if known.date in df.columns:
            return df, known
    number = row_key(key)
    made_up = {
        DEFAULT.date: F.lit("2024-01-01"),
        DEFAULT.amount: uniform(number, seed) * 1000,
        DEFAULT.id: F.concat(F.lit("cust_"), number.cast("string")),
        DEFAULT.group: F.lit("Region_A"),
    }
    return df.withColumns(made_up), DEFAULT
