"""What a registered query is, and how its result is made comparable."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    """A query over the tables of a folder, and SQL with the same result (or None)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integers as bigint, fractions as rounded double, dates as text, for any other engine."""

    def same(name: str, kind: str):
        column = F.col(name)
        if kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind in ("double", "float"):
            column = F.round(column.cast("double"), digits)
        elif kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(name)

    return df.select([same(name, kind) for name, kind in df.dtypes])
