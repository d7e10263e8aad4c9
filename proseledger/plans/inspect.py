"""Looking at a DataFrame's schema and plan."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types."""
    return df.dtypes


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain`` prints: mode is simple, extended, codegen, cost or formatted."""
    printed = io.StringIO()
    with redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()


def write_plan(df: DataFrame, path: str, mode: str = "extended") -> None:
    """The plan as a text file, line by line."""
    lines = [(line,) for line in plan_text(df, mode).splitlines()]
    one_file = df.sparkSession.createDataFrame(lines, "value string").coalesce(1)
    one_file.write.mode("overwrite").text(path)
