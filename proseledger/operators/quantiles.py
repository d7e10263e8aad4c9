"""Quantiles and histograms over quantile buckets, by selection between brackets.

The exact way takes two scans. The first summarises every column: each task's
summaries meet in a few dozen groups of tasks, and what these make of them
in one last step, so no task sees the summaries of all. From a summary follows for
each fraction a bracket that holds its value for certain. The second scan counts
the rows below, between and inside the brackets, and by value only those inside. So what is
shuffled is bounded by the brackets (under one percent of the rows for each
fraction) and not by the number of distinct values. Ranks decide at the end whether
each bracket held its value; where one did not, the gap that does is scanned.

The approximate way stops after the first scan.

Values are compared as doubles to find their bracket, which keeps their order,
but counted and returned in a type of their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store
from .skew import MAX_GROUP_ROWS
from .windows import running_sum

QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
# Brackets come from a summary whose ranks are right within 1 / BRACKET_ACCURACY.
BRACKET_ACCURACY = 400
# Summaries of the tasks meet in so many groups before they meet in one.
MERGE_GROUPS = 64


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, value), values as double."""
    values = df.select([F.col(c).cast("double").alias(c) for c in columns])
    return values.unpivot([], list(columns), "column", "value")


def _image(value: Column) -> Column:
    """A value as a double that any two values compare alike by (NaN is the greatest)."""
    return F.nanvl(value.cast("double"), F.lit(float("inf")))


def summaries(df: DataFrame, columns: Sequence[str], accuracy: int) -> DataFrame:
    """Points of each column: ``value``, about how many rows there are ``upto`` it, and ``total``.

    ``upto`` is at most total / (4 * accuracy) too high and 3 * total / (4 * accuracy) too low. The first
    point is the least value, the last the greatest.
    """
    points = 2 * accuracy
    # Written as text: a column object for each of so many numbers would take longer than the scan.
    at = ", ".join(f"{i / points!r}D" for i in range(points + 1))
    # Which task a row is in decides only where its summary goes.
    known = df.select([_image(F.col(c)).alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    known = known.where(F.col("value").isNotNull()).withColumn(
        "_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    )
    grouped = known.groupBy("column", "_group").agg(
        F.expr(f"percentile_approx(value, array({at}), {4 * accuracy})").alias("at"), F.count("*").alias("n")
    )
    listed = grouped.select("column", "n", F.posexplode("at").alias("i", "value"))
    weight = F.when(F.col("i") > 0, F.col("n") / points).otherwise(0.0)
    counted = F.when(F.col("i") == 0, F.col("n"))
    by_value = Window.partitionBy("column").orderBy("value")
    # So many groups of so many points per column, however many rows.
    return listed.select(
        "column",
        "value",
        F.sum(weight).over(by_value).alias("upto"),
        F.sum(counted).over(Window.partitionBy("column")).alias("total"),
    )


def _target(fraction: Column, total: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(fraction * total))


def _brackets(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> dict[str, list]:
    """Per column: disjoint, ascending ranges of doubles that hold the values at the fractions."""
    points = summaries(df, columns, BRACKET_ACCURACY)
    upto, value, rank = F.col("upto"), F.col("value"), _target(F.col("fraction"), F.col("total"))
    slack = F.col("total") / (4 * BRACKET_ACCURACY)
    asked = points.withColumn("fraction", F.explode(F.array(*[F.lit(f) for f in fractions])))
    ends = asked.groupBy("column", "fraction").agg(
        F.max(F.when(upto + 3 * slack < rank - 1, value)).alias("low"),
        F.min(F.when(upto - slack >= rank + 1, value)).alias("high"),
    )
    ranges: dict[str, list] = {}
    for column, _, low, high in ends.collect():
        ranges.setdefault(column, []).append((-math.inf if low is None else low, math.inf if high is None else high))
    return {column: _disjoint(found) for column, found in ranges.items()}


def _disjoint(ranges: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _counted(df: DataFrame, brackets: dict[str, list], kinds: dict[str, str], fields: dict[str, str]) -> DataFrame:
    """Rows (column, piece, value, n): per piece of the order, and inside the ranges per value.

    A piece's number is odd inside a range and even between two.
    """
    cells = []
    for column in brackets:
        value = F.col(column).cast(kinds[column])
        own = [(value if kind == kinds[column] else F.lit(None).cast(kind)).alias(f) for kind, f in fields.items()]
        cells.append(F.struct(_image(value).alias("_image"), *own).alias(column))
    rows = df.select(cells).unpivot([], list(brackets), "column", "cell")
    rows = rows.select("column", "cell.*").where(F.col("_image").isNotNull())
    # One row per column; where one has fewer ranges than another, the rest lie above all values.
    most = max(len(ranges) for ranges in brackets.values())
    ends = {f"_{end}{i}": [(r + [(math.nan, math.nan)] * most)[i][k] for r in brackets.values()]
            for i in range(most) for k, end in enumerate(("low", "high"))}
    bounds = df.sparkSession.createDataFrame(
        pa.table({"_of": pa.array(brackets, pa.string()), **{n: pa.array(v, pa.float64(), from_pandas=False) for n, v in ends.items()}})
    )
    placed = rows.join(F.broadcast(bounds), F.col("column") == F.col("_of"))
    image = F.col("_image")
    passed = [(image >= F.col(f"_low{i}")).cast("int") + (image > F.col(f"_high{i}")).cast("int") for i in range(most)]
    placed = placed.withColumn("piece", reduce(add, passed))
    inside = [F.when(F.col("piece") % 2 == 1, F.col(f)).alias(f) for f in fields.values()]
    placed = placed.select("column", "piece", *inside)
    return store(placed.groupBy("column", "piece", *fields.values()).agg(F.count("*").alias("n")), "bracketed")


def select_ranks(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    kinds: dict[str, str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value of each column at each fraction, exactly: ``column, fraction, below, total`` and the value.

    It is the first value in order that at least this fraction of the rows that are not NULL
    don't exceed (the least for 0); ``below`` of the ``total`` rows are less than it. Values are doubles in
    ``value``, or with ``kinds`` (a numeric type by column) in one column per type,
    named like it, of which one is not NULL. Columns without a value have no rows.

    To the driver come a few numbers per column and fraction.
    """
    kinds = kinds or dict.fromkeys(columns, "double")
    fields = {kind: f"_v{i}" for i, kind in enumerate(sorted(set(kinds.values())))}
    fractions = sorted({float(f) for f in fractions})
    spark, parts = df.sparkSession, []
    brackets = _brackets(df.select([F.col(c).cast(kinds[c]).alias(c) for c in columns]), columns, fractions)
    wanted = {column: fractions for column in brackets}
    while brackets:
        counted = _counted(df, brackets, kinds, fields)
        sizes: dict[str, dict[int, tuple[int, int]]] = {}
        for column, piece, rows, values in counted.groupBy("column", "piece").agg(
            F.sum("n"), F.count("*")
        ).collect():
            sizes.setdefault(column, {})[piece] = rows, values
        targets, again = [], {}
        for column, pieces in sizes.items():
            total = sum(rows for rows, _ in pieces.values())
            for fraction in wanted[column]:
                rank, before, piece = max(1, math.ceil(fraction * total)), 0, -1
                for piece in sorted(pieces):
                    if before + pieces[piece][0] >= rank:
                        break
                    before += pieces[piece][0]
                if piece % 2:
                    targets.append((column, fraction, piece, rank - before, before, total))
                else:
                    again.setdefault(column, {})[fraction] = piece
        parts.append(_at_ranks(spark, counted, targets, list(fields.values()), sizes, max_group_rows))
        # A bracket that missed tells the gap that holds the value.
        wanted = {column: list(missed) for column, missed in again.items()}
        gaps = {}
        for column, missed in again.items():
            ends = [-math.inf, *[x for r in brackets[column] for x in r], math.inf]
            gaps[column] = _disjoint([(ends[p], ends[p + 1]) for p in missed.values()])
        brackets = gaps
    if not parts:
        parts = [_at_ranks(spark, _counted(df.limit(0), {columns[0]: [(0.0, 0.0)]}, kinds, fields), [],
                           list(fields.values()), {}, max_group_rows)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    names = {"_v0": "value"} if set(kinds.values()) == {"double"} else {f: k for k, f in fields.items()}
    return found.withColumnsRenamed(names)


def _at_ranks(spark, counted: DataFrame, targets: list, fields: list[str], sizes: dict, max_group_rows: int):
    names = ["column", "fraction", "piece", "_rank", "_before", "total"]
    kinds = [pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*targets)) if targets else [[] for _ in names]
    # A few numbers per column and fraction.
    targets = spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names))
    inside = counted.where("piece % 2 = 1")
    most = max([values for p in sizes.values() for k, (_, values) in p.items() if k % 2], default=0)
    limit = max_group_rows if most > max_group_rows else None
    summed = running_sum(inside, ["column", "piece"], fields, "n", "_upto", limit)
    first = F.min(F.struct("_upto", "n", *fields)).alias("_first")
    return (
        summed.join(F.broadcast(targets), ["column", "piece"])
        .where("_upto >= _rank")
        .groupBy("column", "fraction", "total", "_before")
        .agg(first)
        .select(
            "column", "fraction", *[F.col(f"_first.{f}").alias(f) for f in fields],
            (F.col("_before") + F.col("_first._upto") - F.col("_first.n")).alias("below"), "total",
        )
    )


def at_fractions(selected: DataFrame, fractions: dict[str, float], value: Column | str = "value") -> DataFrame:
    """One row per column from the rows of ``select_ranks``: a column per named fraction."""
    value = F.col(value) if isinstance(value, str) else value
    return selected.groupBy("column").agg(
        *[F.max(F.when(F.col("fraction") == float(f), value)).alias(name) for name, f in fractions.items()]
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: dict[str, float] = QUANTILES,
    accuracy: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per column with one value per named fraction; each is a value of the column.

    Exact unless an ``accuracy`` is given; then the error in rank is 1 / accuracy. Columns
    without a value have no row.
    """
    if accuracy is None:
        selected = select_ranks(df, columns, list(fractions.values()), None, max_group_rows)
        return at_fractions(selected, fractions)
    points = summaries(df, columns, accuracy)
    rank = {name: F.lit(float(f)) * F.col("total") for name, f in fractions.items()}
    return points.groupBy("column").agg(
        *[F.min(F.when(F.col("upto") >= r, F.col("value"))).alias(name) for name, r in rank.items()]
    )


def typed_order_statistics(
    df: DataFrame, columns: Sequence[str], fractions: dict[str, float] = QUANTILES,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Least, greatest and quantile values of numeric columns, each in its column's own type.

    One row per column and type with all values as text, so that columns of any
    types go into one table and no digit is lost: ``column, kind, known`` (rows not NULL), ``min``, the
    fractions, ``max``, and ``range`` (NULL where the type can't hold it). One summary and one
    count serve all columns, whatever their types.
    """
    kinds = {c: k for c, k in df.select(*columns).dtypes}
    every = {"min": 0.0, **fractions, "max": 1.0}
    selected = select_ranks(df, columns, list(every.values()), kinds, max_group_rows)
    tables = []
    for kind in sorted(set(kinds.values())):
        own = [c for c, k in kinds.items() if k == kind]
        value = F.col("value") if set(kinds.values()) == {"double"} else F.col(f"`{kind}`")
        wide = at_fractions(selected.where(F.col("column").isin(own)), every, value)
        known = selected.groupBy(F.col("column").alias("_of")).agg(F.max("total").alias("known"))
        joined = wide.join(F.broadcast(known), F.col("column") == F.col("_of"))
        tables.append(joined.select(
            "column", F.lit(kind).alias("kind"), "known",
            *[F.col(name).cast("string").alias(name) for name in every],
            F.try_subtract("max", "min").cast("string").alias("range"),
        ))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def quantile_edges(
    df: DataFrame, column: str, buckets: int = 10, accuracy: int | None = 100
) -> DataFrame:
    """The values at 0, 1/n, 2/n, ... 1 as rows (edge, value)."""
    fractions = {str(i): i / buckets for i in range(buckets + 1)}
    wide = quantiles(df, [column], fractions, accuracy)
    edges = [F.struct(F.lit(i).alias("edge"), F.col(str(i)).alias("value")) for i in range(buckets + 1)]
    return wide.select(F.inline(F.array(*edges)))


def edge_fractions(buckets: int) -> list[float]:
    return [i / buckets for i in range(buckets + 1)]


def histograms_of(selected: DataFrame, buckets: int = 10) -> DataFrame:
    """``quantile_histograms`` from rows of ``select_ranks`` at ``edge_fractions``.

    How many rows are below each edge is known, so a bucket's rows are a difference.
    """
    edges = selected.where(F.col("fraction").isin(edge_fractions(buckets)))
    edges = edges.groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("fraction", "value", "below"))).alias("edges"),
        F.max("total").alias("total"),
    )

    def bucket(i: int) -> Column:
        low, high = F.col("edges")[i], F.col("edges")[i + 1]
        upto = F.col("total") if i == buckets - 1 else high["below"]
        count = upto - low["below"]
        return F.struct(
            F.lit(i + 1).alias("bucket"),
            low["value"].alias("low"),
            high["value"].alias("high"),
            count.alias("count"),
            F.coalesce(F.try_divide(count * 100, F.col("total")), F.lit(0.0)).alias("percent"),
        )

    return edges.select("column", F.inline(F.array(*[bucket(i) for i in range(buckets)])))


def quantile_histograms(
    df: DataFrame,
    columns: Sequence[str],
    buckets: int = 10,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Rows per column and quantile bucket [low, high), and their share in percent.

    The last bucket includes its upper edge, so the greatest value is counted.
    Between equal edges there is nothing to count, and such buckets are listed with 0.
    """
    selected = select_ranks(df, columns, edge_fractions(buckets), None, max_group_rows)
    return histograms_of(selected, buckets)


def quantile_histogram(
    df: DataFrame, column: str, buckets: int = 10, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """``quantile_histograms`` of one column."""
    return quantile_histograms(df, [column], buckets, max_group_rows).drop("column")
