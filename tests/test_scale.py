"""Many columns, many values, whole tables and growing ones: against plain computations, and how much is shuffled."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from proseledger.operators import correlation, frequency, incremental, profile, quantiles, reconcile
from proseledger.plans.inspect import plan_text


def plan(df):
    return plan_text(df, "simple")


# --- correlations ------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 3])
def test_correlations_of_columns_with_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(correlation, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = rng.normal(size=(500, 3))
    data = {f"c{i}": 1e9 * (i % 2) + base @ rng.normal(size=3) + rng.normal(size=500) for i in range(7)}
    data["same"] = np.full(500, 0.1)
    data["rare"] = np.where(rng.random(500) < 0.01, rng.normal(size=500), np.nan)
    names = list(data)
    gaps = rng.random((500, len(names))) < 0.2
    rows = [tuple(None if np.isnan(data[c][r]) or gaps[r, k] else float(data[c][r]) for k, c in enumerate(names))
            for r in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    got = {(r.col1, r.col2): r for r in correlation.correlations(df, names).collect()}
    assert len(got) == len(names) * (len(names) + 1) // 2
    for (a, b), row in got.items():
        i, j = names.index(a), names.index(b)
        both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        if "same" in (a, b) or len({x for x, _ in both}) < 2 or len({y for _, y in both}) < 2:
            assert row.corr is None, (a, b)
        else:
            x, y = (np.array(v) - np.mean(v) for v in zip(*both))
            expected = (x @ y) / np.sqrt((x @ x) * (y @ y))
            assert row.corr == pytest.approx(expected, abs=1e-6), (a, b)


def test_correlations_of_odd_values_and_of_nothing(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, inf, None), (3.0, 5.0, None)], "a double, b double, c double")
    got = {(r.col1, r.col2): r.corr for r in correlation.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "a"] == pytest.approx(1) and np.isnan(got["a", "b"]) and np.isnan(got["b", "b"])
    assert got["a", "c"] is None and got["c", "c"] is None
    assert [r.corr for r in correlation.correlations(df.limit(0), ["a", "b"]).collect()] == [None] * 3


def test_a_hundred_columns_take_one_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    columns = [(F.col("l_quantity") * i).alias(f"c{i}") for i in range(100)]
    text = plan(correlation.correlations(df.select(columns), [f"c{i}" for i in range(100)]))
    assert text.count("FileScan") == 1 and "Expand" not in text and "MapInArrow" in text


# --- commonest values ----------------------------------------------------------------------------


def zipf(seed, rows, values):
    pick = random.Random(seed)
    return [int(values * pick.random() ** 6) for _ in range(rows)]


@pytest.mark.parametrize("kind", ["long", "string", "double", "date"])
def test_heavy_hitters_are_the_top_values(spark, kind):
    values = zipf(1, 20_000, 5000) + [None] * 700
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    cast = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v").cast("int"))}.get(kind, F.col("v").cast(kind))
    df = df.select(cast.alias("v"))
    expected = [tuple(r) for r in frequency.top_values(df, "v", 10).collect()]
    assert [tuple(r) for r in frequency.heavy_hitters(df, "v", 10).collect()] == expected
    assert expected[0][1] > 700


def test_heavy_hitters_send_only_candidates(spark, monkeypatch):
    values = zipf(2, 30_000, 20_000)
    df = spark.createDataFrame([(str(v),) for v in values], "v string").repartition(4)
    expected = [tuple(r) for r in frequency.top_values(df, "v", 5).collect()]
    monkeypatch.setattr(frequency, "top_values", None)
    counted, stored = [], frequency.store
    monkeypatch.setattr(frequency, "store", lambda t, name: counted.append(stored(t, name)) or counted[-1])
    got = [tuple(r) for r in frequency.heavy_hitters(df, "v", 5).collect()]
    assert got == expected
    assert counted[0].count() <= 111 and len(set(values)) > 5000


def test_heavy_hitters_that_are_not_certain_are_counted(spark):
    df = spark.createDataFrame([(i % 3000,) for i in range(9000)] + [(7,)], "v int").repartition(3)
    got = [tuple(r) for r in frequency.heavy_hitters(df, "v", 3, tracked=64).collect()]
    assert got == [(7, 4), (0, 3), (1, 3)]


def test_heavy_hitters_of_few_values_and_of_none(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    assert [tuple(r) for r in frequency.heavy_hitters(df, "v", 10).collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert frequency.heavy_hitters(df.limit(0), "v").collect() == []
    lists = df.select(F.array("v").alias("v"))
    assert frequency.heavy_hitters(lists, "v", 1).first()["count"] == 2


# --- two tables ------------------------------------------------------------------------------------


def plain_differences(left, right):
    a, b = Counter(left), Counter(right)
    return {(*row, a[row], b[row]) for row in a | b if a[row] != b[row]}


@pytest.mark.parametrize("ranges", [4096, 2])
def test_differences_of_multisets(spark, monkeypatch, ranges):
    monkeypatch.setattr(reconcile, "RANGES", ranges)
    pick = random.Random(ranges)
    left = [(pick.choice([None, "a", "b", ""]), pick.choice([None, 1, 2, 300]), float(i % 40)) for i in range(800)]
    right = list(left)
    for _ in range(15):
        right[pick.randrange(800)] = (pick.choice([None, "c"]), 1, None)
    right += right[:3]
    right.append((None, None, None))
    schema = "k string, n long, v double"
    a, b = (spark.createDataFrame(rows, schema).repartition(3) for rows in (left, right))
    got = {tuple(r) for r in reconcile.differences(a, b).collect()}
    assert got == plain_differences(left, right)
    assert reconcile.differences(a, a.repartition(5).select("v", "k", "n")).count() == 0
    assert reconcile.differences(a.limit(0), b.limit(0)).count() == 0
    assert reconcile.differences(a.limit(0), b).agg(F.sum("right_rows")).first()[0] == len(right)
    names = {(k, n) for k, n, _ in left} ^ {(k, n) for k, n, _ in right}
    assert names <= {(r.k, r.n) for r in reconcile.differences(a, b, ["k", "n"]).collect()}
    with pytest.raises(ValueError):
        reconcile.differences(a, b.drop("v"))
    with pytest.raises(ValueError):
        reconcile.differences(a, b.withColumn("n", F.col("n").cast("int")))


def test_equal_tables_are_compared_without_a_shuffle_of_rows(spark, sf, monkeypatch):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    seen, stored = [], reconcile.store
    monkeypatch.setattr(reconcile, "store", lambda t, name: seen.append(plan(t)) or stored(t, name))
    assert reconcile.differences(df, df.repartition(3)).count() == 0
    assert len(seen) == 1
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", seen[0])
    # By the number of the range, and of few rows: both sides are combined before.
    assert keys and not any("l_" in k for k in keys), keys
    assert all("partial_sum" in part for part in seen[0].split("Exchange hashpartitioning")[1:]), seen[0]


# --- files that are added ------------------------------------------------------------------------------


def test_a_profile_reads_only_new_files(spark, tmp_path, monkeypatch):
    pick = random.Random(8)
    rows = [(1e9 + pick.gauss(0, 1), pick.choice([None, 1.0, 5.0]), 3, None) for _ in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double")
    columns = ["a", "b", "c", "d"]
    whole, first, second, state = (f"{tmp_path}/{n}" for n in ("whole", "first", "second", "state"))
    df.limit(600).repartition(3).write.parquet(first)
    read, states_of = [], incremental.file_states
    monkeypatch.setattr(incremental, "file_states", lambda t, c: read.append(sorted(t.inputFiles())) or states_of(t, c))
    incremental.profile_files(spark, [first], columns, state).collect()
    done = sorted(spark.read.parquet(first).inputFiles())
    assert read == [done]
    incremental.profile_files(spark, [first], columns, state).collect()
    assert len(read) == 1
    df.subtract(df.limit(0)).limit(300).coalesce(1).write.parquet(second)
    got = {r.column: r for r in incremental.profile_files(spark, [first, second], columns, state).collect()}
    assert len(read) == 2 and read[1] == sorted(spark.read.parquet(second).inputFiles())
    spark.read.parquet(first, second).write.parquet(whole)
    full = spark.read.parquet(whole)
    expected = {r.column: r for r in profile.profile(full, columns).collect()}
    ranked = np.sort([r.a for r in full.collect()])
    for c in columns:
        for name in ("count", "mean", "stddev", "min", "max", "skewness", "kurtosis", "null_count", "range", "cv"):
            if expected[c][name] is None:
                assert got[c][name] is None, (c, name)
            else:
                assert got[c][name] == pytest.approx(expected[c][name], rel=1e-6, abs=1e-6), (c, name)
    for name, f in quantiles.QUANTILES.items():
        assert abs(np.searchsorted(ranked, got["a"][name]) - f * len(ranked)) <= 0.01 * len(ranked) + 2
    # A file that is gone no longer counts.
    again = incremental.profile_files(spark, [second], columns, state).where("column = 'c'").first()
    assert again["count"] == spark.read.parquet(second).count() and len(read) == 2
    assert os.path.isdir(state)
