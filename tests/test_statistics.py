"""Profiles, quantiles and correlations: edge cases and brute force."""

import random
import re
from decimal import Decimal

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from proseledger.operators import correlation, profile, quantiles
from proseledger.operators.reconcile import reconcile
from proseledger.plans.inspect import plan_text


def exact(values, fraction):
    values = sorted(values)
    target = max(1, -(-round(fraction * len(values) * 10**9) // 10**9))
    return values[target - 1]


@pytest.fixture(scope="module")
def numbers(spark):
    pick = random.Random(5)
    rows = [
        (
            i,
            pick.choice([None, 1.0, 2.0, 2.0, float(pick.randrange(500))]),
            7.0,
            pick.gauss(0, 1),
        )
        for i in range(1000)
    ]
    return spark.createDataFrame(rows, "id long, mixed double, constant double, normal double")


COLUMNS = ["id", "mixed", "constant", "normal"]


@pytest.mark.parametrize("limit", [1_000_000, 30])
def test_exact_quantiles_against_sorting(numbers, limit):
    data = numbers.toPandas()
    got = quantiles.quantiles(numbers, COLUMNS, max_group_rows=limit).collect()
    assert sorted(r.column for r in got) == sorted(COLUMNS)
    for row in got:
        values = data[row.column].dropna().tolist()
        for name, fraction in quantiles.QUANTILES.items():
            assert row[name] == exact(values, fraction), (row.column, name)


def test_approximate_quantiles_are_near_the_exact_ones(numbers):
    values = sorted(numbers.toPandas()["normal"])
    row = quantiles.quantiles(numbers, ["normal"], accuracy=100).first()
    for name, fraction in quantiles.QUANTILES.items():
        assert abs(values.index(row[name]) - fraction * 1000) <= 12


def test_selection_counts_only_what_is_inside_the_brackets(spark, monkeypatch):
    pick = random.Random(3)
    values = [pick.random() for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    counted, stored = [], quantiles.store

    def count(table, name="table"):
        out = stored(table, name)
        if name == "bracketed":
            counted.append(out.count())
        return out

    monkeypatch.setattr(quantiles, "store", count)
    row = quantiles.quantiles(df, ["v"], {"a": 0.25, "b": 0.75}).first()
    assert (row.a, row.b) == (exact(values, 0.25), exact(values, 0.75))
    # Two brackets of less than a hundredth each, and what is outside them as a row or two.
    assert len(counted) == 1 and counted[0] < 2 * 200 + 5


def test_a_bracket_that_misses_is_found_out(numbers, monkeypatch):
    values = numbers.toPandas()["normal"].tolist()
    monkeypatch.setattr(quantiles, "_brackets", lambda df, columns, fractions: {c: [(0.0, 0.1), (2.0, 2.1)] for c in columns})
    got = quantiles.quantiles(numbers, ["normal"]).first()
    assert all(got[name] == exact(values, f) for name, f in quantiles.QUANTILES.items())


def test_summaries_meet_in_two_steps(numbers):
    text = plan_text(quantiles.summaries(numbers, COLUMNS, 100), "simple")
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert ["_group" in k for k in keys] == [False, True], keys


@pytest.mark.parametrize("parts", [1, 7])
def test_summaries_are_as_right_as_they_say(spark, parts):
    pick = random.Random(parts)
    values = [round(pick.lognormvariate(0, 3), 2) for _ in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    rows = quantiles.summaries(df, ["v"], 50).collect()
    ordered = np.sort(values)
    for r in rows:
        upto = np.searchsorted(ordered, r.value, "right")
        assert r.total == 30_000
        assert upto - 3 * 30_000 / 200 - 1 <= r.upto <= upto + 30_000 / 200 + 1


def test_selection_of_odd_values_and_of_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(v,) for v in [nan, inf, -inf, 0.0, -0.0, 1.0, None, nan]]
    df = spark.createDataFrame(rows, "v double")
    row = quantiles.quantiles(df, ["v"], {"a": 0.0, "b": 3 / 7, "c": 5 / 7, "d": 1.0}).first()
    assert (row.a, row.b, row.c) == (-inf, 0.0, inf) and np.isnan(row.d)
    assert quantiles.quantiles(df.limit(0), ["v"]).collect() == []
    assert quantiles.quantiles(df.where("v is null"), ["v"]).collect() == []
    assert quantiles.quantile_histogram(df.limit(0), "v").collect() == []


def test_typed_order_statistics_keep_every_digit(spark):
    rows = [(2**62 + i, Decimal(10**37 + i), i, None) for i in range(100)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "a long, b decimal(38,0), c int, d long").repartition(3)
    got = {r.column: r for r in quantiles.typed_order_statistics(df, ["a", "b", "c", "d"]).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert (got["a"].min, got["a"].median, got["a"].max, got["a"].known) == (
        str(2**62), str(2**62 + 49), str(2**62 + 99), 100
    )
    assert (got["b"].min, got["b"].p99, got["b"].max) == (str(10**37), str(10**37 + 98), str(10**37 + 99))
    assert (got["c"].kind, got["c"].q3, got["c"].range) == ("int", "74", "99")


def test_profile_of_constant_and_missing_values(spark, numbers):
    df = numbers.withColumn("nothing", F.lit(None).cast("double"))
    for level in (None, StorageLevel.DISK_ONLY):
        rows = {r.column: r for r in profile.profile(df, [*COLUMNS, "nothing"], persist=level).collect()}
        constant, nothing, mixed = rows["constant"], rows["nothing"], rows["mixed"]
        assert (constant.stddev, constant.iqr, constant.cv, constant["range"]) == (0, 0, 0, 0)
        assert constant.skewness is None and constant.kurtosis is None
        assert (nothing.null_count, nothing.non_null_count, nothing.mean, nothing.median) == (
            1000, 0, None, None
        )
        assert mixed.null_count + mixed.non_null_count == 1000 and mixed.null_count > 0
        assert mixed["count"] == mixed.non_null_count


def test_shape_of_six_numbers(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 10, 25]], "v int")
    row = profile.profile(df, ["v"]).first()
    assert row.skewness == pytest.approx(1.378263, abs=1e-6)
    assert row.kurtosis == pytest.approx(0.341993, abs=1e-6)
    assert row.stddev == pytest.approx(9.137833, abs=1e-6)
    assert row.cv == pytest.approx(9.137833 / 7.5 * 100, abs=1e-4)


def test_variation_around_a_zero_mean_is_zero(spark):
    df = spark.createDataFrame([(-1.0,), (1.0,)], "v double")
    assert profile.profile(df, ["v"]).first().cv == 0.0


def test_correlation_skips_rows_with_a_null(spark):
    rows = [(1, 2.0, 1), (2, 4.0, 1), (3, 6.5, 1), (None, 8.0, 1), (5, None, 1)]
    df = spark.createDataFrame(rows, "a int, b double, c int")
    got = {(r.col1, r.col2): r for r in correlation.correlations(df, ["a", "b", "c"]).collect()}
    assert len(got) == 6
    assert got["a", "b"].corr == pytest.approx(0.997949, abs=1e-5)
    assert (got["a", "b"].strength, got["a", "b"].direction) == ("Strong", "Positive")
    assert got["a", "c"].corr is None and got["a", "c"].strength is None
    assert got["a", "a"].corr == pytest.approx(1) and got["a", "a"].strength == "Perfect"


def test_correlation_labels(spark):
    pick = np.random.default_rng(3)
    x = pick.normal(size=4000)
    data = {"x": x}
    for name, share in {"strong": -0.9, "moderate": 0.5, "weak": 0.2, "none": 0.0}.items():
        data[name] = share * x + np.sqrt(1 - share**2) * pick.normal(size=4000)
    names = list(data)
    df = spark.createDataFrame([tuple(map(float, row)) for row in zip(*data.values())], names)
    got = {r.col2: r for r in correlation.correlations(df, names).where("col1 = 'x'").collect()}
    matrix = np.corrcoef(list(data.values()))
    for i, name in enumerate(names):
        assert got[name].corr == pytest.approx(matrix[0, i], abs=1e-9)
    assert [got[n].strength for n in names] == ["Perfect", "Strong", "Moderate", "Weak", "Negligible"]
    assert got["strong"].direction == "Negative"


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_histogram_counts_every_value_once(spark, limit):
    pick = random.Random(9)
    values = [pick.choice([1, 1, 1, 1, 2, 50, pick.randrange(100)]) for _ in range(500)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = quantiles.quantile_histogram(df, "v", 10, limit).orderBy("bucket").collect()
    known = [v for v in values if v is not None]
    assert [r.bucket for r in got] == list(range(1, 11))
    assert sum(r["count"] for r in got) == 500
    assert got[-1].high == max(known)
    assert sum(r.percent for r in got) == pytest.approx(100)
    for i, r in enumerate(got):
        inside = [v for v in known if r.low <= v < r.high or (i == 9 and v == r.high)]
        assert r["count"] == len(inside)


def test_histogram_of_one_repeated_value(spark):
    df = spark.createDataFrame([(4,)] * 7, "v int")
    got = quantiles.quantile_histogram(df, "v", 4).orderBy("bucket").collect()
    assert [r["count"] for r in got] == [0, 0, 0, 7]


def test_highlights_leave_out_the_diagonal(spark):
    df = spark.createDataFrame(
        [(float(i), float(i % 7), "a" if i % 3 else "b") for i in range(60)],
        "x double, y double, c string",
    )
    from proseledger.operators.frequency import mode_of

    found = profile.profile_highlights(
        profile.profile(df, ["x", "y"]),
        correlation.correlations(df, ["x", "y"]),
        mode_of(df, "c"),
    )
    got = {r.finding: (r.subject, r.value) for r in found.collect()}
    assert got["largest_feature"] == ("x", 59.0)
    assert got["strongest_correlation"][0] == "x / y" and got["strongest_correlation"][1] < 1
    assert got["most_common_category"] == ("c / a", 40.0)


def test_reconcile_finds_differences(spark):
    left = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, None), (None, 3.0, "z"), ("d", 4.0, "d")],
                                 "k string, n double, s string")
    right = spark.createDataFrame([("a", 1.004, "x"), ("b", 2.0, None), (None, 3.5, "z"), ("e", 4.0, "d")],
                                  "k string, n double, s string")
    got = {r.k: r.matches for r in reconcile(left, right, ["k"], ["n", "s"], 0.01).collect()}
    assert got == {"a": True, "b": True, None: False, "d": False, "e": False}
