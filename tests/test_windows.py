"""Windows: by hand on ten rows, and the chunked way against the ordinary one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from proseledger.operators import skew, windows
from proseledger.operators.exact_sums import exact_sums
from proseledger.operators.sales import window_report
from proseledger.operators.shares import group_shares, share_of_total
from proseledger.sources import shared
from proseledger.sources.roles import Roles

SALES = [
    (1001, "C101", "2024-01-15", 150.50, "London"),
    (1002, "C102", "2024-01-15", 89.99, "Manchester"),
    (1003, "C101", "2024-01-16", 200.00, "London"),
    (1004, "C103", "2024-01-16", 150.50, "Birmingham"),
    (1005, "C104", "2024-01-17", 75.25, "London"),
    (1006, "C102", "2024-01-17", 299.99, "Manchester"),
    (1007, "C105", "2024-01-18", 150.50, "London"),
    (1008, "C101", "2024-01-18", 450.00, "London"),
    (1009, "C103", "2024-01-19", 89.99, "Birmingham"),
    (1010, "C106", "2024-01-19", 120.00, "Manchester"),
]

EXPECTED = {
    1001: (150.50, 150.50, 3, 3, None, 200.00, 0),
    1003: (350.50, 175.25, 2, 2, 150.50, 450.00, 49.50),
    1008: (800.50, 800.50 / 3, 1, 1, 200.00, None, 250.00),
    1002: (89.99, 89.99, 3, 3, None, 299.99, 0),
    1006: (389.98, 194.99, 1, 1, 89.99, None, 210.00),
    1004: (150.50, 150.50, 1, 1, None, 89.99, 0),
    1009: (240.49, 120.245, 2, 2, 150.50, None, -60.51),
    1005: (75.25, 75.25, 5, 4, None, None, 0),
    1007: (150.50, 150.50, 3, 3, None, None, 0),
    1010: (120.00, 120.00, 2, 2, None, None, 0),
}


@pytest.fixture(scope="module")
def sales(spark):
    names = ["order_id", "customer_id", "order_date", "amount", "region"]
    return spark.createDataFrame(SALES, names)


def all_windows(df, limit):
    order = ["order_date", "order_id"]
    df = windows.running_sum(
        df, ["customer_id", "region"], order, "amount", max_group_rows=limit
    )
    df = windows.moving_avg(df, ["customer_id"], order, "amount", max_group_rows=limit)
    df = windows.ranks(df, ["region"], "amount", ["order_id"], max_group_rows=limit)
    return windows.prev_next(df, ["customer_id"], order, "amount", max_group_rows=limit)


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_ten_rows_by_hand(sales, limit):
    rows = all_windows(sales, limit).collect()
    assert len(rows) == 10
    for row in rows:
        got = (
            row.cumulative_sum, row.moving_avg_3, row.rank_in_group, row.dense_rank_in_group,
            row.prev_amount, row.next_amount, row.amount_change,
        )
        for g, e in zip(got, EXPECTED[row.order_id]):
            assert g == (pytest.approx(e) if e is not None else None), row


def skewed_rows(seed):
    """One key with most rows, ties in date and value, NULL keys and values."""
    pick = random.Random(seed)
    rows = []
    for i in range(600):
        key = pick.choice(["hot"] * 6 + ["warm", "a", "b", None])
        day = pick.choice(["2024-01-01"] * 3 + [f"2024-01-{d:02d}" for d in range(1, 20)])
        value = pick.choice([1.0, 2.0, 2.0, 2.0, 3.5, 7.25, None, float(i)])
        rows.append((i, key, day, value))
    return rows


def by_hand(rows, key_of, n):
    """Running sum, moving mean, neighbours and ranks in plain Python."""
    groups = {}
    for row in rows:
        groups.setdefault(key_of(row), []).append(row)
    out = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[2], r[0]))
        values = [r[3] for r in group]
        for i, row in enumerate(group):
            upto = [v for v in values[: i + 1] if v is not None]
            last = [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]
            higher = [v for v in values if v is not None and (row[3] is None or v > row[3])]
            out[row[0]] = (
                sum(upto) if upto else None,
                sum(last) / len(last) if last else None,
                values[i - 1] if i else None,
                values[i + 1] if i + 1 < len(values) else None,
                len(higher) + 1,
                len(set(higher)) + 1,
            )
    return out


@pytest.mark.parametrize("limit, n", [(5, 3), (40, 7), (250, 3)])
def test_chunks_give_what_one_window_gives(spark, limit, n):
    rows = skewed_rows(limit + n)
    df = spark.createDataFrame(rows, "id long, k string, day string, amount double")
    df = df.repartition(7)
    order = ["day", "id"]
    df = windows.running_sum(df, ["k"], order, "amount", max_group_rows=limit)
    df = windows.moving_avg(df, ["k"], order, "amount", n, "mean", max_group_rows=limit)
    df = windows.prev_next(df, ["k"], order, "amount", max_group_rows=limit)
    df = windows.ranks(df, ["k"], "amount", ["id"], max_group_rows=limit)
    expected = by_hand(rows, lambda r: r[1], n)
    got = df.collect()
    assert len(got) == len(rows)
    for row in got:
        values = (
            row.cumulative_sum, row["mean"], row.prev_amount, row.next_amount,
            row.rank_in_group, row.dense_rank_in_group,
        )
        for g, e in zip(values, expected[row.id]):
            assert g == (pytest.approx(e) if e is not None else None), row


def test_rank_when_one_value_fills_many_chunks(spark):
    rows = [(i, "g", 5.0) for i in range(300)] + [(300, "g", 9.0), (301, "g", 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, amount double").repartition(5)
    got = windows.ranks(df, ["g"], "amount", ["id"], max_group_rows=20)
    assert {
        (r.amount, r.rank_in_group, r.dense_rank_in_group) for r in got.collect()
    } == {(9.0, 1, 1), (5.0, 2, 2), (1.0, 302, 3)}


@pytest.mark.parametrize("setting, bound", [("MAX_BROADCAST_ROWS", 2), ("MAX_BROADCAST_BYTES", 200)])
def test_more_large_groups_than_may_be_broadcast(spark, monkeypatch, setting, bound):
    """The heaviest groups are broadcast and the others shuffled; the limit of a chunk stays."""
    monkeypatch.setattr(skew, setting, bound)
    rows = [(i, f"g{0 if i % 3 else i % 5}", f"2024-01-{i % 9 + 1:02d}", float(i % 13)) for i in range(300)]
    rows[7] = (7, "alone", "2024-01-05", 1.0)
    df = spark.createDataFrame(rows, "id long, k string, day string, amount double")
    found = skew.large_groups(df, ["k"], 10)
    assert sorted(r.k for r in found.groups.collect()) == ["g0", "g1", "g2", "g3", "g4"]
    assert found.chunks == 30 and not found.all_rows and not found.is_small(found.number)
    rest, large = skew.split(df, ["k"], found)
    assert [r.id for r in rest.collect()] == [7] and large.count() == 299
    order = ["day", "id"]
    df = windows.running_sum(df, ["k"], order, "amount", max_group_rows=10)
    df = windows.moving_avg_and_neighbours(df, ["k"], order, "amount", max_group_rows=10)
    df = windows.ranks(df, ["k"], "amount", ["id"], max_group_rows=10)
    expected = by_hand(rows, lambda r: r[1], 3)
    got = df.collect()
    assert len(got) == 300
    for row in got:
        values = (
            row.cumulative_sum, row.moving_avg_3, row.prev_amount, row.next_amount,
            row.rank_in_group, row.dense_rank_in_group,
        )
        assert values == pytest.approx(expected[row.id]), row


def test_no_chunk_task_gets_a_whole_large_group(spark):
    df = spark.range(0, 10_000).select(
        F.col("id"), F.lit("hot").alias("k"), (F.col("id") % 97).cast("double").alias("amount")
    )
    chunked = skew.in_chunks(df, ["k"], [F.col("amount").desc(), F.col("id")], 10)
    sizes = [r["count"] for r in chunked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 10 and max(sizes) <= 1_500


def test_chunks_do_not_grow_with_the_rows_under_a_low_limit(spark):
    """Shuffles have an index entry per pair of chunks and tasks report to the driver: one chunk per few rows is too many."""
    df = spark.range(0, 20_000).select((F.col("id") % 40).alias("k"), "id")
    assert skew.large_groups(df, ["k"], 12).chunks == skew.large_groups(df, ["k"], 40).chunks <= 500
    assert skew.large_groups(df, ["k"], 100).chunks == 200
    # Chunks are never larger than a task may be given.
    assert skew.chunks_of(10 ** 10, 12) == skew.chunks_of(10 ** 10, skew.MAX_GROUP_ROWS) == 10_000


def test_fewer_chunks_than_the_limit_asks_for(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_CHUNKS", 3)
    rows = skewed_rows(11)
    df = spark.createDataFrame(rows, "id long, k string, day string, amount double").repartition(7)
    df = windows.running_sum(df, ["k"], ["day", "id"], "amount", max_group_rows=5)
    df = windows.moving_avg_and_neighbours(df, ["k"], ["day", "id"], "amount", max_group_rows=5)
    df = windows.ranks(df, ["k"], "amount", ["id"], max_group_rows=5)
    expected = by_hand(rows, lambda r: r[1], 3)
    got = df.collect()
    assert len(got) == len(rows)
    for row in got:
        values = (
            row.cumulative_sum, row.moving_avg_3, row.prev_amount, row.next_amount,
            row.rank_in_group, row.dense_rank_in_group,
        )
        assert values == pytest.approx(expected[row.id]), row


@pytest.mark.parametrize("limit", [50, 100])
def test_a_chain_does_not_evaluate_its_source_again(spark, limit):
    """The scans of the plan do not grow with the number of operators before."""
    rows = spark.createDataFrame(skewed_rows(3), "id long, k string, day string, amount double")
    df, scans = shared.store(rows), []
    for i in range(4):
        df = windows.running_sum(df, ["k"], ["day", "id"], "amount", f"sum{i}", max_group_rows=limit)
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
    assert scans == scans[:1] * 4 and scans[0] <= 2


def test_shares_by_hand(sales):
    got = {r.region: r for r in group_shares(sales, "region", "amount").collect()}
    shares = {k: (round(r.group_sum, 2), float(r.percent_of_total)) for k, r in got.items()}
    assert shares == {
        "London": (1026.25, 57.76), "Manchester": (509.98, 28.70), "Birmingham": (240.49, 13.54)
    }
    assert round(got["London"].total_sum, 2) == 1776.72


@pytest.mark.parametrize("limit", [500_000, 2, 1])
def test_share_on_every_row(spark, sales, limit):
    extra = spark.createDataFrame([(1, "X", "2024-01-01", 0.0, None)], sales.schema)
    rows = share_of_total(sales.union(extra), "region", "amount", limit).collect()
    assert len(rows) == 11
    assert {(r.region, float(r.percent_of_total)) for r in rows} == {
        ("London", 57.76), ("Manchester", 28.70), ("Birmingham", 13.54), (None, 0.0)
    }


def odd_doubles(count, seed):
    pick = random.Random(seed)
    kinds = [lambda: pick.gauss(0, 1), lambda: pick.gauss(0, 1) * 10.0 ** pick.randrange(-12, 13),
             lambda: round(pick.uniform(0, 1e5), 2), lambda: 0.1, lambda: -1e16, lambda: 1e16, lambda: None]
    return [pick.choice(kinds)() for _ in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_sums_are_those_of_fractions(spark, seed):
    values = odd_doubles(3000, seed)
    rows = [(i, i % 7, v) for i, v in enumerate(values)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "i long, g int, v double").repartition(parts)
        for r in exact_sums(df, ["g"], "v").collect():
            own = [v for i, g, v in rows if g == r.g and v is not None]
            assert r.sum == math.fsum(own) and r.known == len(own) and r.mean == math.fsum(own) / len(own)
        assert exact_sums(df, [], "v").first()["sum"] == math.fsum(v for v in values if v is not None)


def test_exact_sums_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", None), ("d", 5e-280), ("d", 1e300), ("d", -1e300),
            ("e", 0.0), ("f", -1.0), ("f", 2.0**-60), ("g", nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.sum for r in exact_sums(df, ["g"], "v").collect()}
    assert got["a"] == inf and math.isnan(got["b"]) and got["c"] is None and got["d"] == 5e-280
    assert got["e"] == 0.0 and got["f"] == -1.0 and math.isnan(got["g"])
    assert exact_sums(df.limit(0), ["g"], "v").collect() == []


@pytest.mark.parametrize("limit", [None, 100])
def test_exact_running_sums_have_the_same_bits_in_chunks(spark, limit):
    values = odd_doubles(1500, 5)
    rows = [(i, "hot" if i % 3 else f"g{i % 9}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i long, g string, v double").repartition(4)
    got = windows.running_sum(df, ["g"], ["i"], "v", max_group_rows=limit, exact=True).collect()
    seen = {}
    for r in sorted(got, key=lambda r: r.i):
        if r.v is not None:
            seen.setdefault(r.g, []).append(r.v)
        assert r.cumulative_sum == (math.fsum(seen[r.g]) if r.g in seen else None), r
    assert len(got) == len(rows)


def test_exact_running_sums_of_zeros_and_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 0.0)], "i int, v double").withColumn("g", F.lit(1))
    got = windows.running_sum(df, ["g"], ["i"], "v", exact=True).orderBy("i").collect()
    assert [r.cumulative_sum for r in got] == [0.0, 0.0, 0.0]
    df = spark.createDataFrame([(1, 1.5), (2, inf), (3, 2.0)], "i int, v double").withColumn("g", F.lit(1))
    got = windows.running_sum(df, ["g"], ["i"], "v", exact=True).orderBy("i").collect()
    assert [r.cumulative_sum for r in got] == [1.5, inf, inf]


@pytest.mark.parametrize("limit", [1_000_000, 150, 1])
def test_the_report_ranges_the_rows_once_per_key(spark, monkeypatch, limit):
    pick = random.Random(2)
    rows = [(i, pick.choice("aaab"), pick.choice("xyyy"), f"2024-01-{1 + i % 28:02d}", float(pick.randrange(100)))
            for i in range(600)]
    df = spark.createDataFrame(rows, "n long, id string, grp string, day string, amount double")
    roles = Roles(id="id", group="grp", date="day", amount="amount")
    ranged = []
    monkeypatch.setattr(windows, "in_chunks", lambda *a: ranged.append(a[1]) or skew.in_chunks(*a))
    got = {r.n: r for r in window_report(df, roles, "n", limit).collect()}
    assert ranged == ([] if limit > 600 else [["id"], ["grp"]])
    ordered = sorted(rows, key=lambda r: (r[3], r[0]))
    total = sum(r[4] for r in rows)
    for n, i, g, day, amount in rows:
        before = [r for r in ordered if r[1] == i and (r[3], r[0]) <= (day, n)]
        after = [r[4] for r in ordered if r[1] == i and (r[3], r[0]) > (day, n)]
        mine = got[n]
        assert mine.cumulative_sum == pytest.approx(sum(r[4] for r in before if r[2] == g))
        assert mine.moving_avg_3 == pytest.approx(sum(r[4] for r in before[-3:]) / len(before[-3:]))
        assert mine.prev_amount == (before[-2][4] if len(before) > 1 else None)
        assert mine.next_amount == (after[0] if after else None)
        higher = [r[4] for r in rows if r[2] == g and r[4] > amount]
        assert (mine.rank_in_group, mine.dense_rank_in_group) == (len(higher) + 1, len(set(higher)) + 1)
        assert mine.group_sum == pytest.approx(sum(r[4] for r in rows if r[2] == g)) and mine.total_sum == pytest.approx(total)
