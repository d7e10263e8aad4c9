"""Extraction, masking, features and labels on rows worked out by hand."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proseledger.functions import extract, fixed, labels
from proseledger.functions.text import has_positive, text_features, word_count
from proseledger.operators import aggregates, frequency

TEXTS = [
    (1, "Email: test@example.com Phone: (555) 123-4567 Date: 2024-12-10"),
    (2, "Credit Card: 4111-2222-3333-4444 Amount: $1,250.75"),
    (3, "Order #ABC-12345 Invoice INV-9876"),
    (4, "Simple text with no patterns"),
    (5, "IP: 192.168.1.1 Error: ERR-404"),
]
FIELDS = ["email", "phone", "date", "order_ref", "has_cc", "ip_address", "amount", "error_code"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string")


def test_extraction_by_hand(texts):
    rows = {r.id: tuple(r[f] for f in FIELDS) for r in extract.extract_features(texts).collect()}
    assert rows == {
        1: ("test@example.com", "(555) 123-4567", "2024-12-10", "", "NO", "", "", ""),
        2: ("", "", "", "", "YES", "", "1,250.75", ""),
        3: ("", "", "", "ABC-12345", "NO", "", "", ""),
        4: ("", "", "", "", "NO", "", "", ""),
        5: ("", "", "", "", "NO", "192.168.1.1", "", "ERR-404"),
    }


def test_masking_by_hand(texts):
    masked = {r.id: r.masked_text for r in extract.extract_features(texts).collect()}
    assert masked[2] == "Credit Card: XXXX-XXXX-XXXX-#### Amount: $1,250.75"
    assert all(masked[i] == text for i, text in TEXTS if i != 2)
    view = extract.masked_view(texts, "id").collect()
    assert [(r.id, r.masked_text) for r in view] == [(2, masked[2])]


def test_extraction_stats_by_hand(texts):
    stats = {r.field: (r.total, r.hits, r.rate) for r in extract.extraction_stats(texts).collect()}
    assert stats == {
        "email": (5, 1, 0.2), "phone": (5, 1, 0.2), "date": (5, 1, 0.2), "order_ref": (5, 1, 0.2),
        "ip_address": (5, 1, 0.2), "amount": (5, 1, 0.2), "error_code": (5, 1, 0.2),
        "card": (5, 1, 0.2),
    }


def test_null_text_extracts_null_and_counts_as_no_hit(spark):
    df = spark.createDataFrame([(None,), ("",), ("a@b.cd",)], "text string")
    rows = extract.extract_features(df).collect()
    assert [(r.email, r.has_cc, r.masked_text) for r in rows] == [
        (None, "NO", None), ("", "NO", ""), ("a@b.cd", "NO", "a@b.cd")
    ]
    stats = {r.field: (r.total, r.hits) for r in extract.extraction_stats(df).collect()}
    assert stats["email"] == (3, 1) and stats["card"] == (3, 0)


def test_amount_keeps_three_digits_before_the_point(spark):
    df = spark.createDataFrame([("$123456",), ("$1,234,567.891",), ("$5",)], "text string")
    assert [r.amount for r in extract.extract_features(df).collect()] == ["12345", "1,234,567.89", "5"]


NEAR_MISSES = st.text(alphabet="aZ@._%+- 0123456789(){}$,:#ErRrorINVOdeg\n\té", max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NEAR_MISSES, min_size=40, max_size=60))
def test_shortcuts_change_no_match(spark, texts):
    """Each guarded expression against the bare pattern, on texts full of near misses."""
    pieces = ["a@b.co", "(555) 123-4567", "1.2.3.4", "1111222233334444", "ERR-404", "$1,2", "2024-01-01", " good", "best "]
    rows = [(t + pieces[i % len(pieces)] * (i % 3) + t[:5],) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "text string")
    text = F.col("text")
    bare = {
        "email": fixed.EMAIL, "phone": fixed.PHONE, "date": fixed.DATE,
        "order_ref": fixed.ORDER_REF, "ip_address": fixed.IP_ADDRESS, "amount": fixed.AMOUNT,
        "error_code": fixed.ERROR_CODE,
    }
    got = extract.extract_features(df).withColumns(
        {f"bare_{n}": F.regexp_extract(text, p, 1) for n, p in bare.items()}
        | {
            "bare_has_cc": F.when(text.rlike(fixed.CARD), "YES").otherwise("NO"),
            "bare_masked_text": F.regexp_replace(text, fixed.CARD, fixed.CARD_MASK),
            "words": word_count(text),
            "bare_words": F.size(F.split(text, " ")),
            "good": has_positive(text),
            "bare_good": F.when(text.rlike(r"\b(great|good|excellent|amazing|best)\b"), 1).otherwise(0),
        }
    )
    for row in got.collect():
        assert (row.words, row.good) == (row.bare_words, row.bare_good), row.text
        for name in [*bare, "has_cc", "masked_text"]:
            assert row[name] == row[f"bare_{name}"], (name, row.text)


def test_long_run_without_at_sign_after_it_is_read_once(spark):
    """A text that takes the bare address pattern quadratic time."""
    df = spark.createDataFrame([("@ " + "a" * 300_000,)], "text string")
    assert extract.extract_features(df).select("email").first().email == ""


FEATURES = [
    ("a  b ", 5, 4, 1, 5 / 4, 0, 0, 0),
    ("A. B.", 5, 2, 3, 5 / 2, 0, 0, 0),
    ("", 0, 1, 1, 0.0, 0, 0, 0),
    (None, None, None, None, 0.0, 0, 0, 0),
    ("a great day", 11, 3, 1, 11 / 3, 1, 0, 1),
    ("égreat", 6, 1, 1, 6.0, 0, 0, 0),
    ("greatest badly", 14, 2, 1, 7.0, 0, 0, 0),
    ("Great but awful", 15, 3, 1, 5.0, 0, 1, -1),
    ("best, worst", 11, 2, 1, 5.5, 1, 1, 0),
]


def test_features_by_hand(spark):
    df = spark.createDataFrame([(r[0],) for r in FEATURES], "text string")
    got = text_features(df).collect()
    assert [tuple(r) for r in got] == FEATURES


def test_null_length_has_no_category(spark):
    df = spark.createDataFrame([(None,), (50,), (100,), (499,), (500,)], "n int")
    counts = aggregates.category_counts(df, "n", *fixed.LENGTH_3)
    assert {r.category: r["count"] for r in counts.collect()} == {
        None: 1, "Short": 1, "Medium": 2, "Long": 1
    }


def test_buckets_need_one_more_label_than_bounds():
    with pytest.raises(ValueError):
        labels.bucketize(None, (1, 2), ("a", "b"))


def test_sentiment_label_both_ways(spark):
    rows = [(0, None), (1, math.nan), (2, 0.0), (3, -1.0), (4, 1.0), (5, math.inf)]
    df = spark.createDataFrame(rows, "id int, score double")
    expected = [None, "neutral", "neutral", "negative", "positive", "positive"]
    for label in (labels.sentiment_category, labels.sentiment_category_python):
        got = df.withColumn("label", label(F.col("score"))).orderBy("id").collect()
        assert [r.label for r in got] == expected


def test_sentiment_label_of_whole_numbers(spark):
    df = spark.createDataFrame([(None,), (0,), (-3,), (7,)], "score int")
    for label in (labels.sentiment_category, labels.sentiment_category_python):
        got = df.withColumn("label", label(F.col("score"))).collect()
        assert [r.label for r in got] == [None, "neutral", "negative", "positive"]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 3, 3, 9, 9, 1, None, None]], "v int")
    top = frequency.top_values(df, "v", 3).collect()
    assert [(r.v, r["count"]) for r in top] == [(None, 2), (3, 2), (5, 2)]


def test_mode_on_a_tie_is_the_smaller_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "v string")
    row = frequency.mode_of(df, "v").first()
    assert (row.mode, row.mode_frequency, row.percent) == ("a", 2, 40.0)


def test_five_aggregates_by_hand(spark):
    rows = [("good one",), ("x" * 100,), ("x" * 600,), (None,), ("a b",), ("c d",)]
    df = spark.createDataFrame(rows, "text string")
    got = {(r.metric, r.key): r.value for r in aggregates.five_aggregates(df, k=2).collect()}
    assert got == {
        ("avg_length", None): pytest.approx((8 + 100 + 600 + 3 + 3) / 5),
        ("positive_count", None): 1.0,
        ("word_count", "2"): 3.0,
        ("word_count", "1"): 2.0,
        ("review_length", "3"): 2.0,
        ("review_length", None): 1.0,
        ("length_category", "Short"): 3.0,
        ("length_category", "Medium"): 1.0,
        ("length_category", "Long"): 1.0,
        ("length_category", None): 1.0,
    }
