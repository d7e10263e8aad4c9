"""Numbers derived from one text column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed


def word_count(text: Column) -> Column:
    """Pieces of a split on single spaces: runs of spaces add empty words, '' has one.

    That is the number of spaces plus one, and a space is one byte, so no array of
    words is built and nothing is decoded.
    """
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def sentence_count(text: Column) -> Column:
    """Pieces of a split on runs of . ! ? (a closing mark adds one empty piece)."""
    return F.size(F.split(text, fixed.SENTENCE_END))


def contains_any(text: Column, literals: Sequence[str]) -> Column:
    """Whether any of the literals occurs, found without a regular expression."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in literals])


def has_word(text: Column, words: Sequence[str]) -> Column:
    """1 where one of the words occurs as a whole word, else 0 (also for NULL text).

    Most texts hold none of them even as part of a word, which a substring search
    tells much sooner; only the rest are matched.
    """
    whole = text.rlike(rf"\b({'|'.join(words)})\b")
    return F.when(contains_any(text, words) & whole, 1).otherwise(0)


def has_positive(text: Column) -> Column:
    return has_word(text, fixed.POSITIVE_WORDS)


def has_negative(text: Column) -> Column:
    return has_word(text, fixed.NEGATIVE_WORDS)


def text_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add length, word and sentence counts, mean word length and the sentiment flags."""
    column = F.col(text)
    length, words = F.length(column), word_count(column)
    return df.withColumns(
        {
            "review_length": length,
            "word_count": words,
            "sentence_count": sentence_count(column),
            "avg_word_length": F.when(words > 0, length / words).otherwise(0.0),
            "has_positive": has_positive(column),
            "has_negative": has_negative(column),
            "sentiment_score": has_positive(column) - has_negative(column),
        }
    )
