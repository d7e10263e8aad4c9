"""Fields found in free text by pattern, with built-in functions only.

A regular expression is by far the dearest thing these queries do to a row, so
each one runs only on texts that pass a cheaper test which no text with a match
can fail. Texts that fail it get the same answer at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .text import contains_any


def _holds(*literals: str) -> Callable[[Column], Column]:
    return lambda text: contains_any(text, literals)


def _has(pattern: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(pattern)


# Field -> (pattern, test that every text with a match passes).
FIELDS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    # The look-behind lets a match start only where a run of address characters
    # starts. The leftmost match starts there anyway, and without it a long run
    # with no "@" after it is rescanned from each of its characters.
    "email": (r"(?<![a-zA-Z0-9._%+-])" + fixed.EMAIL, _holds("@")),
    "phone": (fixed.PHONE, _holds("(")),
    "date": (fixed.DATE, _holds("-")),
    "order_ref": (fixed.ORDER_REF, _holds("Order", "Invoice", "INV")),
    "ip_address": (fixed.IP_ADDRESS, _has(r"\d\.\d")),
    "amount": (fixed.AMOUNT, _holds("$")),
    "error_code": (fixed.ERROR_CODE, _holds("ERR", "Error")),
}
_EIGHT_DIGITS = _has(r"\d{4}[-\s]?\d{4}")


def first_match(text: Column, pattern: str, possible: Callable[[Column], Column]) -> Column:
    """Group 1 of the first match; '' where there is none, NULL for NULL text."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(possible(text), found).when(text.isNotNull(), F.lit(""))


def has_card(text: Column) -> Column:
    """'YES' where the text holds a 16-digit card number, else 'NO' (also for NULL text)."""
    return F.when(_EIGHT_DIGITS(text) & text.rlike(fixed.CARD), "YES").otherwise("NO")


def mask_cards(text: Column) -> Column:
    """The text with every card number replaced by the fixed mask."""
    masked = F.regexp_replace(text, fixed.CARD, fixed.CARD_MASK)
    return F.when(_EIGHT_DIGITS(text), masked).otherwise(text)


def extract_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the seven extracted fields, the card flag and the masked text."""
    column = F.col(text)
    fields = {name: first_match(column, *how) for name, how in FIELDS.items()}
    return df.withColumns(
        {**fields, "has_cc": has_card(column), "masked_text": mask_cards(column)}
    )


def masked_view(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows with a card number: key, text and masked text. Only these rows are masked."""
    column = F.col(text)
    return df.where(has_card(column) == "YES").select(
        key, text, mask_cards(column).alias("masked_text")
    )


def extraction_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Per field: rows in all, rows with a hit, share of rows with a hit.

    One scan and one aggregate for all fields. The card flag counts as 'card'.
    """
    column = F.col(text)
    hits = {
        name: F.count_if(first_match(column, *how) != "") for name, how in FIELDS.items()
    }
    hits["card"] = F.count_if(has_card(column) == "YES")
    counted = df.agg(F.count("*").alias("total"), *[c.alias(n) for n, c in hits.items()])
    rows = [F.struct(F.lit(n).alias("field"), F.col(n).alias("hits")) for n in hits]
    return counted.select("total", F.inline(F.array(*rows))).select(
        "field", "total", "hits", F.try_divide("hits", "total").alias("rate")
    )
