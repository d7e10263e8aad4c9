"""Personal data: patterns propose spans, checksums confirm them, context scores them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

_ADDRESS = r"A-Za-z0-9._%+-"
# A run of digits or address characters is tried from its start only, or from where the
# match before it ended: later starts in a run fail as the first did. Possessive
# quantifiers where nothing could be given back. Neither changes a match.
PATTERNS = {
    "email": rf"(?:(?<![{_ADDRESS}])|\G)[{_ADDRESS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+A-Za-z])(?<!\+[0-9] )(?<!\+[0-9]{2} )(?<!\+[0-9]{3} )\([0-9]{3}\)[\x20-]?[0-9]{3}[\x20-][0-9]{4}(?![0-9])",
    "secret": r"(?i)(?<![A-Za-z0-9_])(?:password|passwd|api_key|apikey|secret|token)\x20?[=:]\x20?[\"']?[A-Za-z0-9_+/.-]{8,}",
}
# A text without this has no match; these are much cheaper to test.
POSSIBLE = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "local_phone": lambda t: t.contains("("),
    "secret": lambda t: t.contains("=") | t.contains(":"),
}
KINDS = list(PATTERNS)
BASE_KINDS = KINDS[:4]
# Confidence of a confirmed span, and what a context word within reach adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.5,
          "secret": 0.6}
CONTEXT = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|address|host|server",
    "card": r"(?i)card|visa|master|credit|payment",
    "phone": r"(?i)phone|call|tel|mobile|fax",
    "iban": r"(?i)iban|account|bank",
    "local_phone": r"(?i)phone|call|tel|mobile|fax",
    "secret": r"(?i)login|user|key|credential|config",
}
CONTEXT_BONUS = 0.1
CONTEXT_CHARS = 40
MIN_SCORE = 0.5

_CHUNK = 256


def _running(numbers: Column, first: Column) -> Column:
    """Inclusive running sums of an array, from ``first``."""
    start = F.struct(first.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all"))

    def add(state: Column, x: Column) -> Column:
        at = state["at"] + x
        return F.struct(at.alias("at"), F.concat(state["all"], F.array(at)).alias("all"))

    return F.aggregate(numbers, start, add, lambda state: state["all"])


def running_sums(numbers: Column) -> Column:
    """Inclusive running sums in time linear in the array.

    Building an array by appending copies it each time; so sums run inside
    chunks of bounded length, from the sums of the chunks before.
    """
    n = F.size(numbers)
    zero = F.lit(0).cast("bigint")
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK).cast("int")),
        lambda k: F.slice(numbers, k * _CHUNK + 1, F.lit(_CHUNK)),
    )
    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
    befores = F.concat(F.array(zero), _running(totals, zero))
    whole = F.flatten(F.zip_with(chunks, F.slice(befores, 1, F.size(chunks)),
                                 lambda c, first: _running(c, first)))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(
        n <= _CHUNK, _running(numbers, zero)
    ).otherwise(whole)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda total, i: total
        + F.when((n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                  F.substring(digits, i, F.lit(1)).cast("int"))
        ),
    )
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN without blanks has the remainder 1."""
    moved = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    digits = F.transform(
        F.split(moved, ""),
        lambda c: F.when(c.rlike("[0-9]"), c).when(c == "", c).otherwise(
            (F.ascii(c) - 55).cast("string")
        ),
    )
    remainder = F.aggregate(
        F.split(F.array_join(digits, ""), ""),
        F.lit(0),
        lambda a, d: F.when(d == "", a).otherwise((a * 10 + d.cast("int")) % 97),
    )
    return remainder == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.|$)){4}$")
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        code = F.regexp_replace(found, " ", "")
        return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(F.lit(False))
    return F.lit(True)


def _spans(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Add ``_kind``: the confirmed spans, as structs of start, order, end, kind and score.

    What a pattern matches and what lies between the matches give the places: a
    match ends at the sum of the lengths up to it.
    """
    possible, pattern = POSSIBLE[kind](F.col(text)), PATTERNS[kind]
    df = df.withColumn(
        "_found", F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    )
    some = F.size("_found") > 0
    df = df.withColumn("_between", F.when(some, F.split(text, pattern)))
    steps = F.transform("_found", lambda m, i: F.length(m) + F.length(F.get("_between", i)))
    df = df.withColumn("_steps", F.when(some, steps))
    df = df.withColumn("_ends", F.when(some, running_sums(F.col("_steps"))))

    def span(found: Column, i: Column) -> Column:
        end = F.get("_ends", i)
        start = end - F.length(found)
        before = F.greatest(start - CONTEXT_CHARS, F.lit(0))
        near = F.substring(text, (before + 1).cast("int"),
                           (end - before + CONTEXT_CHARS).cast("int"))
        score = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), end.alias("end"),
            F.lit(kind).alias("kind"), score.alias("score"), _valid(kind, found).alias("valid"),
        )

    all_spans = F.filter(F.transform("_found", span), lambda s: s["valid"])
    if kind not in BASE_KINDS:
        all_spans = F.filter(all_spans, lambda s: s["score"] >= MIN_SCORE)
    kind_type = "array<struct<start:bigint,order:int,end:bigint,kind:string,score:double,valid:boolean>>"
    empty = F.array().cast(kind_type)
    return df.withColumn(
        f"_{kind}", F.when(some, all_spans.cast(kind_type)).otherwise(empty)
    ).drop("_found", "_between", "_steps", "_ends")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                 s["end"].cast("string"))), ","
    )


def find_personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the spans of personal data in every whole text.

    ``pii_spans``: array of structs (start, order, end, kind, score, valid) in
    code points, end exclusive, ordered by start, then by kind as listed in
    ``KINDS``. Patterns find leftmost matches that don't overlap, per kind;
    Luhn, mod-97, digit counts and number ranges confirm them, and a match that
    fails is dropped without a retry. The score is the kind's, and more with a
    context word within 40 code points. Spans of the base kinds always stay,
    those of other kinds from ``MIN_SCORE`` on. ``pii_base``: those of the base
    kinds only.

    A NULL or empty text has empty arrays. Repeated rows get equal results. All
    columns stay; columns with the two new names are replaced.
    """
    kept = [c for c in df.columns if c not in ("pii_spans", "pii_base")]
    out = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    for kind in KINDS:
        out = _spans(out, "_text", kind)
    all_spans = F.sort_array(F.concat(*[F.col(f"_{kind}") for kind in KINDS]))
    out = out.withColumn("pii_spans", all_spans)
    base = F.filter("pii_spans", lambda s: s["order"] < len(BASE_KINDS))
    new = ["pii_spans", "pii_base"]
    return settled(out.withColumn("pii_base", base), ["_row"], new).select("_row.*", *new)
