"""Quality rules: base counts per text, and distance of its histograms from its language's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CLASS, settled, store

# Classes of characters, in the order in which they are taken out of a text.
CLASSES = [
    ("ascii_lower", r"[a-z]+"),
    ("other_lower", r"\p{Ll}+"),
    ("space", r"[\x20\x09-\x0D]+"),
    ("upper", r"\p{Lu}+"),
    ("digit", r"\p{Nd}+"),
    ("punctuation", r"[.,;:'\"?!-]+"),
]


def words_of(text: Column) -> Column:
    """The words of a text: what lies between runs of space and 0x09-0x0D."""
    trimmed = F.trim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+")
    )


def with_repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words that lie in a 3-word window found twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts with a repeated window
    sort theirs; equal hashes are then neighbours.
    """
    n = F.size(words)
    grams = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    df = df.withColumn("_grams", grams)
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    df = df.withColumn(
        "_sorted",
        F.when(
            repeated,
            F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )

    def is_twice(x: Column, i: Column) -> Column:
        same = lambda j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
        return same(i - 1) | same(i + 1)

    places = F.sort_array(F.transform(F.filter("_sorted", is_twice), lambda x: x["i"]))
    df = df.withColumn("_places", places)
    # A window adds the words up to the next one, three at most.
    added = F.transform(
        "_places",
        lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_places", i + 1) - p, F.lit(3))),
    )
    total = F.aggregate(added, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("bigint"))).drop(
        "_grams", "_sorted", "_places"
    )


def _with_class_counts(df: DataFrame, text: str) -> DataFrame:
    """Add ``_class_counts``: characters per class, those of no class last.

    Each class is taken out of what the classes before have left, so after the
    first the expressions see a short rest only.
    """
    names, left = [], text
    for name, pattern in CLASSES:
        df = df.withColumn(f"_left_{name}", F.regexp_replace(left, pattern, ""))
        df = df.withColumn(f"_n_{name}", F.length(left) - F.length(f"_left_{name}"))
        names.append(f"_n_{name}")
        left = f"_left_{name}"
    counts = F.array(*[F.col(n).cast("double") for n in names], F.length(left).cast("double"))
    return df.withColumn("_class_counts", counts).drop(
        *names, *[f"_left_{name}" for name, _ in CLASSES]
    )


def _share(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / total)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root, base 2) of two arrays of shares: 0 alike, 1 disjoint."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: (half(a, b) + half(b, a)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def language_references(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", n_common: int = 32
) -> DataFrame:
    """One row per language, from all its texts: shares of character classes, its commonest words.

    Columns ``_lang, _ref_classes, _common, _ref_common`` (the last has one more
    share, that of all other words), and ``_longest``, the bytes of the longest
    common word. Words count as they are written, so shouted ones are others.
    """
    base = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    words = (
        base.select("_lang", F.explode(words_of(F.col("_text"))).alias("_word"))
        .groupBy("_lang", "_word")
        .agg(F.count("*").alias("_n"))
    )
    words = store(words, "word_counts")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("_n"), "_word"))
    common = (
        words.withColumn("_rank", rank)
        .where(F.col("_rank") <= n_common)
        .groupBy("_lang")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "_word", "_n"))).alias("_top"))
    )
    sizes = words.groupBy("_lang").agg(F.sum("_n").alias("_n_words"))
    classes = _with_class_counts(base, "_text").groupBy("_lang").agg(
        *[F.sum(F.get("_class_counts", F.lit(i))).alias(f"_c{i}") for i in range(len(CLASSES) + 1)]
    )
    counts = F.array(*[F.col(f"_c{i}") for i in range(len(CLASSES) + 1)])
    n_chars = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    top_shares = F.transform("_top", lambda x: x["_n"] / F.col("_n_words"))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate(top_shares, F.lit(0.0), lambda a, x: a + x))
    return (
        classes.withColumn("_counts", counts)
        .withColumn("_n_chars", n_chars)
        .join(common, "_lang")
        .join(sizes, "_lang")
        .select(
            "_lang",
            _share(F.col("_counts"), F.col("_n_chars")).alias("_ref_classes"),
            F.transform("_top", lambda x: x["_word"]).alias("_common"),
            F.array_max(F.transform("_top", lambda x: F.octet_length(x["_word"]))).alias("_longest"),
            F.concat(top_shares, F.array(rest)).alias("_ref_common"),
        )
    )


def quality_rules(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    n_common: int = 32,
    max_class_distance: float = 0.25,
    max_word_distance: float = 0.45,
    guard_words: int = 100,
) -> DataFrame:
    """Add counts, distances and the verdict ``kept`` to every row.

    Base: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    ``base_failed`` (too few words, or too many in repeated 3-word windows).
    Method: the Jensen-Shannon distances of the text's character classes
    (``class_distance``) and common words (``word_distance``) from those of all
    texts in its language. A text that is further off than allowed is not kept.
    The histograms of short texts are noisy: below ``guard_words`` words the
    allowed distances widen with the noise, one by the square root of the words.

    NULL text counts as empty: no words, base_failed. Rows with a NULL language
    are a language of their own. A text without characters or words has NULL
    distances. Repeated rows get equal results; an empty table gives an empty
    result. All columns of the table are kept, and those named like an added
    one are replaced.

    The references have one row per language and are joined with no hint: the
    optimizer broadcasts them by their size on disk.
    """
    references = store(language_references(df, text_col, lang_col, n_common), "references")
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "class_distance", "word_distance", "kept"]
    kept = [c for c in df.columns if c not in added]
    df = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_key"),
    )
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = df.withColumn("_words", words_of(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), has_word)
    )
    df = df.select(
        "_row", "_key", "_text", "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    df = with_repeat_words(df, "_words", "n_repeat_words")
    df = _with_class_counts(df, "_text")
    df = df.withColumn("_n_chars", F.length("_text")).join(
        references, F.col("_key") == F.col("_lang"), "left"
    )
    is_common = lambda w: (F.octet_length(w) <= F.col("_longest")) & F.array_contains("_common", w)
    df = df.withColumn("_hits", F.filter("_words", is_common))
    hits = F.transform(
        "_common",
        lambda c: (F.size("_hits") - F.size(F.array_remove("_hits", c))).cast("double"),
    )
    rest = (F.col("n_words") - F.size("_hits")).cast("double")
    df = df.withColumn("_counts", F.concat(hits, F.array(rest)))
    class_distance = F.when(
        F.col("_n_chars") > 0,
        js_distance(_share(F.col("_class_counts"), F.col("_n_chars")), F.col("_ref_classes")),
    )
    word_distance = F.when(
        F.col("n_words") > 0,
        js_distance(_share(F.col("_counts"), F.col("n_words")), F.col("_ref_common")),
    )
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    noise = 1 / F.sqrt(F.greatest("n_words", F.lit(1)))
    wider = F.greatest(noise - 1 / max(1, guard_words) ** 0.5, F.lit(0.0))
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance + wider) | (
        F.coalesce("word_distance", F.lit(0.0)) > max_word_distance + wider
    )
    df = (
        df.withColumn("class_distance", class_distance)
        .withColumn("word_distance", word_distance)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~far)
    )
    return settled(df, ["_row"], added).select("_row.*", *added)
