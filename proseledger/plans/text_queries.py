"""Queries over text: features, aggregates, frequencies, extraction and masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.extract import extract_features, extraction_stats, masked_view
from ..functions.labels import bucketize
from ..functions.text import text_features, word_count
from ..operators import aggregates, frequency
from ..sources.roles import find_text_column
from ..sources.tables import from_rows
from .query import Query, comparable, table

FEATURES = [
    "review_length", "word_count", "sentence_count", "avg_word_length",
    "has_positive", "has_negative", "sentiment_score",
]

# Java counts accented letters as word characters, so its \b does not see a
# boundary next to one. DuckDB's \b is ASCII; this spells the Java rule out.
_EDGE = r"[^\p{L}\p{N}_]"
POSITIVE_SQL = rf"(^|{_EDGE})({'|'.join(fixed.POSITIVE_WORDS)})($|{_EDGE})"
NEGATIVE_SQL = rf"(^|{_EDGE})({'|'.join(fixed.NEGATIVE_WORDS)})($|{_EDGE})"


def features_sql(source: str, key: str) -> str:
    """A SELECT with the key, the text and its features."""
    return f"""
        SELECT *, has_positive - has_negative AS sentiment_score,
               CASE WHEN word_count > 0 THEN review_length / CAST(word_count AS DOUBLE)
                    ELSE 0.0 END AS avg_word_length
        FROM (
            SELECT {key}, text,
                   CAST(length(text) AS BIGINT) AS review_length,
                   CAST(len(string_split(text, ' ')) AS BIGINT) AS word_count,
                   CAST(len(string_split_regex(text, '{fixed.SENTENCE_END}')) AS BIGINT)
                       AS sentence_count,
                   CAST(CASE WHEN regexp_matches(text, '{POSITIVE_SQL}') THEN 1 ELSE 0 END
                        AS BIGINT) AS has_positive,
                   CAST(CASE WHEN regexp_matches(text, '{NEGATIVE_SQL}') THEN 1 ELSE 0 END
                        AS BIGINT) AS has_negative
            FROM ({source})
        )"""


DOCUMENT_FEATURES_SQL = features_sql("SELECT * FROM documents", "doc_id")


def order_text() -> Column:
    """Text with an order reference, an amount, a date, an error code and a word of praise
    or blame, composed from an order; which of them a row has depends on its key."""
    key, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")

    def padded(number: Column, width: int) -> Column:
        return F.lpad(number.cast("string"), width, "0")

    grouped = F.concat(
        F.lit(" Amount: $"), F.floor(price / 1000).cast("string"), F.lit(","),
        padded(price % 1000, 3), F.lit("."), padded(key % 100, 2),
    )
    amount = (
        F.when(key % 5 == 0, "")
        .when(key % 5 == 1, grouped)
        .otherwise(F.concat(F.lit(" Amount: $"), price.cast("string")))
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return F.concat(
        F.when(key % 4 == 0, "Invoice INV-").otherwise("Order #ORD-"),
        padded(key, 6),
        amount,
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit(" Date: "), day)),
        F.when(key % 6 == 0, "").otherwise(F.concat(F.lit(" Error: ERR-"), padded(key % 1000, 3))),
        F.when(key % 3 == 0, " bad").when(key % 3 == 1, " good").otherwise(" fine"),
    )


ORDER_TEXT_SQL = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 = 0 THEN 'Invoice INV-' ELSE 'Order #ORD-' END
           || lpad(CAST(o_orderkey AS VARCHAR), 6, '0')
           || CASE o_orderkey % 5
                WHEN 0 THEN ''
                WHEN 1 THEN ' Amount: $' || CAST(price // 1000 AS VARCHAR) || ','
                            || lpad(CAST(price % 1000 AS VARCHAR), 3, '0') || '.'
                            || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
                ELSE ' Amount: $' || CAST(price AS VARCHAR) END
           || CASE WHEN o_orderkey % 11 = 0 THEN ''
                   ELSE ' Date: ' || strftime(o_orderdate, '%Y-%m-%d') END
           || CASE WHEN o_orderkey % 6 = 0 THEN ''
                   ELSE ' Error: ERR-' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END
           || CASE o_orderkey % 3 WHEN 0 THEN ' bad' WHEN 1 THEN ' good' ELSE ' fine' END
           AS text
    FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders)"""

FIELDS_SQL = f"""
    regexp_extract(text, '{fixed.EMAIL}', 1) AS email,
    regexp_extract(text, '{fixed.PHONE}', 1) AS phone,
    regexp_extract(text, '{fixed.DATE}', 1) AS date,
    regexp_extract(text, '{fixed.ORDER_REF}', 1) AS order_ref,
    regexp_extract(text, '{fixed.IP_ADDRESS}', 1) AS ip_address,
    regexp_extract(text, '{fixed.AMOUNT}', 1) AS amount,
    regexp_extract(text, '{fixed.ERROR_CODE}', 1) AS error_code,
    CASE WHEN regexp_matches(text, '{fixed.CARD}') THEN 'YES' ELSE 'NO' END AS has_cc"""

_STAT_FIELDS = ["email", "phone", "date", "order_ref", "ip_address", "amount", "error_code"]


def stats_sql(source: str) -> str:
    """Hits per field, one SELECT for each."""
    parts = [
        f"SELECT '{f}' AS field, count(*) AS total, count(*) FILTER ({f} <> '') AS hits FROM x"
        for f in _STAT_FIELDS
    ]
    parts.append(
        "SELECT 'card' AS field, count(*) AS total, count(*) FILTER (has_cc = 'YES') AS hits FROM x"
    )
    return (
        f"WITH x AS (SELECT {FIELDS_SQL} FROM ({source})) "
        "SELECT field, total, hits, round(hits / CAST(total AS DOUBLE), 6) AS rate "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def order_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", order_text().alias("text"))


def run_text_features(spark, folder):
    return comparable(text_features(documents(spark, folder)).select("doc_id", *FEATURES))


def run_top(column: str):
    def run(spark, folder):
        features = text_features(documents(spark, folder))
        return comparable(frequency.top_values(features, column))

    return run


def run_categories(bounds, labels):
    def run(spark, folder):
        lengths = documents(spark, folder).select(F.length("text").alias("review_length"))
        return aggregates.category_counts(lengths, "review_length", bounds, labels)

    return run


def run_all_categories(spark, folder):
    """Every category of a given list, also those no document falls in."""
    bounds, labels = fixed.LENGTH_5
    listed = from_rows(spark, list(enumerate(labels)), "place int, category string")
    length = F.length("text")
    counted = documents(spark, folder).groupBy(
        bucketize(length, bounds, labels).alias("category")
    ).agg(F.count("*").alias("count"))
    # One row per label on either side.
    return comparable(
        listed.join(F.broadcast(counted), "category", "left").select(
            "place", "category", F.coalesce("count", F.lit(0)).alias("count")
        )
    )


def run_text_column(spark, folder):
    """The text column by its name, under its usual new name."""
    df = documents(spark, folder)
    df = df.withColumnRenamed(find_text_column(df), "review_text")
    return df.select("doc_id", F.md5("review_text").alias("text_md5"))


def run_conversations(spark, folder):
    """The sentiment summary of the conversations, whose text column is found by its name."""
    df = table(spark, folder, "conversations")
    return comparable(aggregates.sentiment_summary(df, find_text_column(df)))


def run_predicates(spark, folder):
    """Equality, inequality, half-open range, NULL tests and their conjunction."""
    df = documents(spark, folder).withColumn("words", word_count(F.col("text")))
    kept = df.where(
        (F.col("lang") == "en")
        & (F.col("text") != "")
        & (F.col("words") >= 10)
        & (F.col("words") < 200)
        & F.col("source").isNotNull()
        & ~F.col("text").isNull()
    )
    return comparable(kept.select("doc_id", "source", "words"))


def run_extract(spark, folder):
    return extract_features(documents(spark, folder)).select(
        "doc_id", *_STAT_FIELDS, "has_cc", F.md5("masked_text").alias("masked_md5")
    )


def run_extract_orders(spark, folder):
    found = text_features(extract_features(order_texts(spark, folder)))
    return comparable(
        found.select(
            "o_orderkey", "text", *_STAT_FIELDS, "has_cc", "has_positive", "has_negative",
            "sentiment_score",
        )
    )


FIVE_SQL = f"""
    WITH f AS ({DOCUMENT_FEATURES_SQL}),
    words AS (SELECT word_count AS k, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, k LIMIT 10),
    lengths AS (SELECT review_length AS k, count(*) AS n FROM f GROUP BY 1
                ORDER BY n DESC, k LIMIT 10)
    SELECT 'avg_length' AS metric, CAST(NULL AS VARCHAR) AS key,
           round(avg(review_length), 6) AS value FROM f
    UNION ALL SELECT 'positive_count', NULL, CAST(sum(has_positive) AS DOUBLE) FROM f
    UNION ALL SELECT 'word_count', CAST(k AS VARCHAR), CAST(n AS DOUBLE) FROM words
    UNION ALL SELECT 'review_length', CAST(k AS VARCHAR), CAST(n AS DOUBLE) FROM lengths
    UNION ALL SELECT 'length_category',
           CASE WHEN review_length < 100 THEN 'Short' WHEN review_length < 500 THEN 'Medium'
                ELSE 'Long' END, CAST(count(*) AS DOUBLE) FROM f GROUP BY 2"""

LENGTH_5_SQL = """
    CASE WHEN length(text) < 100 THEN 'Very Short' WHEN length(text) < 300 THEN 'Short'
         WHEN length(text) < 700 THEN 'Medium' WHEN length(text) < 1500 THEN 'Long'
         ELSE 'Very Long' END"""


def top_sql(column: str) -> str:
    return f"""
        SELECT {column}, count(*) AS count FROM ({DOCUMENT_FEATURES_SQL})
        GROUP BY 1 ORDER BY count DESC, {column} LIMIT 10"""


QUERIES = {
    "sentiment_summary": Query(
        lambda spark, folder: comparable(aggregates.sentiment_summary(documents(spark, folder))),
        f"""SELECT has_positive, round(avg(review_length), 6) AS avg_length,
                   count(*) AS review_count, round(avg(word_count), 6) AS avg_words
            FROM ({DOCUMENT_FEATURES_SQL}) WHERE review_length > 50 GROUP BY 1 ORDER BY 1""",
    ),
    "sentiment_summary_conversations": Query(
        run_conversations,
        f"""SELECT has_positive, round(avg(review_length), 6) AS avg_length,
                   count(*) AS review_count, round(avg(word_count), 6) AS avg_words
            FROM ({features_sql("SELECT * FROM conversations", "conv_id")})
            WHERE review_length > 50 GROUP BY 1""",
    ),
    "text_features": Query(
        run_text_features,
        f"""SELECT doc_id, review_length, word_count, sentence_count,
                   round(avg_word_length, 6) AS avg_word_length, has_positive, has_negative,
                   sentiment_score FROM ({DOCUMENT_FEATURES_SQL})""",
    ),
    "average_length": Query(
        lambda spark, folder: comparable(aggregates.average_length(documents(spark, folder))),
        "SELECT round(avg(length(text)), 6) AS avg_length FROM documents",
    ),
    "positive_count": Query(
        lambda spark, folder: aggregates.positive_count(documents(spark, folder)),
        f"""SELECT count(*) AS positive_count FROM documents
            WHERE regexp_matches(text, '{POSITIVE_SQL}')""",
    ),
    "length_summary": Query(
        lambda spark, folder: comparable(aggregates.length_summary(documents(spark, folder))),
        """SELECT count(*) AS total_reviews, round(avg(length(text)), 6) AS avg_length,
                  CAST(min(length(text)) AS BIGINT) AS min_length,
                  CAST(max(length(text)) AS BIGINT) AS max_length FROM documents""",
    ),
    "top_word_counts": Query(run_top("word_count"), top_sql("word_count")),
    "top_lengths": Query(run_top("review_length"), top_sql("review_length")),
    "length_categories": Query(
        run_categories(*fixed.LENGTH_3),
        """SELECT CASE WHEN length(text) < 100 THEN 'Short' WHEN length(text) < 500 THEN 'Medium'
                       ELSE 'Long' END AS category, count(*) AS count
           FROM documents GROUP BY 1""",
    ),
    "length_categories_5": Query(
        run_categories(*fixed.LENGTH_5),
        f"SELECT {LENGTH_5_SQL} AS category, count(*) AS count FROM documents GROUP BY 1",
    ),
    "length_categories_listed": Query(
        run_all_categories,
        f"""SELECT CAST(place AS BIGINT) AS place, category, coalesce(n, 0) AS count
            FROM (VALUES (0, 'Very Short'), (1, 'Short'), (2, 'Medium'), (3, 'Long'),
                         (4, 'Very Long')) AS v(place, category)
            LEFT JOIN (SELECT {LENGTH_5_SQL} AS category, count(*) AS n
                       FROM documents GROUP BY 1) USING (category)""",
    ),
    "five_aggregates": Query(
        lambda spark, folder: comparable(aggregates.five_aggregates(documents(spark, folder))),
        FIVE_SQL,
    ),
    "word_frequency": Query(
        lambda spark, folder: frequency.word_frequency(documents(spark, folder)),
        """SELECT word, count(*) AS count
           FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1""",
    ),
    "text_column": Query(
        run_text_column, "SELECT doc_id, md5(text) AS text_md5 FROM documents"
    ),
    "predicates": Query(
        run_predicates,
        """SELECT doc_id, source, words FROM (
               SELECT *, CAST(len(string_split(text, ' ')) AS BIGINT) AS words FROM documents)
           WHERE lang = 'en' AND text <> '' AND words >= 10 AND words < 200
             AND source IS NOT NULL AND text IS NOT NULL""",
    ),
    "distinct_rows": Query(
        lambda spark, folder: documents(spark, folder).select("lang", "source").distinct(),
        "SELECT DISTINCT lang, source FROM documents",
    ),
    "row_count": Query(
        lambda spark, folder: documents(spark, folder).agg(F.count("*").alias("total_rows")),
        "SELECT count(*) AS total_rows FROM documents",
    ),
    "preview": Query(
        lambda spark, folder: documents(spark, folder)
        .select("doc_id", "lang", "source", "text").orderBy("doc_id").limit(5),
        "SELECT doc_id, lang, source, text FROM documents ORDER BY doc_id LIMIT 5",
    ),
    "extract_features": Query(
        run_extract,
        f"""SELECT doc_id, {FIELDS_SQL},
                   md5(regexp_replace(text, '{fixed.CARD}', '{fixed.CARD_MASK}', 'g'))
                       AS masked_md5 FROM documents""",
    ),
    "extract_order_fields": Query(
        run_extract_orders,
        f"""SELECT o_orderkey, text, {FIELDS_SQL}, has_positive, has_negative, sentiment_score
            FROM ({features_sql(ORDER_TEXT_SQL, "o_orderkey")})""",
    ),
    "mask_cards": Query(
        lambda spark, folder: masked_view(documents(spark, folder), "doc_id"),
        f"""SELECT doc_id, text,
                   regexp_replace(text, '{fixed.CARD}', '{fixed.CARD_MASK}', 'g') AS masked_text
            FROM documents WHERE regexp_matches(text, '{fixed.CARD}')""",
    ),
    "extraction_stats": Query(
        lambda spark, folder: comparable(extraction_stats(documents(spark, folder))),
        stats_sql("SELECT * FROM documents"),
    ),
    "extraction_stats_orders": Query(
        lambda spark, folder: comparable(extraction_stats(order_texts(spark, folder))),
        stats_sql(ORDER_TEXT_SQL),
    ),
}
