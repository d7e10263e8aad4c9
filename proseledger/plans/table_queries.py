"""Queries about reading, writing, labelling and checking whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import sentiment_category, sentiment_category_python
from ..operators.aggregates import (
    average_length,
    category_counts,
    five_aggregates,
    positive_count,
    sentiment_summary,
)
from ..functions import fixed
from ..functions.text import text_features
from ..operators.frequency import top_values
from ..operators.reconcile import reconcile
from ..operators.windows import running_sum
from ..sources.roles import with_roles
from ..sources.shared import new_path
from ..sources.synthetic import row_key, with_synthetic_columns
from ..sources.tables import read_csv, read_or_default, read_table, write_csv, write_json, write_text
from .query import Query, comparable, table

LABEL_SQL = "CASE WHEN value > 50 THEN 'positive' WHEN value < 50 THEN 'negative' ELSE 'neutral' END"


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    score = F.round(F.col("value") - 50, 2)
    return table(spark, folder, "events").select(
        "event_id", "event_type", score.alias("sentiment_score")
    )


def run_label(spark, folder):
    df = scored_events(spark, folder)
    label = sentiment_category(F.col("sentiment_score"))
    return comparable(df.withColumn("sentiment_category", label), 2)


def run_label_udf(spark, folder):
    df = scored_events(spark, folder)
    label = sentiment_category_python(F.col("sentiment_score"))
    return comparable(df.withColumn("sentiment_category", label), 2)


LABELS_SQL = f"""
    SELECT event_id, event_type, round(value - 50, 2) AS sentiment_score,
           {LABEL_SQL} AS sentiment_category FROM events"""


def run_reconcile_labels(spark, folder):
    """The Python label against the built-in one, event by event."""
    df = scored_events(spark, folder)
    score = F.col("sentiment_score")
    builtin = df.select("event_id", sentiment_category(score).alias("label"))
    python = df.select("event_id", sentiment_category_python(score).alias("label"))
    return reconcile(builtin, python, ["event_id"], ["label"])


def run_reconcile_five(spark, folder):
    """The five aggregates from one scan against the five taken one by one."""
    documents = table(spark, folder, "documents")
    features = text_features(documents)

    def rows(metric: str, df: DataFrame, key, value) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"),
            key.cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    none = F.lit(None)
    one_by_one = [
        rows("avg_length", average_length(documents), none, F.col("avg_length")),
        rows("positive_count", positive_count(documents), none, F.col("positive_count")),
        rows("word_count", top_values(features, "word_count"), F.col("word_count"), F.col("count")),
        rows(
            "review_length", top_values(features, "review_length"),
            F.col("review_length"), F.col("count"),
        ),
        rows(
            "length_category", category_counts(features, "review_length", *fixed.LENGTH_3),
            F.col("category"), F.col("count"),
        ),
    ]
    apart = one_by_one[0]
    for part in one_by_one[1:]:
        apart = apart.unionByName(part)
    checked = reconcile(five_aggregates(documents), apart, ["metric", "key"], ["value"], 0.01)
    return checked.groupBy("metric").agg(
        F.count("*").alias("compared"), F.every("matches").alias("matches")
    )


def run_csv_roundtrip(spark, folder):
    """Orders through CSV and back, by a given schema."""
    path = new_path(spark, "orders_csv")
    df = table(spark, folder, "orders")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema)
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return comparable(back.withColumn("o_orderdate", written), 2)


def run_csv_text_roundtrip(spark, folder):
    """Whole texts through CSV and back: quotes, line breaks and blanks must survive."""
    path = new_path(spark, "documents_csv")
    df = table(spark, folder, "documents").select("doc_id", "text", "lang")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema, multiline=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


def run_csv_empty_texts(spark, folder):
    """Empty texts and NULL ones stay apart through CSV."""
    path = new_path(spark, "empty_csv")
    doc_id = F.col("doc_id")
    text = F.when(doc_id % 5 == 0, "").when(doc_id % 5 != 1, F.col("text"))
    df = table(spark, folder, "documents").select("doc_id", text.alias("text"))
    write_csv(df, path)
    back = read_csv(spark, path, df.schema, multiline=True)
    return back.select(
        "doc_id", F.md5("text").alias("text_md5"), (F.col("text") == "").alias("is_empty")
    )


def run_csv_labelled(spark, folder):
    """Scored rows in from CSV with inferred types, the label added, out to CSV again."""
    source, target = new_path(spark, "scored_csv"), new_path(spark, "labelled_csv")
    write_csv(scored_events(spark, folder), source)
    scored = read_csv(spark, source)
    label = sentiment_category(F.col("sentiment_score"))
    write_csv(scored.withColumn("sentiment_category", label), target, header=False)
    names = "event_id bigint, event_type string, sentiment_score double, sentiment_category string"
    return comparable(read_csv(spark, target, names, header=False), 2)


def run_json_report(spark, folder):
    """The sentiment summary as a JSON report, read back."""
    path = new_path(spark, "report_json")
    write_json(comparable(sentiment_summary(table(spark, folder, "documents"))), path)
    fields = "has_positive bigint, avg_length double, review_count bigint, avg_words double"
    return spark.read.schema(fields).json(path)


def run_text_report(spark, folder):
    """One line of text per category, read back."""
    path = new_path(spark, "report_text")
    lengths = table(spark, folder, "documents").select(F.length("text").alias("review_length"))
    counts = category_counts(lengths, "review_length", *fixed.LENGTH_5)
    write_text(counts, path, F.format_string("%s: %d rows", "category", "count"))
    return spark.read.text(path).withColumnRenamed("value", "line")


def run_read_or_default(spark, folder):
    """A table that isn't there, answered with another one; and one that is there."""
    missing = read_or_default(
        spark, f"{folder}/no_such_table.parquet", lambda: table(spark, folder, "orders")
    )
    present = read_or_default(
        spark, f"{folder}/customer.parquet", lambda: table(spark, folder, "orders")
    )
    return missing.select(F.col("o_orderkey").alias("key"), F.lit("default").alias("source")).union(
        present.select(F.col("c_custkey"), F.lit("read"))
    )


def run_synthetic(spark, folder):
    """Synthetic review columns from the document key; the random ones by their range."""
    df = with_synthetic_columns(table(spark, folder, "documents"), "doc_id")
    return comparable(
        df.select(
            "doc_id",
            "review_id",
            "review_date",
            "user_id",
            ((F.col("rating") >= 6) & (F.col("rating") < 10)).alias("rating_in_range"),
            F.col("helpful_votes").between(0, 49).alias("votes_in_range"),
        )
    )


def run_synthetic_spread(spark, folder):
    """The random columns are spread as they should be: their means, to within a tenth."""
    df = with_synthetic_columns(table(spark, folder, "orders"), "o_orderkey")
    return df.agg(
        (F.abs(F.avg("rating") - 8) < 0.1).alias("rating_centred"),
        (F.abs(F.avg("helpful_votes") - 24.5) < 1.5).alias("votes_centred"),
        F.countDistinct("helpful_votes").alias("vote_values"),
    )


def run_row_ids(spark, folder):
    """Ids given to rows without a key are unique."""
    df = table(spark, folder, "documents").select(row_key(None).alias("row_id"))
    return df.agg(F.count("*").alias("total_rows"), F.countDistinct("row_id").alias("row_ids"))


def run_resolve_roles(spark, folder):
    """Running sum of votes-group ratings by the roles a review table resolves to."""
    reviews = with_synthetic_columns(
        table(spark, folder, "documents").select("doc_id"), "doc_id"
    ).withColumn("rating", 6 + F.pmod("doc_id", F.lit(5)))
    df, roles = with_roles(reviews.drop("helpful_votes"))
    total = running_sum(df, [roles.id], [roles.date, "doc_id"], roles.amount)
    return comparable(total.select("doc_id", F.col(roles.id).alias("id"), "cumulative_sum"))


RESOLVE_ROLES_SQL = """
    SELECT doc_id, 'user_' || CAST(doc_id % 100 + 1 AS VARCHAR) AS id,
           CAST(sum(6 + doc_id % 5) OVER (PARTITION BY doc_id % 100
                ORDER BY doc_id % 365, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_sum
    FROM documents"""


def run_default_roles(spark, folder):
    """A table of unknown kind gets default roles; its random amount by range."""
    df, roles = with_roles(table(spark, folder, "events"), "event_id")
    amount = F.col(roles.amount)
    return df.select(
        "event_id",
        F.col(roles.date).alias("date"),
        F.col(roles.id).alias("id"),
        F.col(roles.group).alias("group_name"),
        ((amount >= 0) & (amount < 1000)).alias("amount_in_range"),
    )


def run_sample(spark, folder):
    """About a tenth of the orders, drawn by a hash of the key: any partitioning draws the same."""
    orders = read_table(spark, f"{folder}/orders.parquet")
    drawn = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 2) < "1a"
    return orders.where(drawn).select("o_orderkey", "o_custkey", "o_orderstatus")


def run_sample_share(spark, folder):
    """A random sample is about a tenth of the orders, none of them twice."""
    df = read_table(spark, f"{folder}/orders.parquet")
    sampled = df.sample(0.1, seed=7).select("o_orderkey")
    total = df.agg(F.count("*")).scalar()
    return sampled.agg(
        F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("different")
    ).select(
        (F.abs(F.col("n") / total - 0.1) < 0.05).alias("about_a_tenth"),
        (F.col("n") == F.col("different")).alias("none_twice"),
    )


QUERIES = {
    "sentiment_category": Query(run_label, LABELS_SQL),
    "sentiment_category_udf": Query(run_label_udf, LABELS_SQL),
    "reconcile_udf_builtin": Query(
        run_reconcile_labels,
        f"""SELECT event_id, {LABEL_SQL} AS left_label, {LABEL_SQL} AS right_label,
                   true AS matches FROM events""",
    ),
    "reconcile_five_aggregates": Query(
        run_reconcile_five,
        """SELECT 'avg_length' AS metric, 1 AS compared, true AS matches
           UNION ALL SELECT 'positive_count', 1, true
           UNION ALL SELECT 'word_count', least(10, count(DISTINCT len(string_split(text, ' ')))),
                            true FROM documents
           UNION ALL SELECT 'review_length', least(10, count(DISTINCT length(text))), true
                     FROM documents
           UNION ALL SELECT 'length_category', count(DISTINCT CASE WHEN length(text) < 100 THEN 1
                            WHEN length(text) < 500 THEN 2 ELSE 3 END), true FROM documents""",
    ),
    "csv_roundtrip": Query(
        run_csv_roundtrip,
        """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice,
                  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
           FROM orders""",
    ),
    "csv_text_roundtrip": Query(
        run_csv_text_roundtrip, "SELECT doc_id, md5(text) AS text_md5, lang FROM documents"
    ),
    "csv_empty_texts": Query(
        run_csv_empty_texts,
        """SELECT doc_id, md5(t) AS text_md5, t = '' AS is_empty
           FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE text END AS t
                 FROM documents)""",
    ),
    "csv_labelled": Query(run_csv_labelled, LABELS_SQL),
    "json_report": Query(run_json_report, None),
    "text_report": Query(
        run_text_report,
        """SELECT category || ': ' || CAST(count(*) AS VARCHAR) || ' rows' AS line
           FROM (SELECT CASE WHEN length(text) < 100 THEN 'Very Short'
                             WHEN length(text) < 300 THEN 'Short'
                             WHEN length(text) < 700 THEN 'Medium'
                             WHEN length(text) < 1500 THEN 'Long' ELSE 'Very Long' END AS category
                 FROM documents) GROUP BY category""",
    ),
    "read_or_default": Query(
        run_read_or_default,
        """SELECT o_orderkey AS key, 'default' AS source FROM orders
           UNION ALL SELECT c_custkey, 'read' FROM customer""",
    ),
    "synthetic_columns": Query(
        run_synthetic,
        """SELECT doc_id, doc_id AS review_id,
                  strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d')
                      AS review_date,
                  'user_' || CAST(doc_id % 100 + 1 AS VARCHAR) AS user_id,
                  true AS rating_in_range, true AS votes_in_range FROM documents""",
    ),
    "synthetic_spread": Query(
        run_synthetic_spread,
        "SELECT true AS rating_centred, true AS votes_centred, CAST(50 AS BIGINT) AS vote_values",
    ),
    "row_ids": Query(
        run_row_ids, "SELECT count(*) AS total_rows, count(*) AS row_ids FROM documents"
    ),
    "resolve_roles": Query(run_resolve_roles, RESOLVE_ROLES_SQL),
    "default_roles": Query(
        run_default_roles,
        """SELECT event_id, '2024-01-01' AS date, 'cust_' || CAST(event_id AS VARCHAR) AS id,
                  'Region_A' AS group_name, true AS amount_in_range FROM events""",
    ),
    "sample_rows": Query(
        run_sample,
        """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
           WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 2) < '1a'""",
    ),
    "sample_share": Query(
        run_sample_share, "SELECT true AS about_a_tenth, true AS none_twice"
    ),
}
