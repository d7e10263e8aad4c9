"""Queries that describe columns: summaries, profiles, modes, correlations, quantiles."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.labels import bucketize
from ..functions.text import text_features
from ..operators.correlation import correlations
from ..operators.frequency import frequency_distribution, mode_of
from ..operators.profile import basic_summary, mixed_stats, profile, profile_highlights
from ..operators.quantiles import (
    QUANTILES, quantile_edges, quantile_histogram, quantile_histograms, quantiles, typed_order_statistics,
)
from ..operators.report import write_profile_report
from ..sources.shared import new_path, reused, store
from .query import Query, comparable, table
from .text_queries import DOCUMENT_FEATURES_SQL

NUMBERS = [
    "review_length", "word_count", "sentence_count", "avg_word_length", "sentiment_score", "rating",
]
CATEGORIES = ["review_length_category", "rating_category"]


def rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document features with a rating that follows from the key, and two categories."""
    rating = 6 + F.pmod(F.col("doc_id") * 37, F.lit(401)) / 100
    df = text_features(table(spark, folder, "documents")).withColumn("rating", rating)
    return df.select(
        "doc_id",
        *NUMBERS,
        bucketize(F.col("review_length"), *fixed.LENGTH_5).alias("review_length_category"),
        bucketize(F.col("rating"), *fixed.RATING_4).alias("rating_category"),
    )


RATED_SQL = f"""
    SELECT *,
           CASE WHEN review_length < 100 THEN 'Very Short' WHEN review_length < 300 THEN 'Short'
                WHEN review_length < 700 THEN 'Medium' WHEN review_length < 1500 THEN 'Long'
                ELSE 'Very Long' END AS review_length_category,
           CASE WHEN rating < 7 THEN 'Poor' WHEN rating < 8 THEN 'Fair'
                WHEN rating < 9 THEN 'Good' ELSE 'Excellent' END AS rating_category
    FROM (SELECT *, 6 + (doc_id * 37 % 401) / CAST(100 AS DOUBLE) AS rating
          FROM ({DOCUMENT_FEATURES_SQL}))"""


def _quantile_sql(column: str, fraction: float) -> str:
    """The smallest value that at least this fraction of the rows don't exceed."""
    return (
        f"(SELECT min(v) FROM (SELECT CAST({column} AS DOUBLE) AS v, "
        f"count(*) OVER (ORDER BY {column}) AS upto, count(*) OVER () AS total FROM r "
        f"WHERE {column} IS NOT NULL) WHERE upto >= ceil({fraction} * total))"
    )


def _column_sql(column: str, with_shape: bool) -> str:
    v = f"CAST({column} AS DOUBLE)"
    basic = f"""
        SELECT '{column}' AS "column", count({v}) AS "count", round(avg({v}), 4) AS mean,
               round(stddev_samp({v}), 4) AS stddev, round(min({v}), 4) AS "min",
               round(max({v}), 4) AS "max" """
    if not with_shape:
        return f"{basic} FROM r"
    # The third moment is taken about the mean: raw moments cancel badly.
    skewness = (
        f"(SELECT avg(power({column} - m, 3)) FROM r, (SELECT avg({v}) AS m FROM r))"
        f" / power(var_pop({v}), 1.5)"
    )
    at = {name: _quantile_sql(column, f) for name, f in QUANTILES.items()}
    quantile_columns = ", ".join(f"round({sql}, 4) AS {name}" for name, sql in at.items())
    return f"""{basic},
               round({skewness}, 4) AS skewness, round(kurtosis_pop({v}), 4) AS kurtosis,
               {quantile_columns},
               count(*) - count({v}) AS null_count, count({v}) AS non_null_count,
               round(max({v}) - min({v}), 4) AS "range",
               round({at['q3']} - {at['q1']}, 4) AS iqr,
               round(CASE WHEN avg({v}) = 0 THEN 0 ELSE stddev_samp({v}) / avg({v}) * 100 END, 4)
                   AS cv
        FROM r"""


SUMMARY_SQL = f"WITH r AS ({RATED_SQL}) " + " UNION ALL ".join(
    _column_sql(c, False) for c in NUMBERS
)
PROFILE_BODY_SQL = " UNION ALL ".join(_column_sql(c, True) for c in NUMBERS)
PROFILE_SQL = f"WITH r AS MATERIALIZED ({RATED_SQL}) {PROFILE_BODY_SQL}"


def _corr_sql(a: str, b: str) -> str:
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    both = f"FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"""
        SELECT '{a}' AS col1, '{b}' AS col2,
               CASE WHEN var_pop({x}) {both} = 0 OR var_pop({y}) {both} = 0 THEN NULL
                    ELSE covar_pop({x}, {y})
                         / (sqrt(var_pop({x}) {both}) * sqrt(var_pop({y}) {both})) END AS corr
        FROM r"""


CORRELATIONS_SQL = f"""
    WITH r AS MATERIALIZED ({RATED_SQL}),
    c AS ({' UNION ALL '.join(_corr_sql(a, b) for a, b in combinations_with_replacement(NUMBERS, 2))})
    SELECT col1, col2, round(corr, 6) AS corr,
           CASE WHEN col1 = col2 THEN 'Perfect' WHEN corr IS NULL THEN NULL
                WHEN abs(corr) >= 0.7 THEN 'Strong' WHEN abs(corr) >= 0.3 THEN 'Moderate'
                WHEN abs(corr) >= 0.1 THEN 'Weak' ELSE 'Negligible' END AS strength,
           CASE WHEN corr > 0 THEN 'Positive' WHEN corr < 0 THEN 'Negative' ELSE 'None' END
               AS direction
    FROM c"""


def _frequency_sql(column: str, k: int) -> str:
    return f"""
        (SELECT '{column}' AS "column", {column} AS value, count(*) AS "count",
                round(count(*) * 100 / CAST((SELECT count(*) FROM r) AS DOUBLE), 6) AS percent
         FROM r GROUP BY {column} ORDER BY "count" DESC, {column} LIMIT {k})"""


def run_frequency(spark, folder):
    df = rated_documents(spark, folder)
    first, second = (frequency_distribution(df, c, 5) for c in CATEGORIES)
    return comparable(first.unionByName(second))


def run_modes(spark, folder):
    df = rated_documents(spark, folder)
    first, second = (mode_of(df, c) for c in CATEGORIES)
    return comparable(first.unionByName(second))


def run_profile(spark, folder):
    return comparable(profile(rated_documents(spark, folder), NUMBERS), 4)


def run_profile_scanned_twice(spark, folder):
    """The same profile with nothing kept between the two scans."""
    return comparable(profile(rated_documents(spark, folder), NUMBERS, persist=None), 4)


def run_highlights(spark, folder):
    kept = rated_documents(spark, folder).select(*NUMBERS, CATEGORIES[0])
    with reused(kept) as df:
        profiled = profile(df, NUMBERS, persist=None)
        correlated = store(correlations(df, NUMBERS), "correlations")
        modes = store(mode_of(df, CATEGORIES[0]), "modes")
    return comparable(profile_highlights(profiled, correlated, modes), 4)


HIGHLIGHTS_SQL = f"""
    WITH r AS MATERIALIZED ({RATED_SQL}),
    s AS ({' UNION ALL '.join(
        f'''SELECT '{c}' AS name, max(CAST({c} AS DOUBLE)) AS top,
                   CASE WHEN avg({c}) = 0 THEN 0
                        ELSE stddev_samp(CAST({c} AS DOUBLE)) / avg({c}) * 100 END AS cv FROM r'''
        for c in NUMBERS)}),
    c AS ({' UNION ALL '.join(
        _corr_sql(a, b) for a, b in combinations_with_replacement(NUMBERS, 2) if a != b)})
    (SELECT 'largest_feature' AS finding, name AS subject, round(top, 4) AS value
     FROM s ORDER BY top DESC, name DESC LIMIT 1)
    UNION ALL (SELECT 'most_variable_feature', name, round(cv, 4)
               FROM s ORDER BY cv DESC, name DESC LIMIT 1)
    UNION ALL (SELECT 'strongest_correlation', col1 || ' / ' || col2, round(abs(corr), 4)
               FROM c WHERE corr IS NOT NULL ORDER BY abs(corr) DESC LIMIT 1)
    UNION ALL (SELECT 'most_common_category', 'review_length_category / ' || review_length_category,
                      CAST(count(*) AS DOUBLE)
               FROM r GROUP BY review_length_category ORDER BY count(*) DESC, 2 LIMIT 1)"""


def run_report(spark, folder):
    """The whole report, written and read back: how many rows each table of it has."""
    path = new_path(spark, "report")
    write_profile_report(rated_documents(spark, folder), NUMBERS, CATEGORIES, path)
    tables = ["profile", "correlations", "histograms", "frequencies", "highlights"]
    rows = [
        spark.read.json(f"{path}/{name}").agg(
            F.lit(name).alias("report"), F.count("*").alias("report_rows")
        )
        for name in tables
    ]
    summary = spark.read.text(f"{path}/summary").select(
        F.col("value").alias("report"), F.lit(1).cast("bigint").alias("report_rows")
    )
    return reduce(DataFrame.unionByName, rows).unionByName(summary)


# Text made from fractions: the two engines round alike but for exact halves.
REPORT_SQL = f"""
    WITH r AS MATERIALIZED ({RATED_SQL}),
    p AS ({PROFILE_BODY_SQL})
    SELECT 'profile' AS report, count(*) AS report_rows FROM p
    UNION ALL SELECT 'correlations', {len(NUMBERS) * (len(NUMBERS) + 1) // 2}
    UNION ALL SELECT 'histograms', {10 * len(NUMBERS)}
    UNION ALL SELECT 'frequencies', least(5, count(DISTINCT review_length_category))
                     + least(5, count(DISTINCT rating_category)) FROM r
    UNION ALL SELECT 'highlights', 4
    UNION ALL SELECT format('{{}}: mean {{:.2f}}, std dev {{:.2f}}, skewness {{:.3f}}, IQR {{:.2f}}',
                            upper("column"), mean, stddev, skewness, iqr), 1 FROM p"""


def run_histogram(spark, folder):
    lengths = table(spark, folder, "documents").select(F.length("text").alias("review_length"))
    return comparable(quantile_histogram(lengths, "review_length"))


def _ranked_sql(source: str, column: str) -> str:
    return f"""
        SELECT v, count(*) AS n, sum(count(*)) OVER (ORDER BY v) AS upto,
               sum(count(*)) OVER () AS total
        FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source}) GROUP BY v"""


HISTOGRAM_SQL = f"""
    WITH q AS ({_ranked_sql('documents', 'length(text)')}),
    e AS (SELECT i, (SELECT min(v) FROM q WHERE upto >= ceil(i / CAST(10 AS DOUBLE) * total)) AS low
          FROM range(0, 11) AS t(i)),
    b AS (SELECT i + 1 AS bucket, low, lead(low) OVER (ORDER BY i) AS high FROM e)
    SELECT CAST(bucket AS BIGINT) AS bucket, low, high,
           CAST(coalesce(sum(n), 0) AS BIGINT) AS count,
           round(coalesce(sum(n), 0) * 100 / CAST((SELECT max(total) FROM q) AS DOUBLE), 6)
               AS percent
    FROM b LEFT JOIN q ON v >= low AND (v < high OR (bucket = 10 AND v = high))
    WHERE bucket <= 10 GROUP BY bucket, low, high"""


def run_edges(spark, folder):
    return comparable(quantile_edges(rated_documents(spark, folder), "review_length", 10, None))


EDGES_SQL = f"""
    WITH q AS ({_ranked_sql('documents', 'length(text)')})
    SELECT CAST(i AS BIGINT) AS edge,
           (SELECT min(v) FROM q WHERE upto >= ceil(i / CAST(10 AS DOUBLE) * total)) AS value
    FROM range(0, 11) AS t(i)"""


def run_edges_approx(spark, folder):
    """Approximate deciles, and whether each one's rank is within 1 % of where it should be."""
    lengths = table(spark, folder, "documents").select(F.length("text").alias("review_length"))
    edges = quantile_edges(lengths, "review_length", 10, 100)
    # Eleven values in one row, and all their ranks from one more pass over the lengths.
    values = edges.agg(F.sort_array(F.collect_list(F.struct("edge", "value"))).alias("edges"))
    with_edges = lengths.withColumn("edges", values.scalar())
    length, total = F.col("review_length"), F.count("*")
    checks = []
    for i in range(11):
        edge = F.col("edges")[i]["value"]
        slack = total * 0.01 + 1
        within = (F.count_if(length < edge) <= total * i / 10 + slack) & (
            F.count_if(length <= edge) >= total * i / 10 - slack
        )
        checks.append(F.struct(F.lit(i).alias("edge"), within.alias("within_error")))
    checked = with_edges.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
    return comparable(checked)


def run_quantiles_chunked(spark, folder):
    """Quantiles of order prices with the distinct values spread over chunks."""
    df = table(spark, folder, "orders").select("o_totalprice")
    return comparable(quantiles(df, ["o_totalprice"], max_group_rows=1000), 4)


QUANTILES_CHUNKED_SQL = f"""
    WITH q AS ({_ranked_sql('orders', 'o_totalprice')})
    SELECT 'o_totalprice' AS "column", {', '.join(
        f"round((SELECT min(v) FROM q WHERE upto >= ceil({f} * total)), 4) AS {name}"
        for name, f in QUANTILES.items())}"""


def run_quantiles_selected(spark, folder):
    """Quantiles of line items: many rows, few distinct quantities, many distinct prices."""
    df = table(spark, folder, "lineitem").select(*LINE_NUMBERS)
    return comparable(quantiles(df, LINE_NUMBERS), 4)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]

QUANTILES_SELECTED_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {', '.join(
        f"round(CAST(quantile_disc({c}, {f}) AS DOUBLE), 4) AS {name}" for name, f in QUANTILES.items())}
        FROM lineitem"""
    for c in LINE_NUMBERS
)


def run_quantiles_approx(spark, folder):
    """Approximate quantiles of line items, and whether each one's rank is within 1 % of where it should be."""
    df = table(spark, folder, "lineitem").select("l_extendedprice")
    found = quantiles(df, ["l_extendedprice"], QUANTILES, 100)
    price, total = F.col("l_extendedprice"), F.count("*")
    # One row with six values, and all their ranks from one more pass over the prices.
    with_values = df.withColumn("at", found.select(F.struct(*QUANTILES)).scalar())
    checks = []
    for name, fraction in QUANTILES.items():
        within = (F.count_if(price < F.col("at")[name]) <= total * (fraction + 0.01)) & (
            F.count_if(price <= F.col("at")[name]) >= total * (fraction - 0.01)
        )
        checks.append(F.struct(F.lit(name).alias("name"), within.alias("within_error")))
    return with_values.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def run_typed(spark, folder):
    """Order statistics of whole numbers that doubles can't tell apart, each in its own type."""
    key = F.col("o_orderkey").cast("bigint")
    long_key = (key * 1_000_003 + F.lit(1 << 60)).alias("long_key")
    wide_key = (key.cast("decimal(38,0)") * 7 + F.lit(Decimal(10) ** 36)).cast("decimal(38,0)").alias("wide_key")
    df = table(spark, folder, "orders").select(long_key, wide_key, "o_totalprice")
    found = typed_order_statistics(df, ["long_key", "wide_key", "o_totalprice"])
    # The two engines write doubles differently: those are compared as numbers.
    is_double = F.col("kind") == "double"
    values = ["min", *QUANTILES, "max", "range"]
    return found.select(
        "column", "kind", "known",
        *[F.when(~is_double, F.col(v)).alias(v) for v in values],
        *[F.round(F.when(is_double, F.col(v)).cast("double"), 4).alias(f"{v}_number") for v in values],
    )


def _typed_sql(column: str, kind: str, value: str, as_text: bool) -> str:
    at = {"min": f"min({value})", **{n: f"quantile_disc({value}, {f})" for n, f in QUANTILES.items()},
          "max": f"max({value})", "range": f"max({value}) - min({value})"}
    text = [f"{f'CAST({v} AS VARCHAR)' if as_text else 'NULL'} AS \"{n}\"" for n, v in at.items()]
    number = [f"{'NULL' if as_text else f'round({v}, 4)'} AS {n}_number" for n, v in at.items()]
    return f"""SELECT '{column}' AS "column", '{kind}' AS kind, count({value}) AS known,
               {', '.join(text)}, {', '.join(number)} FROM orders"""


TYPED_SQL = " UNION ALL ".join([
    _typed_sql("long_key", "bigint", "(CAST(o_orderkey AS BIGINT) * 1000003 + 1152921504606846976)", True),
    _typed_sql("wide_key", "decimal(38,0)",
               f"(CAST(o_orderkey AS HUGEINT) * 7 + CAST('1{'0' * 36}' AS HUGEINT))", True),
    _typed_sql("o_totalprice", "double", "o_totalprice", False),
])


def run_histograms(spark, folder):
    """Histograms of several columns from one selection."""
    df = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    return comparable(quantile_histograms(df, ["l_quantity", "l_extendedprice"], 4))


def _histogram_sql(column: str, buckets: int) -> str:
    return f"""
        SELECT '{column}' AS "column", CAST(bucket AS BIGINT) AS bucket, low, high,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS count,
               round(coalesce(sum(n), 0) * 100 / CAST((SELECT count({column}) FROM lineitem) AS DOUBLE), 6) AS percent
        FROM (SELECT i + 1 AS bucket, low, lead(low) OVER (ORDER BY i) AS high
              FROM (SELECT unnest(range(0, {buckets + 1})) AS i, unnest((
                  SELECT quantile_disc(CAST({column} AS DOUBLE), [{', '.join(str(i / buckets) for i in range(buckets + 1))}])
                  FROM lineitem)) AS low)) b
        LEFT JOIN (SELECT CAST({column} AS DOUBLE) AS v, count(*) AS n FROM lineitem GROUP BY 1) q
          ON v >= low AND (v < high OR (bucket = {buckets} AND v = high))
        WHERE bucket <= {buckets} GROUP BY bucket, low, high"""


HISTOGRAMS_SQL = " UNION ALL ".join(_histogram_sql(c, 4) for c in ("l_quantity", "l_extendedprice"))


def run_mixed_one_pass(spark, folder):
    """The mixed statistics as one aggregate; the median is within 1 % in rank."""
    df = rated_documents(spark, folder).select("review_length", "word_count", "rating")
    found = mixed_stats(df, "review_length", "word_count", "rating", 100)
    rating, total, median = F.col("rating"), F.count("*"), found.select("median_rating").scalar()
    with_median = df.select("rating", median.alias("median"))
    within = (F.count_if(rating < F.col("median")) <= total * 0.51) & (
        F.count_if(rating <= F.col("median")) >= total * 0.49
    )
    checked = with_median.agg(within.alias("within"))
    return comparable(found.drop("median_rating")).withColumn("median_within_error", checked.scalar())


def run_mixed(spark, folder):
    return comparable(
        mixed_stats(rated_documents(spark, folder), "review_length", "word_count", "rating")
    )


MIXED_SQL = f"""
    WITH r AS MATERIALIZED ({RATED_SQL})
    SELECT round(avg(review_length), 6) AS mean_length,
           round(stddev_samp(review_length), 6) AS std_length,
           round((SELECT avg(power(review_length - m, 3))
                  FROM r, (SELECT avg(review_length) AS m FROM r))
                 / power(var_pop(review_length), 1.5), 6) AS skew_length,
           round(avg(word_count), 6) AS mean_words,
           round(corr(review_length, word_count), 6) AS corr_length_words,
           round({_quantile_sql('rating', 0.5)}, 6) AS median_rating
    FROM r"""


MIXED_ONE_PASS_SQL = f"""
    SELECT * EXCLUDE (median_rating), true AS median_within_error FROM ({MIXED_SQL})"""


QUERIES = {
    "basic_summary": Query(
        lambda spark, folder: comparable(basic_summary(rated_documents(spark, folder), NUMBERS), 4),
        SUMMARY_SQL,
    ),
    "profile": Query(run_profile, PROFILE_SQL),
    "profile_scanned_twice": Query(run_profile_scanned_twice, PROFILE_SQL),
    "profile_highlights": Query(run_highlights, HIGHLIGHTS_SQL),
    "mode_category": Query(
        run_modes,
        f"""WITH r AS MATERIALIZED ({RATED_SQL})
            SELECT "column", value AS mode, "count" AS mode_frequency, percent
            FROM ({' UNION ALL '.join(_frequency_sql(c, 1) for c in CATEGORIES)})""",
    ),
    "frequency_top5": Query(
        run_frequency,
        f"WITH r AS MATERIALIZED ({RATED_SQL}) "
        + " UNION ALL ".join(_frequency_sql(c, 5) for c in CATEGORIES),
    ),
    "correlations": Query(
        lambda spark, folder: comparable(correlations(rated_documents(spark, folder), NUMBERS)),
        CORRELATIONS_SQL,
    ),
    "quantile_edges": Query(run_edges, EDGES_SQL),
    "quantile_edges_approx": Query(
        run_edges_approx,
        "SELECT CAST(i AS BIGINT) AS edge, true AS within_error FROM range(0, 11) AS t(i)",
    ),
    "quantile_histogram": Query(run_histogram, HISTOGRAM_SQL),
    "quantiles_selected": Query(run_quantiles_selected, QUANTILES_SELECTED_SQL),
    "quantiles_approx": Query(
        run_quantiles_approx,
        "SELECT unnest(['q1', 'median', 'q3', 'p90', 'p95', 'p99']) AS name, true AS within_error",
    ),
    "typed_order_statistics": Query(run_typed, TYPED_SQL),
    "quantile_histograms": Query(run_histograms, HISTOGRAMS_SQL),
    "mixed_stats_one_pass": Query(run_mixed_one_pass, MIXED_ONE_PASS_SQL),
    "quantiles_large_groups": Query(run_quantiles_chunked, QUANTILES_CHUNKED_SQL),
    "mixed_stats": Query(run_mixed, MIXED_SQL),
    "profile_report": Query(run_report, REPORT_SQL),
}
