"""Queries over orders: windows, ranks, shares and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from ..operators.aggregates import table_summary
from ..operators.exact_sums import exact_sums
from ..operators.sales import window_report
from ..operators.shares import group_shares, share_of_total
from ..sources.roles import with_roles
from ..sources.synthetic import with_synthetic_columns
from .query import Query, comparable, table

ORDER = ["o_orderdate", "o_orderkey"]
CENTS = 4


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def run_running_sum(keys, **limit):
    def run(spark, folder):
        df = orders(spark, folder).select("o_orderkey", "o_orderdate", "o_totalprice", *keys)
        df = windows.running_sum(df, keys, ORDER, "o_totalprice", **limit)
        return comparable(df.select("o_orderkey", *keys, "o_totalprice", "cumulative_sum"), CENTS)

    return run


def running_sum_sql(keys: str) -> str:
    return f"""
        SELECT o_orderkey, {keys}, round(o_totalprice, 4) AS o_totalprice,
               round(sum(o_totalprice) OVER (PARTITION BY {keys} ORDER BY o_orderdate, o_orderkey
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cumulative_sum
        FROM orders"""


def run_moving_avg(key, **limit):
    def run(spark, folder):
        df = orders(spark, folder).select("o_orderkey", "o_orderdate", "o_totalprice", key)
        df = windows.moving_avg(df, [key], ORDER, "o_totalprice", **limit)
        return comparable(df.select("o_orderkey", key, "moving_avg_3"), CENTS)

    return run


def moving_avg_sql(key: str) -> str:
    return f"""
        SELECT o_orderkey, {key},
               round(avg(o_totalprice) OVER (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg_3
        FROM orders"""


def run_prev_next(key, **limit):
    def run(spark, folder):
        df = orders(spark, folder).select(
            "o_orderkey", "o_orderdate", key, F.col("o_totalprice").alias("amount")
        )
        df = windows.prev_next(df, [key], ORDER, "amount", **limit)
        kept = df.select("o_orderkey", key, "prev_amount", "next_amount", "amount_change")
        return comparable(kept, CENTS)

    return run


def prev_next_sql(key: str) -> str:
    return f"""
        SELECT o_orderkey, {key}, round(p, 4) AS prev_amount, round(n, 4) AS next_amount,
               round(CASE WHEN p IS NULL THEN 0 ELSE o_totalprice - p END, 4) AS amount_change
        FROM (SELECT *, lag(o_totalprice) OVER w AS p, lead(o_totalprice) OVER w AS n
              FROM orders WINDOW w AS (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey))"""


def run_ranks(**limit):
    def run(spark, folder):
        df = orders(spark, folder).select("o_orderkey", "o_orderpriority", "o_totalprice")
        return windows.ranks(df, ["o_orderpriority"], "o_totalprice", ["o_orderkey"], **limit)

    return run


RANKS_SQL = """
    SELECT o_orderkey, o_orderpriority, o_totalprice,
           CAST(rank() OVER w AS BIGINT) AS rank_in_group,
           CAST(dense_rank() OVER w AS BIGINT) AS dense_rank_in_group
    FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC)"""


def run_tied_ranks(spark, folder):
    """Ranks by whole thousands, so that nearly every row ties with many others."""
    df = orders(spark, folder).select(
        "o_orderkey", "o_orderstatus", F.floor(F.col("o_totalprice") / 20000).alias("step")
    )
    return windows.ranks(df, ["o_orderstatus"], "step", ["o_orderkey"], max_group_rows=1000)


def run_top_by_customer(spark, folder):
    """The first ten rows by customer and date, with everything the windows say of them."""
    df = orders(spark, folder).withColumnRenamed("o_totalprice", "amount")
    df = windows.running_sum(df, ["o_custkey", "o_orderpriority"], ORDER, "amount")
    df = windows.moving_avg(df, ["o_custkey"], ORDER, "amount")
    df = windows.prev_next(df, ["o_custkey"], ORDER, "amount")
    first = df.orderBy("o_custkey", *ORDER).limit(10)
    return comparable(
        first.select(
            "o_custkey", "o_orderpriority", "amount", "cumulative_sum", "moving_avg_3",
            "prev_amount", "next_amount", "amount_change",
        ),
        CENTS,
    )


TOP_BY_CUSTOMER_SQL = """
    SELECT o_custkey, o_orderpriority, round(o_totalprice, 4) AS amount,
           round(cumulative_sum, 4) AS cumulative_sum, round(moving_avg_3, 4) AS moving_avg_3,
           round(p, 4) AS prev_amount, round(n, 4) AS next_amount,
           round(CASE WHEN p IS NULL THEN 0 ELSE o_totalprice - p END, 4) AS amount_change
    FROM (SELECT *,
                 sum(o_totalprice) OVER (PARTITION BY o_custkey, o_orderpriority
                     ORDER BY o_orderdate, o_orderkey
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_sum,
                 avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3,
                 lag(o_totalprice) OVER w AS p, lead(o_totalprice) OVER w AS n
          FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
    ORDER BY o_custkey, o_orderdate, o_orderkey LIMIT 10"""


def run_top_by_rank(spark, folder):
    """The first ten rows by group and rank."""
    ranked = run_ranks()(spark, folder)
    first = ranked.orderBy("o_orderpriority", "rank_in_group", "o_orderkey").limit(10)
    return first.drop("o_orderkey")


def run_window_report(**limit):
    """All window columns on every sale of a positive amount, by customer."""

    def run(spark, folder):
        df = orders(spark, folder).select(
            "o_orderkey",
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("region"),
        )
        df, roles = with_roles(df)
        report = window_report(df, roles, "o_orderkey", **limit).where(F.col(roles.amount) > 0)
        report = report.drop("order_date").withColumnRenamed("order_date_ts", "day")
        return comparable(report.orderBy("customer_id"), CENTS)

    return run


WINDOW_REPORT_SQL = """
    WITH t AS (
        SELECT o_orderkey, o_totalprice AS amount, o_custkey AS customer_id,
               o_orderpriority AS region, CAST(o_orderdate AS DATE) AS d FROM orders),
    w AS (
        SELECT *,
               sum(amount) OVER (PARTITION BY customer_id, region ORDER BY d, o_orderkey
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               avg(amount) OVER (PARTITION BY customer_id ORDER BY d, o_orderkey
                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mov,
               lag(amount) OVER i AS p, lead(amount) OVER i AS n,
               rank() OVER g AS rnk, dense_rank() OVER g AS dense,
               sum(amount) OVER (PARTITION BY region) AS gs, sum(amount) OVER () AS ts
        FROM t WINDOW i AS (PARTITION BY customer_id ORDER BY d, o_orderkey),
                      g AS (PARTITION BY region ORDER BY amount DESC))
    SELECT o_orderkey, round(amount, 4) AS amount, customer_id, region,
           strftime(d, '%Y-%m-%d') AS day, CAST(month(d) AS BIGINT) AS month,
           CAST(year(d) AS BIGINT) AS year, round(cum, 4) AS cumulative_sum,
           round(mov, 4) AS moving_avg_3, round(p, 4) AS prev_amount, round(n, 4) AS next_amount,
           round(CASE WHEN p IS NULL THEN 0 ELSE amount - p END, 4) AS amount_change,
           CAST(rnk AS BIGINT) AS rank_in_group, CAST(dense AS BIGINT) AS dense_rank_in_group,
           round(gs, 4) AS group_sum, round(ts, 4) AS total_sum,
           CAST(CAST(gs / ts * 100 AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
    FROM w WHERE amount > 0"""


def run_review_report(spark, folder):
    """All window columns on documents dressed as reviews: by user, rated, grouped by votes."""
    df = table(spark, folder, "documents").select("doc_id")
    df = with_synthetic_columns(df, "doc_id").withColumns(
        {
            "rating": 6 + F.pmod(F.col("doc_id") * 37, F.lit(401)) / 100,
            "helpful_votes": F.pmod("doc_id", F.lit(7)),
        }
    )
    df, roles = with_roles(df)
    report = window_report(df, roles, "review_id")
    return comparable(
        report.select(
            "review_id", roles.id, roles.group, roles.amount, F.col("review_date_ts").alias("day"),
            "cumulative_sum", "moving_avg_3", "rank_in_group", "dense_rank_in_group",
            "prev_rating", "next_rating", "rating_change", "percent_of_total",
        ),
        CENTS,
    )


REVIEW_REPORT_SQL = """
    WITH t AS (
        SELECT doc_id AS review_id, 'user_' || CAST(doc_id % 100 + 1 AS VARCHAR) AS user_id,
               doc_id % 7 AS helpful_votes, 6 + (doc_id * 37 % 401) / CAST(100 AS DOUBLE) AS rating,
               DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS d FROM documents),
    w AS (
        SELECT *,
               sum(rating) OVER (PARTITION BY user_id, helpful_votes ORDER BY d, review_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               avg(rating) OVER (PARTITION BY user_id ORDER BY d, review_id
                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mov,
               lag(rating) OVER i AS p, lead(rating) OVER i AS n,
               rank() OVER g AS rnk, dense_rank() OVER g AS dense,
               sum(rating) OVER (PARTITION BY helpful_votes) / sum(rating) OVER () AS share
        FROM t WINDOW i AS (PARTITION BY user_id ORDER BY d, review_id),
                      g AS (PARTITION BY helpful_votes ORDER BY rating DESC))
    SELECT review_id, user_id, helpful_votes, round(rating, 4) AS rating,
           strftime(d, '%Y-%m-%d') AS day, round(cum, 4) AS cumulative_sum,
           round(mov, 4) AS moving_avg_3, CAST(rnk AS BIGINT) AS rank_in_group,
           CAST(dense AS BIGINT) AS dense_rank_in_group, round(p, 4) AS prev_rating,
           round(n, 4) AS next_rating,
           round(CASE WHEN p IS NULL THEN 0 ELSE rating - p END, 4) AS rating_change,
           CAST(CAST(share * 100 AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
    FROM w"""


SHARES_SQL = """
    SELECT o_orderpriority, round(gs, 2) AS group_sum, round(ts, 2) AS total_sum,
           CAST(CAST(gs / ts * 100 AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
    FROM (SELECT o_orderpriority, sum(o_totalprice) AS gs FROM orders GROUP BY 1),
         (SELECT sum(o_totalprice) AS ts FROM orders)"""


def run_shares(spark, folder):
    shares = group_shares(orders(spark, folder), "o_orderpriority", "o_totalprice")
    return comparable(shares.orderBy(F.desc("percent_of_total")), 2)


def run_share_rows(spark, folder):
    df = orders(spark, folder).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return comparable(share_of_total(df, "o_orderpriority", "o_totalprice"), 2)


def _exact_sql(total: str) -> str:
    """The double next to an exact sum of prices in units of 2^-45: the two halves are exact doubles."""
    return (
        f"(CAST(({total}) // 1099511627776 AS DOUBLE) * 1099511627776 + CAST(({total}) % 1099511627776 AS DOUBLE))"
        " / 35184372088832"
    )


def _units_sql(amount: str) -> str:
    return f"CAST({amount} * 35184372088832 AS HUGEINT)"


def run_running_sum_exact(key, **limit):
    """Running sums with the same bits however the rows are cut: nothing is rounded for the comparison."""

    def run(spark, folder):
        df = orders(spark, folder).select("o_orderkey", "o_orderdate", key, "o_totalprice")
        df = windows.running_sum(df, [key], ORDER, "o_totalprice", exact=True, **limit)
        return df.select("o_orderkey", key, "cumulative_sum")

    return run


def running_sum_exact_sql(key: str) -> str:
    return f"""
        SELECT o_orderkey, {key}, {_exact_sql("t")} AS cumulative_sum
        FROM (SELECT o_orderkey, {key}, sum({_units_sql("o_totalprice")}) OVER (
                  PARTITION BY {key} ORDER BY o_orderdate, o_orderkey
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t FROM orders)"""


def run_group_sums_exact(spark, folder):
    """Sums and means by customer, with the same bits for any partitioning."""
    df = orders(spark, folder).select("o_custkey", "o_totalprice")
    return exact_sums(df, ["o_custkey"], "o_totalprice")


GROUP_SUMS_EXACT_SQL = f"""
    SELECT o_custkey, {_exact_sql("t")} AS sum, {_exact_sql("t")} / known AS mean, rows, known
    FROM (SELECT o_custkey, sum({_units_sql("o_totalprice")}) AS t, count(*) AS rows, count(o_totalprice) AS known
          FROM orders GROUP BY 1)"""


def run_share_exact(spark, folder):
    """Shares of a total near 0, which ordinary sums give other digits by the order of the rows."""
    amount = F.when(F.col("o_orderkey") % 2 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    df = orders(spark, folder).select("o_orderkey", "o_orderpriority", amount.alias("amount"))
    shares = share_of_total(df, "o_orderpriority", "amount", exact=True)
    return shares.withColumn("percent_of_total", F.col("percent_of_total").cast("double"))


SHARE_EXACT_SQL = f"""
    WITH s AS (SELECT o_orderkey, o_orderpriority,
                      CASE o_orderkey % 2 WHEN 0 THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders),
    g AS (SELECT o_orderpriority, sum({_units_sql("amount")}) AS t FROM s GROUP BY 1),
    r AS (SELECT o_orderpriority, {_exact_sql("t")} AS group_sum,
                 (SELECT {_exact_sql("a")} FROM (SELECT sum(t) AS a FROM g)) AS total_sum FROM g)
    SELECT o_orderkey, s.o_orderpriority, amount, group_sum, total_sum,
           CAST(TRY_CAST(group_sum / total_sum * 100 AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
    FROM s JOIN r ON s.o_orderpriority = r.o_orderpriority"""


def run_share_signed(spark, folder):
    """Every second amount negated: shares of either sign, NULL where out of range."""
    amount = F.when(F.col("o_orderkey") % 2 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    df = orders(spark, folder).select("o_orderpriority", amount.alias("amount"))
    shares = group_shares(df, "o_orderpriority", "amount")
    # The total is near 0: its last digits depend on the order of the additions.
    return comparable(shares.select("o_orderpriority", "group_sum", "percent_of_total"), 2)


SHARES_SIGNED_SQL = """
    WITH s AS (SELECT o_orderpriority,
                      CASE o_orderkey % 2 WHEN 0 THEN -o_totalprice ELSE o_totalprice END AS amount
               FROM orders),
    g AS (SELECT o_orderpriority, sum(amount) AS gs FROM s GROUP BY 1)
    SELECT o_orderpriority, round(gs, 2) AS group_sum,
           CAST(TRY_CAST(gs / (SELECT sum(amount) FROM s) * 100 AS DECIMAL(5, 2)) AS DOUBLE)
               AS percent_of_total FROM g"""


def run_share_distinct(spark, folder):
    """The distinct shares found on the rows: the same as the shares of the groups."""
    df = orders(spark, folder).select("o_orderpriority", "o_totalprice")
    rows = share_of_total(df, "o_orderpriority", "o_totalprice")
    shares = rows.select("o_orderpriority", "group_sum", "total_sum", "percent_of_total")
    return comparable(shares.distinct().orderBy(F.desc("percent_of_total")), 2)


def run_share_many_groups(spark, folder):
    """More groups than are broadcast: the heaviest by broadcast, the others by shuffle."""
    df = orders(spark, folder).select("o_orderkey", "o_custkey", "o_totalprice")
    return comparable(share_of_total(df, "o_custkey", "o_totalprice", max_broadcast_rows=800), 2)


def run_date_parts(spark, folder):
    """Dates parsed from text (NULL where it is none), their parts, and dates by arithmetic."""
    key = F.col("o_orderkey")
    written = F.when(key % 7 == 0, "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = orders(spark, folder).select("o_orderkey", written.alias("written"))
    parsed = F.try_to_date("written")
    return comparable(
        df.select(
            "o_orderkey",
            "written",
            parsed.alias("day"),
            # As fractions: whole numbers and NULLs together are read back differently.
            F.month(parsed).cast("double").alias("month"),
            F.year(parsed).cast("double").alias("year"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).alias("review_date"),
            F.concat(F.lit("user_"), (key % 100 + 1).cast("string")).alias("user_id"),
        )
    )


DATE_PARTS_SQL = """
    SELECT o_orderkey, written, strftime(d, '%Y-%m-%d') AS day,
           CAST(month(d) AS DOUBLE) AS month, CAST(year(d) AS DOUBLE) AS year,
           strftime(DATE '2024-01-01' + CAST(o_orderkey % 365 AS INTEGER), '%Y-%m-%d')
               AS review_date,
           'user_' || CAST(o_orderkey % 100 + 1 AS VARCHAR) AS user_id
    FROM (SELECT *, TRY_CAST(written AS DATE) AS d FROM (
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'no date'
                           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS written FROM orders))"""


QUERIES = {
    "running_sum": Query(
        run_running_sum(["o_custkey", "o_orderpriority"]),
        running_sum_sql("o_custkey, o_orderpriority"),
    ),
    "running_sum_large_groups": Query(
        run_running_sum(["o_orderpriority"], max_group_rows=1000),
        running_sum_sql("o_orderpriority"),
    ),
    "moving_avg_3": Query(run_moving_avg("o_custkey"), moving_avg_sql("o_custkey")),
    "moving_avg_3_large_groups": Query(
        run_moving_avg("o_orderstatus", max_group_rows=1000), moving_avg_sql("o_orderstatus")
    ),
    "lag_lead_change": Query(run_prev_next("o_custkey"), prev_next_sql("o_custkey")),
    "lag_lead_change_large_groups": Query(
        run_prev_next("o_orderpriority", max_group_rows=1000), prev_next_sql("o_orderpriority")
    ),
    "rank_in_group": Query(run_ranks(), RANKS_SQL),
    "rank_in_group_large_groups": Query(run_ranks(max_group_rows=1000), RANKS_SQL),
    "rank_with_ties_large_groups": Query(
        run_tied_ranks,
        """SELECT o_orderkey, o_orderstatus, step, CAST(rank() OVER w AS BIGINT) AS rank_in_group,
                  CAST(dense_rank() OVER w AS BIGINT) AS dense_rank_in_group
           FROM (SELECT *, CAST(floor(o_totalprice / 20000) AS BIGINT) AS step FROM orders)
           WINDOW w AS (PARTITION BY o_orderstatus ORDER BY step DESC)""",
    ),
    "top_by_customer": Query(run_top_by_customer, TOP_BY_CUSTOMER_SQL),
    "top_by_rank": Query(
        run_top_by_rank,
        f"""SELECT o_orderpriority, o_totalprice, rank_in_group, dense_rank_in_group
            FROM ({RANKS_SQL}) ORDER BY o_orderpriority, rank_in_group, o_orderkey LIMIT 10""",
    ),
    "window_report": Query(run_window_report(), WINDOW_REPORT_SQL),
    "window_report_large_groups": Query(run_window_report(max_group_rows=12), WINDOW_REPORT_SQL),
    "window_report_reviews": Query(run_review_report, REVIEW_REPORT_SQL),
    "running_sum_exact": Query(run_running_sum_exact("o_custkey"), running_sum_exact_sql("o_custkey")),
    "running_sum_exact_large_groups": Query(
        run_running_sum_exact("o_orderpriority", max_group_rows=1000), running_sum_exact_sql("o_orderpriority")
    ),
    "group_sums_exact": Query(run_group_sums_exact, GROUP_SUMS_EXACT_SQL),
    "share_of_total_exact": Query(run_share_exact, SHARE_EXACT_SQL),
    "share_of_total": Query(run_shares, SHARES_SQL),
    "share_of_total_join": Query(
        run_share_rows,
        """SELECT o_orderkey, o_orderpriority, round(o_totalprice, 2) AS o_totalprice,
                  round(sum(o_totalprice) OVER g, 2) AS group_sum,
                  round(sum(o_totalprice) OVER (), 2) AS total_sum,
                  CAST(CAST(sum(o_totalprice) OVER g / sum(o_totalprice) OVER () * 100
                       AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
           FROM orders WINDOW g AS (PARTITION BY o_orderpriority)""",
    ),
    "share_of_total_signed": Query(run_share_signed, SHARES_SIGNED_SQL),
    "share_of_total_distinct": Query(run_share_distinct, SHARES_SQL),
    "share_of_total_many_groups": Query(
        run_share_many_groups,
        """SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice,
                  round(sum(o_totalprice) OVER g, 2) AS group_sum,
                  round(sum(o_totalprice) OVER (), 2) AS total_sum,
                  CAST(CAST(sum(o_totalprice) OVER g / sum(o_totalprice) OVER () * 100
                       AS DECIMAL(5, 2)) AS DOUBLE) AS percent_of_total
           FROM orders WINDOW g AS (PARTITION BY o_custkey)""",
    ),
    "order_summary": Query(
        lambda spark, folder: comparable(
            table_summary(orders(spark, folder), "o_custkey", "o_totalprice"), 2
        ),
        """SELECT count(*) AS total_records, count(DISTINCT o_custkey) AS unique_ids,
                  round(sum(o_totalprice), 2) AS total_amount,
                  round(avg(o_totalprice), 2) AS average_amount FROM orders""",
    ),
    "order_date_parts": Query(run_date_parts, DATE_PARTS_SQL),
}
