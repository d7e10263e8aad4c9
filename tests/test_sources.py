"""Reading, writing, roles and synthetic columns."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from proseledger.operators import skew
from proseledger.plans.inspect import plan_text, schema_of, write_plan
from proseledger.sources import roles, shared, synthetic, tables


@pytest.fixture
def place(spark):
    return lambda name: shared.new_path(spark, name)


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_folder(spark) == named.rstrip("/")
    assert shared.new_path(spark, "x").startswith(named.rstrip("/"))


def test_stored_table_is_read_back_whole(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 0.5, "")], "a int, b double, c string")
    stored = shared.store(df)
    assert stored.dtypes == df.dtypes
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "parquet" in plan_text(stored)


def test_reused_table_is_let_go(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 3)
    with shared.reused(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not df.is_cached
    with shared.reused(df, None) as kept:
        assert kept is df


AWKWARD = [
    (1, 'He said "no", twice'), (2, "two\nlines"), (3, "  blanks  "), (4, ""), (5, None),
    (6, "comma, semicolon; tab\t"), (7, "back\\slash"), (8, "é😀"),
]


def test_csv_gives_back_what_went_in(spark, place):
    path = place("csv")
    tables.write_csv(spark.createDataFrame(AWKWARD, "id int, text string"), path)
    back = tables.read_csv(spark, path, "id int, text string", multiline=True)
    assert sorted(map(tuple, back.collect())) == AWKWARD
    old = tables.read_csv(spark, path, "id int, text string", multiline=True, empty_is_null=True)
    assert sorted(map(tuple, old.collect())) == [(i, t or None) for i, t in AWKWARD]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_the_folder_at_every_size(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, applicationId="a")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        shared.shared_folder(session)
    with pytest.raises(RuntimeError):  # before any row is counted
        skew.by_group_size(SimpleNamespace(sparkSession=session), ["k"], 1000, None, None)
    context.master = "local[4]"
    assert shared.shared_folder(session) == shared.shared_folder(session)


def test_csv_types_are_inferred_and_header_is_optional(spark, place):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, -1.0, "b")], "n int, score double, s string")
    with_header, without = place("csv"), place("csv")
    tables.write_csv(df, with_header)
    tables.write_csv(df, without, header=False)
    assert tables.read_csv(spark, with_header).dtypes == [("n", "int"), ("score", "double"), ("s", "string")]
    assert tables.read_csv(spark, without, header=False).columns == ["_c0", "_c1", "_c2"]
    tables.write_csv(df.limit(1), with_header)
    assert tables.read_csv(spark, with_header).count() == 1


def test_json_and_text_reports(spark, place):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    json_path, text_path = place("json"), place("text")
    tables.write_json(df, json_path)
    assert sorted(r.value for r in spark.read.text(json_path).collect()) == [
        '{"k":"a","n":1}', '{"k":"b","n":null}'
    ]
    tables.write_text(df, text_path, F.format_string("%s=%s", "k", "n"))
    assert sorted(r.value for r in spark.read.text(text_path).collect()) == ["a=1", "b=null"]


def test_plan_as_text_file(spark, place):
    path = place("plan")
    write_plan(spark.range(3).groupBy().count(), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert "== Optimized Logical Plan ==" in lines and "== Physical Plan ==" in lines


def test_default_table_only_where_there_is_none(spark, place):
    default = lambda: spark.range(3).toDF("x")
    assert tables.read_or_default(spark, place("missing"), default).count() == 3
    there = place("there")
    spark.range(5).write.parquet(there)
    assert tables.read_or_default(spark, there, default).count() == 5
    not_parquet = place("text")
    spark.createDataFrame([("x",)], "value string").write.text(not_parquet)
    with pytest.raises(Exception):
        tables.read_or_default(spark, not_parquet, default).count()


def test_inline_rows(spark):
    by_name = tables.from_rows(spark, [(1, "a")], ["id", "text"])
    assert schema_of(by_name) == [("id", "bigint"), ("text", "string")]
    assert tables.from_rows(spark, [(1, "a")], "id int, text string").dtypes[0] == ("id", "int")


def test_text_column_by_name_then_by_type(spark):
    def found(schema):
        return roles.find_text_column(spark.createDataFrame([], schema))

    assert found("id long, Body_TEXT string, review string") == "Body_TEXT"
    assert found("id long, rating int, reviewer string") == "reviewer"
    assert found("id long, note string, title string") == "note"
    with pytest.raises(ValueError):
        found("id long, n double")


def test_roles_by_column_names(spark):
    sales = spark.createDataFrame([], "order_date string, amount double")
    assert roles.with_roles(sales) == (sales, roles.SALES)
    reviews = spark.createDataFrame([], "review_date date, rating double")
    assert roles.with_roles(reviews)[1] == roles.REVIEWS
    other, found = roles.with_roles(spark.range(50), "id")
    row = other.orderBy("id").first()
    assert found == roles.DEFAULT
    assert (row.transaction_date, row.customer_id, row.region) == ("2024-01-01", "cust_0", "Region_A")
    assert other.where((F.col("amount") < 0) | (F.col("amount") >= 1000)).count() == 0


def test_synthetic_columns_do_not_depend_on_the_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    one = synthetic.with_synthetic_columns(df.repartition(1), "k", seed=3).orderBy("k").collect()
    many = synthetic.with_synthetic_columns(df.repartition(13), "k", seed=3).orderBy("k").collect()
    other = synthetic.with_synthetic_columns(df, "k", seed=4).orderBy("k").collect()
    assert one == many and [r.rating for r in one] != [r.rating for r in other]
    assert str(one[366].review_date) == "2024-01-02" and one[101].user_id == "user_2"
    ratings, votes = [r.rating for r in one], [r.helpful_votes for r in one]
    assert 6 <= min(ratings) < 6.05 and 9.95 < max(ratings) < 10
    assert set(votes) == set(range(50))


def test_rows_without_a_key_get_unique_ids(spark):
    df = synthetic.with_synthetic_columns(spark.range(100).repartition(7))
    assert df.select("review_id").distinct().count() == 100
