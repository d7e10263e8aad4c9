"""Contiguous shards of equal bytes, cut at global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store


def size_in_bytes(text) -> F.Column:
    """UTF-8 bytes of a text (NULL: none) and eight for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def shard_by_bytes(
    df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Put every row into one of ``shards`` contiguous ranges of the id order with nearly equal bytes.

    Rows are range-partitioned by id. The bytes of the partitions before a
    partition, plus the running sum inside it, give the bytes before each row in
    the whole table; a row goes to the shard in which the middle of its bytes
    lies, so a shard misses the target by less than the two rows at its ends.
    Only one row per partition and one per shard are ever brought together, and
    only ids, sizes and checksums are shuffled, never texts.

    Returns ``_id, size, text_crc32, shard, slot`` with one row per input row.
    A NULL text has size 8 and the checksum of no bytes. A NULL id sorts first.
    Rows that share an id are ordered by checksum and size, equal rows at will.
    An empty table gives an empty result; fewer rows than shards leave shards
    empty. Other columns are ignored.
    """
    spark = df.sparkSession
    text = F.col(text_col).cast("string")
    # The row number makes the order unique, so that a hot id is cut like any other.
    small = store(
        df.select(
            F.col(id_col).alias("_id"),
            size_in_bytes(text).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    order = ["_id", "text_crc32", "size", "_row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = store(
        small.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = (
        ranged.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .select(
            F.col("_part").alias("_of"),
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(whole).alias("_total"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        ranged.repartitionById(parts, "_part")
        .withColumn("_sum", F.sum("size").over(running))
        .withColumn("_number", F.row_number().over(inside) - 1)
        .join(F.broadcast(totals), F.col("_part") == F.col("_of"))
        .withColumn("_middle", 2 * (F.col("_bytes_before") + F.col("_sum")) - F.col("size"))
        .withColumn("_number", F.col("_rows_before") + F.col("_number"))
        # The middle is below the total, so the last shard is shards - 1.
        .withColumn("shard", F.expr(f"cast((_middle * {shards}) div (2 * _total) as int)"))
        .select("_id", "size", "text_crc32", "shard", "_number")
    )
    numbered = store(numbered, "numbered")
    firsts = numbered.groupBy(F.col("shard").alias("_shard")).agg(F.min("_number").alias("_first"))
    return numbered.join(F.broadcast(firsts), F.col("shard") == F.col("_shard")).select(
        "_id", "size", "text_crc32", "shard",
        (F.col("_number") - F.col("_first")).cast("bigint").alias("slot"),
    )
