"""Operator 8: contiguous shards of equal bytes from global prefix sums (native).

Rows are put in one global order, per-partition byte totals give each partition its
starting byte, a running sum inside the partition gives each row its own, and the
byte axis is cut at equal targets.  Only ids, sizes and digests are shuffled, never
texts.  Order: digest of the text, then the id, so equal texts are neighbours: a group of
equal texts is placed as a whole by its middle, and only a group that is larger than a
shard is cut.  A hot text still spreads over many range partitions because the id is part
of the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.llm.common import materialize
from itemtrack.operators.common import join_split


def byte_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 length of the text plus 1 (null and empty texts: 1).  A row
    belongs to the shard in which the middle of its group of equal texts falls (of its own
    bytes, if the group is larger than a shard's share), so a shard differs from the target by
    at most its first and last group; ``slot`` counts from 0 in the global order.  Null ids come first, repeated rows keep one slot each, an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    # Digests are written once: choosing range bounds samples this small table, not the texts.
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("text_md5")), "shard-rows")
    # Partition ids and positions are fixed in a written table, so a lost executor cannot change them.
    placed = materialize(
        rows.repartitionByRange(n_parts, F.col("text_md5"), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("text_md5"), F.col("doc_id").asc_nulls_first())
        .select("doc_id", "size", "text_crc32", "text_md5", F.spark_partition_id().alias("pid"),
                F.monotonically_increasing_id().alias("pos")), "shard-order")
    totals = placed.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                                       F.min("pos").alias("pos0"))
    earlier = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of partitions, hence one task and a broadcast.
    totals = totals.select("pid", "pos0", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("byte0"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("row0"),
                           F.sum("bytes").over(Window.partitionBy(F.lit(0))).alias("total"))
    within = Window.partitionBy("pid").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    cut = (placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
           .join(F.broadcast(totals), "pid")
           .select("doc_id", "size", "text_crc32", "text_md5", "total", (F.col("byte0") + F.col("before")).alias("start"),
                   (F.col("row0") + F.col("pos") - F.col("pos0")).alias("row")))
    cut = materialize(cut, "shard-starts")
    # Groups of several rows that fit a shard; the others are placed by their rows.
    groups = (cut.groupBy("text_md5").agg(F.min("start").alias("_start"), F.sum("size").alias("_size"),
                                          F.count(F.lit(1)).alias("_n"), F.max("total").alias("_total"))
              .where(f"_n > 1 AND _size * {n_shards}L <= _total").select("text_md5", "_start", "_size"))
    placed = join_split(cut, groups, "text_md5").withColumn("middle", F.coalesce(
        2 * F.col("_start") + F.col("_size"), 2 * F.col("start") + F.col("size")))
    cut = materialize(placed.select(
        "doc_id", "size", "text_crc32", "row",
        F.expr(f"least({n_shards - 1}L, middle * {n_shards}L div (2L * total))").cast("int").alias("shard")), "shard-cut")
    first = cut.groupBy("shard").agg(F.min("row").alias("row_first"))  # n_shards rows
    return (cut.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("row_first")).alias("slot")))
