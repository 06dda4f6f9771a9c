"""Counts and reports (AGG-01..03, AGG-07, AGG-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack.operators.common import literal_table


def items_per_code(df: DataFrame, key: str = "market_code", item: str = "item_id",
                   out: str = "counts") -> DataFrame:
    """AGG-01: non-NULL items per key, NULL keys dropped, ascending key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.col(item)).alias(out)).orderBy(key))


def requested_markets(spark: SparkSession, markets) -> DataFrame:
    return literal_table(spark, [(m,) for m in markets], "market string")


def rows_per_requested_market(df: DataFrame, requested: DataFrame,
                              out: str = "rows") -> DataFrame:
    """AGG-02: rows per requested market, 0 where none (rows, not distinct items)."""
    counts = df.groupBy("market").agg(F.count(F.lit(1)).alias("_n"))
    return (requested.select("market").distinct()
            .join(counts, "market", "left")
            .select("market", F.coalesce("_n", F.lit(0)).cast("long").alias(out)))


def distinct_keys(df: DataFrame, cols=("item_id", "market")) -> DataFrame:
    """AGG-03: distinct keys (or distinct markets with ``cols=('market',)``)."""
    return df.select(*cols).distinct()


def refresh_report(updated_rows: DataFrame, requested: DataFrame, allow: DataFrame,
                   queue: DataFrame) -> DataFrame:
    """AGG-07: per requested market, whether it was updated and the rows updated.

    A market counts as updated when it is on the allow-list and its queue was not
    empty (an empty key list is where the reference's lookup fails and skips);
    the row count is AGG-02 over the update rows.
    """
    counts = rows_per_requested_market(updated_rows, requested, "rows_updated")
    allowed = allow.select("market").distinct().withColumn("_allowed", F.lit(True))
    queued = queue.groupBy("market").agg(F.count(F.lit(1)).alias("_queued"))
    return (counts.join(allowed, "market", "left")
            .join(queued, "market", "left")
            .select("market",
                    (F.coalesce("_allowed", F.lit(False))
                     & (F.coalesce("_queued", F.lit(0)) > 0)).alias("updated"),
                    "rows_updated"))


def updated_items_per_market(df: DataFrame, out: str = "items_updated") -> DataFrame:
    """AGG-08: distinct updated items per market."""
    return df.groupBy("market").agg(F.count_distinct("item_id").alias(out))
