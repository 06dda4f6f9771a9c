"""Next state per observation row (RUL-01..04) and its group statistics
(AGG-04, AGG-05, WIN-02..05).

Input rows (after classification): ``item_id, market, new_reason, reason`` (the
tracker's current reason, may be NULL) and an arrival order ``seq``.

Plan: every statistic is a partial aggregate, so a hot item or market is
reduced map-side before it is shuffled:

* (item, market, new_reason) -> first seq, row count;
* (item, market) -> rows, first seq, ordered distinct reasons (bounded by the
  number of rule types, so the lists stay small);
* item -> rows, markets, the last-appearing market and its statistics, as a
  window over the (item, market) table (at most one row per market per item);

then one join of the rows to their (item, market) statistics.  That join is the
only shuffle of full rows; both sides are exchanged for it, so AQE splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from itemtrack.functions import fixed
from itemtrack.operators.common import join_split, keep_first, ordered_distinct_list
from itemtrack.schemas import ITEM_MARKET

OTHERS, NONE = fixed.REASON_OTHERS, fixed.REASON_NONE
AS_WRITTEN, PER_MARKET = "as_written", "per_market"


def dedup_observations(df: DataFrame, order_col: str = "seq",
                       keys=("item_id", "market", "new_reason", "reason_text")) -> DataFrame:
    """AGG-04: keep the first row per (item, market, new_reason, reason_text)."""
    return keep_first(df, keys, order_col)


def reason_lists(df: DataFrame, keys=ITEM_MARKET, value: str = "new_reason",
                 order_col: str = "seq", out: str = "reasons",
                 sep: str = fixed.REASON_LIST_SEPARATOR) -> DataFrame:
    """AGG-05: distinct reasons per key by first appearance, joined with ','."""
    lists = ordered_distinct_list(df, keys, value, order_col, "_l")
    return lists.select(*keys, F.array_join("_l", sep).alias(out))


def rows_per_item(df: DataFrame, out: str = "item_rows") -> DataFrame:
    """WIN-02: rows per item across markets, attached to every row.

    A count per item (partial aggregate) joined back instead of a window, so a
    hot item is never buffered whole in one task.
    """
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias(out))
    return join_split(df, counts, "item_id", "left")


def markets_per_item(df: DataFrame, out: str = "item_markets") -> DataFrame:
    """WIN-03: distinct markets per item (distinct windows are not supported)."""
    counts = (df.select("item_id", "market").distinct()
              .groupBy("item_id").agg(F.count(F.lit(1)).alias(out)))
    return join_split(df, counts, "item_id", "left")


def rows_per_item_market(df: DataFrame, out: str = "market_rows") -> DataFrame:
    """WIN-04: rows per (item, market), attached to every row."""
    counts = df.groupBy(*ITEM_MARKET).agg(F.count(F.lit(1)).alias(out))
    return join_split(df, counts, ITEM_MARKET, "left")


def last_market(df: DataFrame, order_col: str = "seq", out: str = "last_market") -> DataFrame:
    """WIN-05: per item, the market whose first row comes latest."""
    firsts = df.groupBy(*ITEM_MARKET).agg(F.min(order_col).alias("_first"))
    return firsts.groupBy("item_id").agg(F.max_by("market", "_first").alias(out))


def _stats(df: DataFrame, order_col: str) -> DataFrame:
    """Per (item, market): own statistics plus the item's, one row each.

    The item statistics are a window over the (item, market) table: it has at
    most one row per market for an item, so a window group is bounded by the
    number of markets however hot the item is, and no self-join is needed.
    """
    per_reason = (df.groupBy("item_id", "market", "new_reason")
                  .agg(F.min(order_col).alias("_fs"), F.count(F.lit(1)).alias("_n")))
    per_market = (per_reason.groupBy("item_id", "market")
                  .agg(F.sum("_n").alias("m_rows"),
                       F.min("_fs").alias("m_first"),
                       F.array_sort(F.collect_list(F.struct("_fs", "new_reason"))).alias("_l"))
                  .withColumn("m_reasons", F.transform("_l", lambda x: x["new_reason"]))
                  .drop("_l"))
    item = Window.partitionBy("item_id")
    return per_market.withColumns({
        "i_rows": F.sum("m_rows").over(item),
        "i_markets": F.count(F.lit(1)).over(item),
        "last": F.max_by(F.struct(F.col("m_rows").alias("rows"),
                                  F.col("m_reasons").alias("reasons")),
                         F.col("m_first")).over(item),
    })


def _pair(reason, status: str) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(reason.cast("string").alias("r"), F.lit(status).alias("s"))


def _single(new_reason: Column, old: Column):
    """RUL-01: one observation row."""
    return (F.when(new_reason == OTHERS, _pair(OTHERS, fixed.STATUS_NONACTION))
            .when(new_reason == NONE, _pair(old, fixed.STATUS_UNBLOCKED))
            .otherwise(_pair(new_reason, fixed.STATUS_WIP)))


def _one_market(reasons: Column, old: Column):
    """RUL-02: several rows of one market; 'No blocker' is dropped from the list."""
    rest = F.array_remove(reasons, NONE)
    return (F.when(F.array_contains(reasons, OTHERS),
                   _pair(OTHERS, fixed.STATUS_NONACTION))
            .when(F.size(rest) > 0, _pair(F.array_join(rest, fixed.REASON_LIST_SEPARATOR),
                                                 fixed.STATUS_WIP))
            .otherwise(_pair(old, fixed.STATUS_UNBLOCKED)))


def _last_market_many(reasons: Column):
    """RUL-03 with several rows in the deciding market: 'No blocker' stays listed."""
    return (F.when(F.array_contains(reasons, OTHERS),
                   _pair(OTHERS, fixed.STATUS_NONACTION))
            .otherwise(_pair(F.array_join(reasons, fixed.REASON_LIST_SEPARATOR),
                                fixed.STATUS_WIP)))


def decide(df: DataFrame, mode: str = AS_WRITTEN, order_col: str = "seq",
           old_col: str = "reason") -> DataFrame:
    """RUL-01..04: add ``next_reason``, ``next_status`` and the ``rule`` applied.

    ``as_written`` (default): an item seen in several markets is decided by the
    market whose first row appears last, for every row of the item (RUL-03).
    ``per_market``: every row is decided by its own market's rows (RUL-04).
    """
    if mode not in (AS_WRITTEN, PER_MARKET):
        raise ValueError(f"unknown decision mode {mode!r}")
    stats = _stats(df, order_col)
    rows = join_split(df, stats, ITEM_MARKET, "left")
    nr, old = F.col("new_reason"), F.col(old_col)
    own_single = _single(nr, old)
    own_many = _one_market(F.col("m_reasons"), old)
    if mode == PER_MARKET:
        rule = F.lit("RUL-04")
        pick = F.when(F.col("m_rows") == 1, own_single).otherwise(own_many)
    else:
        last_rows, last_reasons = F.col("last.rows"), F.col("last.reasons")
        multi = F.when(last_rows == 1, _single(F.get(last_reasons, 0), old)).otherwise(
            _last_market_many(last_reasons))
        rule = (F.when(F.col("i_rows") == 1, "RUL-01")
                .when(F.col("i_markets") == 1, "RUL-02").otherwise("RUL-03"))
        pick = (F.when(F.col("i_rows") == 1, own_single)
                .when(F.col("i_markets") == 1, own_many).otherwise(multi))
    out = (rows.withColumn("_d", pick)
           .withColumn("next_reason", F.col("_d.r"))
           .withColumn("next_status", F.col("_d.s"))
           .withColumn("rule", rule))
    return out.select(*df.columns, "next_reason", "next_status", "rule")
