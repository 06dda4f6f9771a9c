"""Key-list lookups and joins (JON-01..04, JON-07) and the latest export (WIN-01).

Key lists are never spelled out as literals: they are DataFrames joined with
``left_semi`` on the two key columns, so the planner can broadcast a small list,
shuffle a large one and inject a runtime bloom filter into the big side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.operators.common import join_split
from itemtrack.schemas import ITEM_MARKET


def restrict_to_keys(df: DataFrame, keys: DataFrame, on=ITEM_MARKET, ignore_case: bool = False) -> DataFrame:
    """JON-07: rows of a large table whose key is in the key table (semi join).

    The key list is made distinct first (a partial aggregate), so a key repeated
    in a third of the list is collapsed map-side; a key hot in ``df`` is split by
    adaptive execution.  ``ignore_case``: keys match whatever their case.
    """
    on = list(on)
    return join_split(df, keys.select(*on).distinct(), on, "left_semi", ignore_case)


def inflow_lookup(tracker: DataFrame, inflow: DataFrame, ignore_case: bool = False) -> DataFrame:
    """JON-01: tracker (item, market) rows whose key is in the inflow list, any status."""
    return restrict_to_keys(tracker, inflow, ignore_case=ignore_case).select(*ITEM_MARKET)


def status_lookup(tracker: DataFrame, keys: DataFrame, ignore_case: bool = False) -> DataFrame:
    """JON-02: item, market, reason, status for the keys; several rows stay several."""
    return restrict_to_keys(tracker, keys, ignore_case=ignore_case).select(*ITEM_MARKET, "reason", "status")


def attach_state(observations: DataFrame, state: DataFrame, ignore_case: bool = False) -> DataFrame:
    """JON-04: observations left-joined to tracker state on (item, market); fans out."""
    return join_split(observations, state, ITEM_MARKET, "left", ignore_case)


def first_state(tracker: DataFrame, order_col: str = "seq") -> DataFrame:
    """One tracker state per (item, market): the first row in tracker order.

    Equivalent to fanning observations out over all tracker rows and then
    keeping the first of each observation key (the key has no tracker column),
    with far less data shuffled.  ``min_by`` is a partial aggregate.
    """
    first = F.min_by(F.struct("reason", "status"), F.col(order_col)).alias("_s")
    return tracker.groupBy(*ITEM_MARKET).agg(first).select(*ITEM_MARKET, "_s.reason", "_s.status")


def latest_export(core: DataFrame, keys: DataFrame | None = None, by=("item_id",),
                  key_on=("item_id", "market_code")) -> DataFrame:
    """WIN-01 / TOP-01: newest dated export per item.

    Restrict to the requested (item, market code) keys, drop rows without a date
    (zero date), then ``row_number() = 1`` per ``by`` ordered by date descending.
    Ties are broken by the smaller market code (the reference leaves them open).
    Spark plans the rank filter as a partial WindowGroupLimit before the shuffle,
    so even a hot item ships at most one row per map task.
    """
    df = core.where(F.col("exportable_date").isNotNull())
    if keys is not None:
        df = restrict_to_keys(df, keys, key_on)
    w = Window.partitionBy(*by).orderBy(F.col("exportable_date").desc(), F.col("market_code").asc())
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select("item_id", "market_code", "exportable_date"))


def queue_with_latest(queue: DataFrame, latest: DataFrame) -> DataFrame:
    """JON-03: queue (item, market_code) inner-joined to the latest export;
    queue duplicates fan out, as in the reference."""
    return join_split(queue, latest, ["item_id", "market_code"], "inner")
