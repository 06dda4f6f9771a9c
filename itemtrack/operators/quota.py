"""WIN-06 quota batching with its range join (JON-08) and head step (TOP-02).

Per market, in queue order, slot 1 is filled up to its capacity, then slot 2,
... in sheet order; items beyond the total capacity are not assigned (they are
returned in a second output instead of being dropped silently); a market
without slots assigns nothing.

Plan: the queue position is computed by :func:`rank_within` (range partitioning
plus prefix sums: no task holds a whole market); slots become (lo, hi] ranges by a
running sum over the quota sheet.  Positions and lower bounds are then put in one order
and swept: every item takes the last bound before it.  The sweep runs in stretches of
positions, each of which starts with the bound carried over from the stretches before,
so it costs queue + slots however many slots a market has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.operators.common import rank_within

STRETCH = 100_000          # positions swept by one window group


def slot_ranges(quotas: DataFrame) -> DataFrame:
    """Cumulative (lo, hi] queue positions per slot, in slot order."""
    w = Window.partitionBy("market").orderBy("slot_no").rowsBetween(Window.unboundedPreceding, 0)
    cap = F.greatest(F.coalesce(F.col("capacity"), F.lit(0)), F.lit(0)).cast("long")
    return (quotas.withColumn("_cap", cap)
            .withColumn("hi", F.sum("_cap").over(w))
            .withColumn("lo", F.col("hi") - F.col("_cap"))
            .select("market", "slot_no", "slot_ref", "lo", "hi"))


def queue_positions(queue: DataFrame, order_col: str = "seq", store: str | None = None) -> DataFrame:
    """1-based position of every queue row in its market (a null market is one too)."""
    return rank_within(queue, "market", [order_col, "item_id"], out="position", store=store)


def plan_batches(queue: DataFrame, quotas: DataFrame, order_col: str = "seq", store: str | None = None):
    """WIN-06: returns ``(assigned, unassigned)``, together the whole queue.

    assigned: market, slot_no, slot_ref, item_id, position (+ queue columns);
    unassigned: the queue rows beyond the total capacity of their market, also those
    of markets without slots and of no market.

    The positions are written at once, to ``store`` if given (the caller's folder, to be
    removed when the outputs are no longer needed), else to a fresh scratch folder.
    """
    swept = _sweep(queue_positions(queue, order_col, store), slot_ranges(quotas).where("hi > lo"))
    within = F.col("_slot").isNotNull() & (F.col("position") <= F.col("_slot.hi"))
    columns = [c for c in swept.columns if c not in ("_slot", "market")]
    assigned = swept.where(within).select("market", "_slot.slot_no", "_slot.slot_ref", *columns, "_slot.lo", "_slot.hi")
    unassigned = swept.where(~F.coalesce(within, F.lit(False))).drop("_slot")
    return assigned.drop("lo", "hi"), unassigned


def _sweep(ranked: DataFrame, ranges: DataFrame) -> DataFrame:
    """Adds ``_slot``: of the market's ranges the last one that begins before the position
    (NULL if none does)."""
    slot = F.struct("slot_no", "slot_ref", "lo", "hi")
    group = ["market", "_stretch"]
    # A bound at position p follows the item at p: ranges are open below.
    items = ranked.withColumns({"_slot": F.lit(None), "_at": F.col("position"), "_bound": F.lit(0)})
    bounds = ranges.where("market IS NOT NULL").select(
        "market", slot.alias("_slot"), F.col("lo").alias("_at"), F.lit(1).alias("_bound"))
    items = items.withColumn("_slot", F.col("_slot").cast(bounds.schema["_slot"].dataType))
    both = items.unionByName(bounds, allowMissingColumns=True).withColumn(
        "_stretch", F.floor(F.col("_at") / STRETCH))
    # The last bound of each stretch that has one, carried to the next such stretch's items and beyond.
    ends = bounds.withColumn("_stretch", F.floor(F.col("_at") / STRETCH)).groupBy(*group).agg(
        F.max_by("_slot", "_at").alias("_last"))
    known = both.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")
    earlier = Window.partitionBy("market").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = (known.join(ends, group, "left")
               .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier)).select(*group, "_carry")
               .where("_carry IS NOT NULL"))
    # Distinct bounds and distinct positions: a group has at most twice STRETCH rows.
    so_far = Window.partitionBy(*group).orderBy("_at", "_bound").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("_own", F.last("_slot", ignorenulls=True).over(so_far)).where("_bound = 0")
    return (swept.join(carried, group, "left")
            .withColumn("_slot", F.coalesce("_own", "_carry")).select(*ranked.columns, "_slot"))


def first_n_per_market(queue: DataFrame, n: int, order_col: str = "seq") -> DataFrame:
    """TOP-02: the first ``n`` queue rows per market with their position.

    A head needs no positions of the whole queue: the rank filter is planned as a
    group limit below the shuffle, so a task sends at most ``n`` rows of a market."""
    head = Window.partitionBy("market").orderBy(order_col, "item_id")
    return queue.withColumn("position", F.row_number().over(head)).where(F.col("position") <= n)
