"""Keyed changes on the tracker and history (DML-01..10, SET-01/02).

The tables are immutable snapshots: every function returns the next snapshot as
a DataFrame (write it with :mod:`itemtrack.sources.sinks`).  Keys may hold
NULLs after zero-date normalisation, so full-key comparisons are null-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack import schemas
from itemtrack.operators.common import any_case, join_split, keep_first, keep_last
from itemtrack.schemas import DELETE_KEY, ITEM_MARKET, TRACKER_KEY


class KeyCollision(ValueError):
    """Two tracker rows would share the full primary key."""


def union_by_name(*frames: DataFrame) -> DataFrame:
    """SET-01: union all, aligned by name, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keyed_difference(table: DataFrame, keys: DataFrame, on=DELETE_KEY) -> DataFrame:
    """SET-02: table rows whose key is not among ``keys`` (anti join)."""
    on = list(on)
    return join_split(table, keys.select(*on).distinct(), on, "left_anti")


def align(df: DataFrame, like: DataFrame, keep=()) -> DataFrame:
    """Columns of ``like`` in its order and types, missing ones NULL (defaults);
    ``keep`` names extra columns of ``df`` carried along at the end."""
    out = []
    for f in like.schema.fields:
        out.append((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
                   .alias(f.name))
    extra = [c for c in keep if c in df.columns and c not in like.columns]
    return df.select(*out, *extra)


def _need_order(df: DataFrame, order_col: str) -> None:
    # "First" and "last" of a repeated key mean something only under a stated order.
    if order_col not in df.columns:
        raise ValueError(f"the incoming rows need their arrival order in column {order_col!r}")


def insert_if_absent(table: DataFrame, incoming: DataFrame, key=TRACKER_KEY,
                     order_col: str = "seq", ignore_case: bool = False) -> DataFrame:
    """DML-01/02: append incoming rows whose full key is absent; conflicts are
    ignored; among in-batch duplicates the first (by ``order_col``) wins.

    The ten-column key is one text (JSON, which tells NULL from every value): the
    deduplication groups by it and the anti join compares it, so the incoming rows
    are exchanged once, after their map-side reduction.  ``ignore_case``: keys that
    differ in case only are equal.
    """
    key = list(key)
    _need_order(incoming, order_col)
    incoming = incoming.withColumn("_order", F.col(order_col))
    if order_col in table.columns and table.schema[order_col].dataType != incoming.schema[order_col].dataType:
        incoming = incoming.drop(order_col)          # an order of the batch alone
    # Columns the batch lacks take their defaults (NULL) before keys are compared.
    incoming = align(incoming, table, keep=["_order"])
    text = F.to_json(F.struct(*key))
    if ignore_case:
        text = any_case(text)
    first = keep_first(incoming.withColumn("_key", text), ["_key"], "_order")
    new_rows = first.join(table.select(text.alias("_key")), "_key", "left_anti")
    return table.unionByName(align(new_rows, table))


def insert_partial(table: DataFrame, incoming: DataFrame, columns,
                   order_col: str = "seq", ignore_case: bool = False) -> DataFrame:
    """DML-03/04: insert-if-absent of rows that carry only ``columns``; the rest
    take their defaults (NULL)."""
    cols = list(columns) + ([order_col] if order_col in incoming.columns else [])
    return insert_if_absent(table, incoming.select(*cols), order_col=order_col, ignore_case=ignore_case)


def insert_new_inflow(table: DataFrame, inflow: DataFrame, order_col: str = "seq") -> DataFrame:
    """DML-03: the 11-column new-inflow insert."""
    return insert_partial(table, inflow, schemas.INFLOW_INSERT_COLUMNS, order_col)


def keyed_update(table: DataFrame, updates: DataFrame, set_cols, key=ITEM_MARKET,
                 order_col: str = "seq", ignore_case: bool = False) -> DataFrame:
    """DML-05: set ``set_cols`` on every table row whose key matches.

    Repeated update keys: the last (by ``order_col``) wins; an explicit NULL
    overwrites; unmatched updates are dropped.  The updated columns may be part
    of the full key, so two rows of one (item, market) can collide afterwards: all
    rows are kept, and :func:`require_distinct_keys` tells, once the result is written.
    ``ignore_case``: keys match whatever their case; the table's own keys stay as written.
    """
    key, set_cols = list(key), list(set_cols)
    _need_order(updates, order_col)
    last = keep_last(updates.select(*key, *set_cols, order_col), key, order_col, ignore_case)
    new = last.select(*key, *[F.col(c).alias(f"_new_{c}") for c in set_cols],
                      F.lit(True).alias("_matched"))
    joined = join_split(table, new, key, "left", ignore_case)
    out = joined.withColumns({
        c: F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).cast(table.schema[c].dataType)
        for c in set_cols})
    return out.select(*table.columns)


def require_distinct_keys(table: DataFrame, updates: DataFrame, key=ITEM_MARKET,
                          full_key=TRACKER_KEY, ignore_case: bool = False) -> None:
    """Raise :class:`KeyCollision` if two rows of ``table`` share the full key, as the database
    would.  Only rows whose ``key`` was updated can, so only those are looked at; ``table`` is the
    written result of the update (see ``check`` of :meth:`VersionedTable.commit`)."""
    touched = join_split(table.select(*full_key), updates.select(*key).distinct(), list(key), "left_semi",
                         ignore_case)
    if ignore_case:
        texts = [f.name for f in touched.schema.fields if f.dataType.typeName() == "string"]
        touched = touched.withColumns({c: any_case(c) for c in texts})
    dup = touched.groupBy(*full_key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise KeyCollision(f"the update makes the primary key collide: {dup[0].asDict()}")


def set_export_dates(table: DataFrame, updates: DataFrame, **kw) -> DataFrame:
    """DML-05, live form: export date by (item, market)."""
    return keyed_update(table, updates, ["export_date"], **kw)


def set_dimension_flags(table: DataFrame, updates: DataFrame, **kw) -> DataFrame:
    """DML-05: completeness flags by (item, market)."""
    return keyed_update(table, updates, ["has_dimensions", "has_weight"], **kw)


def set_reason_status(table: DataFrame, updates: DataFrame, **kw) -> DataFrame:
    """DML-05: reason and status by (item, market)."""
    return keyed_update(table, updates, ["reason", "status"], **kw)


def archive_candidates(tracker: DataFrame, inflow: DataFrame) -> DataFrame:
    """DML-06 selection: 'unblocked' tracker rows whose (item, market) is in the inflow."""
    return (tracker.where(F.col("status") == "unblocked")
            .transform(join_split, inflow.select(*ITEM_MARKET).distinct(), ITEM_MARKET, "left_semi"))


def archive_move(tracker: DataFrame, history: DataFrame, inflow: DataFrame,
                 only_archived: bool = False, order_col: str = "seq"):
    """DML-06 + DML-07: returns ``(new_tracker, new_history)``.

    The candidates are inserted into history if absent (all columns); then the
    tracker loses every row of their (item, market, target) triples -- also
    rows of another status, which were not archived -- unless ``only_archived``.
    """
    moved = archive_candidates(tracker, inflow)
    carry = [order_col] if order_col in moved.columns and order_col not in history.columns else []
    new_history = insert_if_absent(history, moved.select(*history.columns, *carry),
                                   order_col=order_col)
    triples = moved.select(*DELETE_KEY).distinct().withColumn("_hit", F.lit(True))
    marked = join_split(tracker, triples, DELETE_KEY, "left")
    gone = F.coalesce(F.col("_hit"), F.lit(False))
    if only_archived:
        gone = gone & (F.col("status") == "unblocked")
    new_tracker = marked.where(~gone).select(*tracker.columns)
    return new_tracker, new_history


def bulk_delete_unblocked(tracker: DataFrame) -> DataFrame:
    """DML-08: drop every (item, market, target) triple that has an 'unblocked' row."""
    triples = tracker.where(F.col("status") == "unblocked").select(*DELETE_KEY).distinct()
    return join_split(tracker, triples, DELETE_KEY, "left_anti")


def create_table(spark: SparkSession, path: str, schema=schemas.TRACKER_SCHEMA,
                 partition_by="market") -> DataFrame:
    """DML-09: an empty table with the fixed schema, partitioned by market."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("errorifexists").partitionBy(partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def one_update_per_item_market(decisions: DataFrame, order_col: str = "seq") -> DataFrame:
    """DML-10: first decision row per (market, item); NULL becomes ''.  Feeds DML-05
    as (item_id, market, reason, status)."""
    first = keep_first(decisions.select("item_id", "market", "next_reason", "next_status",
                                        order_col), ["market", "item_id"], order_col)
    return first.select(
        "item_id", "market",
        F.coalesce("next_reason", F.lit("")).alias("reason"),
        F.coalesce("next_status", F.lit("")).alias("status"),
        order_col)
