"""Work queues over the tracker (FLT-01..03) and projection helpers (PRJ-01..03).

Each queue is a plain filter + projection, so Catalyst pushes the predicate
into the Parquet scan (``PushedFilters``) and reads only the needed columns.
The tracker's dates are normalised on load (FLT-06), so "NULL or zero date"
is ``isNull``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.functions import fixed


def _text(c: str, case_insensitive: bool) -> Column:
    """Binary comparison by default; the database's case-insensitive collation
    on request (``UTF8_LCASE``)."""
    col = F.col(c)
    return F.collate(col, "UTF8_LCASE") if case_insensitive else col


def _not_done(status: Column) -> Column:
    # NOT IN on NULL is NULL, hence the explicit NULL branch.
    return F.coalesce(~status.isin(list(fixed.DONE_STATUSES)), F.lit(True))


def _flag_not_true(flag: Column) -> Column:
    return F.coalesce(flag != fixed.FLAG_TRUE, F.lit(True))


def export_date_queue(tracker: DataFrame, columns=("item_id", "market")) -> DataFrame:
    """FLT-01: (item, market) whose export date is none.  Not distinct."""
    return tracker.where(F.col("export_date").isNull()).select(*columns)


def status_queue(tracker: DataFrame, columns=("item_id", "market"),
                 case_insensitive: bool = False) -> DataFrame:
    """FLT-02: status not in (TP, unblocked) or NULL, and export date none."""
    cond = _not_done(_text("status", case_insensitive)) & F.col("export_date").isNull()
    return tracker.where(cond).select(*columns)


def dimension_queue(tracker: DataFrame, reason_name: str,
                    columns=("item_id", "market"), case_insensitive: bool = False) -> DataFrame:
    """FLT-03: reason is ``reason_name`` (the caller's config), '' or NULL; status not done; and one of
    the two completeness flags is not 'True' (or NULL)."""
    reason = _text("reason", case_insensitive)
    flags = [_text(c, case_insensitive) for c in ("has_dimensions", "has_weight")]
    cond = ((reason.isNull() | reason.isin(reason_name, ""))
            & _not_done(_text("status", case_insensitive))
            & (_flag_not_true(flags[0]) | _flag_not_true(flags[1])))
    return tracker.where(cond).select(*columns)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ-01: rename columns."""
    return df.withColumnsRenamed(mapping)


def add_placeholders(df: DataFrame, columns: dict) -> DataFrame:
    """PRJ-03: constant / placeholder columns, ``{name: value_or_None}`` (NULL is string)."""
    return df.withColumns({
        name: (F.lit(value) if value is not None else F.lit(None).cast("string"))
        for name, value in columns.items()})
