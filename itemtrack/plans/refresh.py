"""User-facing jobs PIP-01..04: each returns its outputs as DataFrames.

Nothing is collected: writing the outputs (SNK-01, a new tracker version) is
the caller's action, so one job can be planned and inspected as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from itemtrack.functions.scalars import completeness_flags, fill_empty, iso_date_text, zfill
from itemtrack.operators import changes, classify as cls, decide as dec, joins, lookups, queues
from itemtrack.operators.jobs import job_gate, passed_markets
from itemtrack.operators.quota import plan_batches
from itemtrack.operators.report import refresh_report, requested_markets
from itemtrack.schemas import TRACKER_KEY
from itemtrack.sources.warehouse import dimension_extract


def tracker_order(table: DataFrame, columns=TRACKER_KEY, seq_col: str = "seq") -> DataFrame:
    """The order of a table without an order of its own: by its primary key, so that "first
    row" does not depend on how the table's files were written.  Batch jobs and streams use
    this one rule."""
    return table if seq_col in table.columns else table.withColumn(seq_col, F.struct(*columns))


def refresh_export_dates(tracker: DataFrame, core_export: DataFrame, codes: DataFrame,
                         allow: DataFrame, markets=None) -> dict:
    """PIP-01: FLT-04 -> FLT-01 -> JON-05 -> WIN-01 -> JON-03 -> DML-05 -> AGG-07.

    ``markets``: requested markets (default: every market of the tracker).
    """
    spark = tracker.sparkSession
    trk = tracker if markets is None else tracker.where(F.col("market").isin(list(markets)))
    requested = (trk.select("market").distinct() if markets is None
                 else requested_markets(spark, markets))
    queue = queues.export_date_queue(lookups.allowed(trk, allow))
    queue = lookups.attach_code(queue, codes, strict=True)
    latest = joins.latest_export(core_export, keys=queue, by=("item_id", "market_code"))
    joined = joins.queue_with_latest(queue, latest)
    updates = joined.select("item_id", "market", F.col("exportable_date").alias("export_date"))
    # A key repeated in the queue repeats one and the same date.
    new_tracker = changes.set_export_dates(tracker, updates.withColumn("seq", F.col("export_date")))
    return {
        "queue": queue,
        "latest": latest,
        "updates": updates.withColumn("export_date_text", iso_date_text("export_date")),
        "tracker": new_tracker,
        "report": refresh_report(updates, requested, allow, queue),
        "skipped": lookups.skipped(requested, allow),
    }


def dimension_updates(rows: DataFrame, codes: DataFrame, strict: bool = True) -> DataFrame:
    """CMP-01 -> JON-05 on dimension result rows: (item_id, market, flags, seq)."""
    flagged = completeness_flags(fill_empty(rows))
    flagged = flagged.withColumn("market_code", F.col("marketplace_id").cast("int"))
    flagged = lookups.attach_market(flagged, codes, "market_code", strict=strict)
    cols = ["item_id", "market", "has_dimensions", "has_weight"]
    if "seq" in flagged.columns:
        # Arrival order, then the flags, so that "last one wins" is a total order.
        flagged = flagged.withColumn("seq", F.struct(F.col("seq").alias("seq"),
                                                     F.col("has_dimensions").alias("d"),
                                                     F.col("has_weight").alias("w")))
        cols.append("seq")
    return flagged.withColumn("item_id", zfill("asin")).select(*cols)


def refresh_dimensions(tracker: DataFrame, quotas: DataFrame, warehouse: DataFrame,
                       jobs: DataFrame, codes: DataFrame, regions: DataFrame, reason_name: str,
                       result_rows: DataFrame | None = None, scratch: str | None = None) -> dict:
    """PIP-02: FLT-03 -> WIN-06 -> SRC-06 -> AGG-06 -> (SRC-04/03) -> CMP-01 ->
    JON-05 -> DML-05.

    ``result_rows``: rows read from result files (SRC-04/03, with ``market``);
    when absent the warehouse extract of the planned batches is used directly.
    """
    queue = queues.dimension_queue(tracker, reason_name, columns=("item_id", "market", "seq"))
    assigned, unassigned = plan_batches(queue, quotas, store=scratch)
    gate = job_gate(jobs)
    passed = passed_markets(jobs)
    if result_rows is None:
        batch = assigned.join(passed, "market", "left_semi")
        result_rows = dimension_extract(warehouse, batch, codes, regions)
    else:
        result_rows = result_rows.join(passed, "market", "left_semi")
    updates = dimension_updates(result_rows, codes)
    new_tracker = changes.set_dimension_flags(tracker, updates)
    return {"queue": queue, "assigned": assigned, "unassigned": unassigned, "gate": gate,
            "rows": result_rows, "updates": updates, "tracker": new_tracker}


def prepare_observations(raw: DataFrame, codes: DataFrame, strict: bool = True, keep=()) -> DataFrame:
    """Result-file columns -> (item_id, market_code, market, contribution, reason_text,
    seq and the columns ``keep``): PRJ-02, STR-01, CST-01, JON-05, PRJ-01."""
    df = fill_empty(raw, ["asin", "marketplace_id", "contributions", "restriction_reasons"])
    df = df.select(
        zfill("asin").alias("item_id"),
        F.col("marketplace_id").cast("int").alias("market_code"),
        F.col("contributions").alias("contribution"),
        F.col("restriction_reasons").alias("reason_text"),
        "seq", *keep)
    return lookups.attach_market(df, codes, "market_code", strict=strict)


def decide_status(observations: DataFrame, tracker: DataFrame, rules: DataFrame,
                  mode: str = dec.AS_WRITTEN) -> DataFrame:
    """JON-06 -> AGG-04 -> JON-02/04 -> RUL-01..04 on prepared observations."""
    # Deduplication keeps every (item, market) key, so the tracker is restricted
    # by the keys of the unclassified observations (no classification in that
    # branch); AQE reuses the deduplication shuffle between the other branches.
    return decide_classified(cls.classify(observations, rules), tracker, mode, keys=observations)


def decide_classified(classified: DataFrame, tracker: DataFrame, mode: str = dec.AS_WRITTEN,
                      keys: DataFrame | None = None) -> DataFrame:
    """AGG-04 -> JON-02/04 -> RUL-01..04 on classified observations; ``keys``: rows with
    the same (item, market) keys, if they are cheaper to compute."""
    state = joins.first_state(joins.restrict_to_keys(tracker, classified if keys is None else keys))
    rows = joins.attach_state(dec.dedup_observations(classified), state)
    return dec.decide(rows, mode=mode)


def status_batches(tracker: DataFrame, quotas: DataFrame, scratch: str | None = None) -> dict:
    """PIP-03, planning: FLT-02 -> WIN-06, the items due and their quota batches."""
    queue = queues.status_queue(tracker, columns=("item_id", "market", "seq"))
    assigned, unassigned = plan_batches(queue, quotas, store=scratch)
    return {"queue": queue, "assigned": assigned, "unassigned": unassigned}


def refresh_status(tracker: DataFrame, raw_observations: DataFrame, rules: DataFrame,
                   codes: DataFrame, mode: str = dec.AS_WRITTEN) -> dict:
    """PIP-03: ... -> JON-06 -> STR-01 -> JON-05 -> JON-02/04 -> AGG-04 ->
    RUL-01..03 -> DML-10 -> DML-05."""
    obs = prepare_observations(raw_observations, codes)
    decisions = decide_status(obs, tracker, rules, mode)
    updates = changes.one_update_per_item_market(decisions)
    new_tracker = changes.set_reason_status(tracker, updates)
    return {"decisions": decisions, "updates": updates, "tracker": new_tracker}


def intake_inflow(tracker: DataFrame, history: DataFrame, inflow: DataFrame,
                  only_archived: bool = False) -> dict:
    """PIP-04: JON-01 -> DML-06/07 -> DML-03.  The two tables are one change: publish them
    with :func:`itemtrack.sources.sinks.commit_together`."""
    found = joins.inflow_lookup(tracker, inflow)
    moved_tracker, new_history = changes.archive_move(tracker, history, inflow, only_archived)
    new_tracker = changes.insert_new_inflow(moved_tracker, inflow)
    return {"found": found, "tracker": new_tracker, "history": new_history}
