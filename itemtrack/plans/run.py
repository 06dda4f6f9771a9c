"""Run the refresh jobs on real folders (the user-facing entry point).

    python -m itemtrack.plans.run export-dates --tracker T --core-export C --config K --out O
    python -m itemtrack.plans.run dimensions   --tracker T --warehouse W --config K --out O
    python -m itemtrack.plans.run status       --tracker T --results R --config K --out O
    python -m itemtrack.plans.run intake       --tracker T --history H --inflow I --out O

``T`` and ``H`` are versioned table folders (:class:`VersionedTable`); each run
commits the next version and writes its snapshots (SNK-01) under ``O/<job>/``.
``K`` holds the config sheets as CSV with a header row, in sheet order:
``codes.csv`` (market, market_code), ``rules.csv`` (market, keyword,
blocker_type), ``quotas.csv`` (market, capacity, slot_ref), ``allow.csv``
(market) and ``jobs.csv`` (market, slot_no, phase, status_text).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack import schemas
from itemtrack.operators import changes, lookups, report
from itemtrack.plans import refresh as R
from itemtrack.session import path_exists, remove_path, scratch_path
from itemtrack.sources import sinks, tables, tsv
from itemtrack.sources.sinks import VersionedTable

SHEETS = {
    "codes": "market string, market_code int",
    "rules": "market string, keyword string, blocker_type string",
    "quotas": "market string, capacity int, slot_ref string",
    "allow": "market string",
    "jobs": "market string, slot_no int, phase string, status_text string",
}


def load_config(spark: SparkSession, config_dir: str) -> dict:
    """SRC-07: the config sheets, with sheet order kept as ``seq`` and rule /
    slot numbers derived from it."""
    out = {}
    for name, schema in SHEETS.items():
        path = f"{config_dir.rstrip('/')}/{name}.csv"
        if path_exists(spark, path):
            out[name] = tables.read_lookup(spark, path, schema, order_col="seq")
    if "rules" in out:
        out["rules"] = tables.number_rows(out["rules"], "rule_no", ["market"], ["seq"])
    if "quotas" in out:
        out["quotas"] = tables.number_rows(out["quotas"], "slot_no", ["market"], ["seq"])
    return out


def _sheet(cfg: dict, name: str) -> DataFrame:
    if name not in cfg:
        raise FileNotFoundError(f"this job needs the config sheet {name}.csv")
    return cfg[name]


def _ordered(df: DataFrame) -> DataFrame:
    return tables.normalize_tracker(R.tracker_order(df))


def _read_store(spark, root):
    store = VersionedTable(spark, root)
    return store, _ordered(store.read(schema=schemas.TRACKER_SCHEMA))


def _commit_updates(store: VersionedTable, tracker: DataFrame, set_columns, updates: DataFrame) -> int:
    """DML-05 on the stored tracker: only the partitions of markets that have updates are
    written, the key check reads the written version, then it is published."""
    markets = [r["market"] for r in updates.select("market").distinct().collect()]   # as many as the config names
    touched = tracker.where(F.col("market").isin([m for m in markets if m is not None]))
    new = set_columns(touched, updates).drop("seq")
    return store.commit(new, replaces=[m for m in markets if m is not None],
                        check=lambda written: changes.require_distinct_keys(written, updates))


def _publish(out_dir: str, job: str, frames: dict, fmt: str = "parquet") -> dict:
    """Write the snapshots of a run; returns them as read back, so that later steps do not
    compute them again."""
    out = {}
    for name, df in frames.items():
        df = df if name in ("decisions", "updates") else df.drop("seq")
        part = "market" if "market" in df.columns and len(df.columns) > 1 else None
        path = sinks.write_snapshot(df, f"{out_dir.rstrip('/')}/{job}/{name}", fmt=fmt, partition_by=part)
        if fmt == "parquet":
            out[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return out


def export_dates(spark, tracker_root, core_export_path, config_dir, out_dir, markets=None):
    """PIP-01 end to end; publishes the work queue, the latest-export table, the updates,
    the report and the skipped markets."""
    store, tracker = _read_store(spark, tracker_root)
    cfg = load_config(spark, config_dir)
    core = tables.read_core_export(core_export_path, spark=spark)
    res = R.refresh_export_dates(tracker, core, _sheet(cfg, "codes"), _sheet(cfg, "allow"), markets)
    # The joins behind the updates run once: report and tracker are made from the written updates.
    written = _publish(out_dir, "export_dates", {k: res[k] for k in ("queue", "latest", "updates", "skipped")})
    requested = tracker.select("market").distinct() if markets is None else report.requested_markets(spark, markets)
    _publish(out_dir, "export_dates", {"report": report.refresh_report(
        written["updates"], requested, _sheet(cfg, "allow"), written["queue"])})
    updates = written["updates"].withColumn("seq", F.col("export_date"))
    return _commit_updates(store, tracker, changes.set_export_dates, updates)


def dimensions(spark, tracker_root, warehouse_path, config_dir, out_dir, reason_name,
               results_root=None, day=None):
    """PIP-02 end to end; reads result files (SRC-04/03) when ``results_root`` is given."""
    store, tracker = _read_store(spark, tracker_root)
    cfg = load_config(spark, config_dir)
    rows = None
    if results_root:
        rows = tsv.discover_result_files(spark, results_root, schemas.DIMENSION_FILE_COLUMNS,
                                         passed_markets=R.passed_markets(_sheet(cfg, "jobs")), day=day)
    scratch = scratch_path(spark, "positions")
    res = R.refresh_dimensions(tracker, _sheet(cfg, "quotas"), spark.read.parquet(warehouse_path),
                               _sheet(cfg, "jobs"), _sheet(cfg, "codes"), lookups.region_pairs(spark),
                               reason_name, result_rows=rows, scratch=scratch)
    written = _publish(out_dir, "dimensions", {k: res[k] for k in ("assigned", "unassigned", "gate", "updates")})
    version = _commit_updates(store, tracker, changes.set_dimension_flags, written["updates"])
    remove_path(spark, scratch)
    return version


def status(spark, tracker_root, results_root, config_dir, out_dir, day=None,
           mode="as_written"):
    """PIP-03 end to end: work queue and batches (published for the next submission), job
    gate, result files of the day, decisions (written once, the update is made from the
    written table), keyed update."""
    store, tracker = _read_store(spark, tracker_root)
    cfg = load_config(spark, config_dir)
    codes = _sheet(cfg, "codes")
    if "quotas" in cfg:
        scratch = scratch_path(spark, "positions")
        batches = R.status_batches(tracker, cfg["quotas"], scratch=scratch)
        _publish(out_dir, "status", batches)
        remove_path(spark, scratch)
    raw = tsv.discover_result_files(spark, results_root, schemas.OBSERVATION_FILE_COLUMNS,
                                    passed_markets=R.passed_markets(_sheet(cfg, "jobs")), day=day)
    obs = R.prepare_observations(raw, codes)
    written = _publish(out_dir, "status", {"decisions": R.decide_status(obs, tracker, _sheet(cfg, "rules"), mode)})
    updates = changes.one_update_per_item_market(written["decisions"])
    written = _publish(out_dir, "status", {"updates": updates})
    return _commit_updates(store, tracker, changes.set_reason_status, written["updates"])


def intake(spark, tracker_root, history_root, inflow_path, out_dir, only_archived=False):
    """PIP-04 end to end; tracker and history change by one act."""
    store, hstore = VersionedTable(spark, tracker_root), VersionedTable(spark, history_root)
    both = sinks.read_together({"tracker": store, "history": hstore}, schemas.TRACKER_SCHEMA)
    tracker, history = _ordered(both["tracker"]), _ordered(both["history"])
    inflow = spark.read.parquet(inflow_path)
    inflow = R.tracker_order(inflow, [c for c in schemas.INFLOW_INSERT_COLUMNS if c in inflow.columns])
    res = R.intake_inflow(tracker, history, inflow, only_archived)
    _publish(out_dir, "intake", {"found": res["found"]})
    made = sinks.commit_together({"history": (hstore, res["history"].drop("seq")),
                                  "tracker": (store, res["tracker"].drop("seq"))}, f"{store.root}-commits")
    return made["tracker"], made["history"]


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="itemtrack")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("export-dates")
    a.add_argument("--tracker", required=True)
    a.add_argument("--core-export", required=True)
    a.add_argument("--config", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--markets", nargs="*")
    d = sub.add_parser("dimensions")
    d.add_argument("--tracker", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--config", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--reason-name", required=True)
    d.add_argument("--results")
    d.add_argument("--day")
    s = sub.add_parser("status")
    s.add_argument("--tracker", required=True)
    s.add_argument("--results", required=True)
    s.add_argument("--config", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--day")
    s.add_argument("--mode", default="as_written", choices=["as_written", "per_market"])
    i = sub.add_parser("intake")
    i.add_argument("--tracker", required=True)
    i.add_argument("--history", required=True)
    i.add_argument("--inflow", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--only-archived", action="store_true")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"itemtrack-{args.job}").getOrCreate()
    if args.job == "export-dates":
        v = export_dates(spark, args.tracker, args.core_export, args.config, args.out, args.markets)
    elif args.job == "dimensions":
        v = dimensions(spark, args.tracker, args.warehouse, args.config, args.out, args.reason_name,
                       args.results, args.day)
    elif args.job == "status":
        v = status(spark, args.tracker, args.results, args.config, args.out, args.day, args.mode)
    else:
        v = intake(spark, args.tracker, args.history, args.inflow, args.out, args.only_archived)
    print(f"{args.job}: committed version {v}")


if __name__ == "__main__":
    main()
