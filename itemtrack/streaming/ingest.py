"""STM-01 file-arrival ingest of result files and STM-02 status refresh by micro-batches.

All files of a day are decided as if they had been read at once, however they are dealt to
micro-batches and streams.  Two queries do it:

* *intake*: a file source reads every result file once (the checkpoint remembers which) as
  lines; ``foreachBatch`` parses (SRC-03) and classifies them (JON-06) into a landing table.
* *state*: a stream over the landing table keeps, per day, item, market, reason and text, the
  first row (AGG-04) as an aggregation in update mode: its keyed state lives in the state
  store, spread over tasks by the full key, and expires with the watermark.  Each micro-batch
  adds the keys that are new or got an earlier first row to the *day log*.

The decisions of a day (AGG-05, RUL) are a function of its first rows and of the tracker as
it was before the day's first update; the log remembers that version.  Rows are in file
order, days in calendar order, so batch numbers play no part.  Two forms apply the result:
*snapshots* (every micro-batch commits the next tracker version) and *merge on read* (only
the log is written, readers merge it, a compaction folds it into the next version).

A batch that is replayed finds its folder or its version's tag and changes nothing.  One
writer at a time (a stream or the compaction) is assumed.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack import schemas
from itemtrack.operators import changes, classify as cls
from itemtrack.operators.common import materialize
from itemtrack.operators.decide import AS_WRITTEN
from itemtrack.plans import refresh as P
from itemtrack.session import path_bytes, path_exists, remove_path, scratch_path
from itemtrack.sources.sinks import VersionedTable
from itemtrack.sources.tsv import number_lines, parse_lines, read_tolerant_tsv, scan_lines

UPDATE_COLUMNS = ["reason", "status"]
LANDING_BYTES = 64 << 20   # of rows in a landing file, about,
LANDING_FILES = 8          # if a batch needs no more files than so many; larger ones then
ROW_GROUP = 8 << 20        # bytes of a landing file that one task of the state query reads at least
KEEP_DAYS = 7              # a file this much older than the newest one seen is no longer taken

_ORDER = "struct<file:string,block:bigint,pos:bigint>"
LANDING_SCHEMA = (f"item_id string, market_code int, market string, contribution string, reason_text string, "
                  f"seq {_ORDER}, arrived timestamp, new_reason string")
LANDING_COLUMNS = ["item_id", "market_code", "market", "contribution", "reason_text", "seq", "arrived", "new_reason"]
FIRSTS_SCHEMA = (f"item_id string, market string, new_reason string, reason_text string, seq {_ORDER}, market_code int, "
                 "contribution string, batch string, day date")
FIRST_KEY = ["item_id", "market", "new_reason", "reason_text"]


# ------------------------------------------------------------------ STM-01 ----

def observation_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """STM-01: a streaming frame of result-file lines (``_line``, ``_file``,
    ``_file_mtime``, ``_block``); a file is never divided between batches, so its header
    and its quotes are in the batch: parse with :func:`observation_batch`."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return scan_lines(reader, path, seq_col=None)


def observation_batch(batch: DataFrame, columns=schemas.OBSERVATION_FILE_COLUMNS, seq_col: str = "seq") -> DataFrame:
    """Rows of a micro-batch of lines, in file order (file, split, position)."""
    return parse_lines(number_lines(batch, seq_col), columns, seq_col=seq_col)


def read_observations(spark: SparkSession, paths, columns=schemas.OBSERVATION_FILE_COLUMNS) -> DataFrame:
    """The same rows as a static frame (backfills)."""
    return read_tolerant_tsv(spark, paths, columns, recursiveFileLookup="true")


def stream_name(checkpoint: str) -> str:
    """Identity of a stream: its checkpoint folder."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def intake_apply(landing: str, rules: DataFrame, codes: DataFrame, stream: str):
    """The intake's ``foreachBatch`` function: rows of the files, classified, as one folder per batch.

    A state micro-batch takes a number of landing files and its cost is that of the whole day, so
    the files follow from the rows' size, not from how many tasks wrote them: the rows are
    written by all tasks first and then put together."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        folder = f"{landing.rstrip('/')}/batch={stream}-{batch_id}"
        if path_exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            return
        raw = observation_batch(batch).withColumnRenamed("_file_mtime", "arrived")
        rows = cls.classify(P.prepare_observations(raw, codes, keep=("arrived",)), rules)
        staged = scratch_path(batch.sparkSession, "intake")
        rows = materialize(rows.select(*LANDING_COLUMNS), path=staged)
        files = min(max(1, -(-path_bytes(batch.sparkSession, staged) // LANDING_BYTES)), LANDING_FILES)
        rows.coalesce(files).write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(folder)
        remove_path(batch.sparkSession, staged)

    return apply


# ----------------------------------------------------------------- day log ----

def first_rows(landed: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """First row per day (UTC, of the file) and observation key.  On a stream this is the
    keyed state; a day is forgotten once the watermark has passed it."""
    first = F.min(F.struct("seq", "market_code", "contribution")).alias("first")
    day = F.date_add(F.lit(_dt.date(1970, 1, 1)), F.floor(F.unix_seconds("w.start") / 86400).cast("int"))
    return (landed.withWatermark("arrived", f"{keep_days} days")
            .groupBy(F.window("arrived", "1 day").alias("w"), *FIRST_KEY).agg(first)
            .select(day.alias("day"), *FIRST_KEY, "first.*"))


@dataclass(frozen=True)
class DayLog:
    """First rows by batch and day under ``root/firsts``; under ``root/days`` the tracker
    version from before each day's first update."""

    spark: SparkSession
    root: str

    def _fs(self):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def append(self, firsts: DataFrame, name: str, store: VersionedTable) -> list[_dt.date]:
        """Write a batch's first rows (once) and return its days."""
        folder = f"{self.root.rstrip('/')}/firsts/batch={name}"
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            firsts.write.mode("overwrite").partitionBy("day").parquet(folder)
        # As many days as the watermark lets through.
        days = [r["day"] for r in self._firsts().where(F.col("batch") == name).select("day").distinct().collect()]
        for day in sorted(set(days) - set(self.days())):
            jvm = self.spark.sparkContext._jvm
            self._fs().mkdirs(jvm.org.apache.hadoop.fs.Path(
                f"{self.root.rstrip('/')}/days/day={day}/base={store.current_version():08d}"))
        return days

    def days(self) -> dict[_dt.date, int]:
        """Logged days and the tracker version each starts from."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        where = jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/days")
        out = {}
        for day in fs.listStatus(where) if fs.exists(where) else ():
            bases = [int(b.getPath().getName()[5:]) for b in fs.listStatus(day.getPath())]
            if bases:
                out[_dt.date.fromisoformat(day.getPath().getName()[4:])] = min(bases)
        return dict(sorted(out.items()))

    def _firsts(self) -> DataFrame:
        return self.spark.read.schema(FIRSTS_SCHEMA).parquet(f"{self.root.rstrip('/')}/firsts")

    def firsts(self, day: _dt.date) -> DataFrame:
        """The day's first rows; of a key that several batches or streams brought, the earliest."""
        rows = self._firsts().where(F.col("day") == day)
        return (rows.groupBy(*FIRST_KEY).agg(F.min(F.struct("seq", "market_code", "contribution")).alias("first"))
                .select(*FIRST_KEY, "first.*"))

    def forget(self, before: _dt.date) -> None:
        """Drop days that no stream adds to any more; their updates must be in the tracker."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        for day in [d for d in self.days() if d < before]:
            for batch in fs.globStatus(jvm.org.apache.hadoop.fs.Path(
                    f"{self.root.rstrip('/')}/firsts/batch=*/day={day}")):
                fs.delete(batch.getPath(), True)
            remove_path(self.spark, f"{self.root.rstrip('/')}/days/day={day}")


def day_decisions(store: VersionedTable, log: DayLog, since: _dt.date | None = None,
                  mode: str = AS_WRITTEN) -> dict[_dt.date, tuple[DataFrame, DataFrame]]:
    """Decisions and updates of every logged day from ``since`` on, each against the tracker
    before that day with the updates of the earlier days."""
    out: dict = {}
    days = {d: base for d, base in log.days().items() if since is None or d >= since}
    for place, (day, base) in enumerate(days.items()):
        state = P.tracker_order(store.read(schema=schemas.TRACKER_SCHEMA, version=base))
        for _, updates in out.values():
            state = changes.keyed_update(state, updates, UPDATE_COLUMNS)
        decisions = P.decide_classified(log.firsts(day), state, mode)
        updates = changes.one_update_per_item_market(decisions)
        if place < len(days) - 1:                    # read once more by every later day
            updates = materialize(updates, "day-updates")
        out[day] = (decisions, updates)
    return out


def _apply_days(table: DataFrame, decided: dict) -> tuple[DataFrame, DataFrame | None]:
    """The table with the updates of all decided days (the last day wins), and the updates."""
    if not decided:
        return table, None
    parts = [u.withColumn("seq", F.struct(F.lit(day).alias("day"), F.col("seq").alias("seq")))
             for day, (_, u) in decided.items()]
    updates = changes.union_by_name(*parts)
    return changes.keyed_update(table, updates, UPDATE_COLUMNS), updates


# ------------------------------------------------------------------ STM-02 ----

def status_apply(store: VersionedTable, log: DayLog, stream: str, mode: str = AS_WRITTEN,
                 decisions_sink: str | None = None, check_keys: bool = True):
    """STM-02 in snapshots, ``foreachBatch`` over changed first rows: log them, decide the days
    they touch anew and commit the next tracker version.  Decisions go to one folder per day,
    overwritten.  With ``check_keys`` a key collision fails the batch before its version is
    published (the reference's database would refuse the update)."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream}-{batch_id}"
        if store.has_tag(tag):
            return
        spark = batch.sparkSession
        touched = log.append(batch, tag, store)
        if not touched:
            return
        decided = day_decisions(store, log, min(touched), mode)
        if decisions_sink:
            for day, (decisions, _) in decided.items():
                decisions.drop("seq").write.mode("overwrite").parquet(f"{decisions_sink.rstrip('/')}/day={day}")
            spark.catalog.refreshByPath(decisions_sink)
        decided = {d: (x, materialize(u, "day-updates")) for d, (x, u) in decided.items()}
        tracker, updates = _apply_days(store.read(schema=schemas.TRACKER_SCHEMA), decided)
        check = (lambda written: changes.require_distinct_keys(written, updates)) if check_keys else None
        store.commit(tracker, tag=tag, check=check)

    return apply


def status_log_apply(store: VersionedTable, log: DayLog, stream: str):
    """STM-02 as merge on read: a micro-batch writes only its changed first rows."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, f"{stream}-{batch_id}", store)

    return apply


class StatusStream:
    """The two queries of a status refresh.  With ``available_now`` they process what has
    arrived, one after the other, and stop (the replacement of the reference's polling);
    otherwise both run until stopped."""

    def __init__(self, spark: SparkSession, source_path: str, rules: DataFrame, codes: DataFrame, checkpoint: str,
                 apply, available_now: bool = True, max_files_per_trigger: int | None = None,
                 state_files_per_trigger: int | None = None, keep_days: int = KEEP_DAYS):
        root = checkpoint.rstrip("/")
        self.spark, self.available_now, self.keep_days = spark, available_now, keep_days
        self.landing, self.apply = f"{root}/landing", apply
        self.state_files, self.state_checkpoint = state_files_per_trigger, f"{root}/state"
        intake = intake_apply(self.landing, rules, codes, stream_name(checkpoint))
        self.queries = [self._start(observation_stream(spark, source_path, max_files_per_trigger), intake,
                                    f"{root}/intake", "append")]
        if not available_now:
            self._start_state()

    def _start(self, frame: DataFrame, apply, checkpoint: str, mode: str):
        writer = frame.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if self.available_now else writer).start()

    def _start_state(self) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.landing)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
        # A batch folder that is written again after a failure holds the same rows: first rows do not change.
        reader = (self.spark.readStream.schema(LANDING_SCHEMA).option("recursiveFileLookup", "true")
                  .option("ignoreMissingFiles", "true"))
        if self.state_files:
            reader = reader.option("maxFilesPerTrigger", self.state_files)
        self.queries.append(self._start(first_rows(reader.parquet(self.landing), self.keep_days), self.apply,
                                        self.state_checkpoint, "update"))

    def awaitTermination(self, timeout: int | None = None) -> bool:
        """Wait for the queries; False if one still runs after ``timeout`` seconds."""
        if self.available_now and len(self.queries) == 1:
            if self.queries[0].awaitTermination(timeout) is False:
                return False
            self._start_state()
        return all(q.awaitTermination(timeout) is not False for q in self.queries)

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def start_status_stream(spark: SparkSession, source_path: str, store: VersionedTable, rules: DataFrame,
                        codes: DataFrame, checkpoint: str, mode: str = AS_WRITTEN, available_now: bool = True,
                        decisions_sink: str | None = None, check_keys: bool = True, log_root: str | None = None,
                        **options) -> StatusStream:
    """Run STM-01 + STM-02 in snapshots.  Streams that share a tracker share ``log_root``
    (default: beside the tracker's versions)."""
    log = DayLog(spark, log_root or f"{store.root}-log")
    apply = status_apply(store, log, stream_name(checkpoint), mode, decisions_sink, check_keys)
    return StatusStream(spark, source_path, rules, codes, checkpoint, apply, available_now, **options)


def start_status_log_stream(spark: SparkSession, source_path: str, store: VersionedTable, log_root: str,
                            rules: DataFrame, codes: DataFrame, checkpoint: str, available_now: bool = True,
                            **options) -> StatusStream:
    """STM-01 + merge-on-read STM-02."""
    apply = status_log_apply(store, DayLog(spark, log_root), stream_name(checkpoint))
    return StatusStream(spark, source_path, rules, codes, checkpoint, apply, available_now, **options)


def tracker_store(spark: SparkSession, root: str, initial: DataFrame | None = None) -> VersionedTable:
    """A versioned tracker folder; ``initial`` becomes version 0 when it is empty."""
    store = VersionedTable(spark, root)
    if store.current_version() is None:
        if initial is None:
            initial = spark.createDataFrame([], schemas.TRACKER_SCHEMA)
        store.commit(initial)
    return store


def current_tracker(spark: SparkSession, store: VersionedTable, log_root: str, mode: str = AS_WRITTEN) -> DataFrame:
    """Merge on read: the current version with the updates of all logged days applied."""
    return _apply_days(store.read(schema=schemas.TRACKER_SCHEMA),
                       day_decisions(store, DayLog(spark, log_root), None, mode))[0]


def compact(spark: SparkSession, store: VersionedTable, log_root: str, mode: str = AS_WRITTEN,
            check_keys: bool = True, forget_before: _dt.date | None = None) -> int:
    """Fold the log into the next tracker version.  Days stay logged, as later files can
    still change their decisions; those before ``forget_before`` (older than the streams'
    ``keep_days``) are dropped once the version is published."""
    log = DayLog(spark, log_root)
    decided = {d: (x, materialize(u, "day-updates")) for d, (x, u) in day_decisions(store, log, None, mode).items()}
    tracker, updates = _apply_days(store.read(schema=schemas.TRACKER_SCHEMA), decided)
    check = (lambda written: changes.require_distinct_keys(written, updates)) if check_keys and decided else None
    version = store.commit(tracker, check=check)
    if forget_before is not None:
        log.forget(forget_before)
    return version
