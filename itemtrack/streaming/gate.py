"""JST-01 / AGG-06 over arriving status rows: a gate with a deadline instead of polling.

A status row names its run (the time its jobs were handed in), market, slot, phase, text and
time.  A stream keeps one small state per job in the state store: its first ending within the
deadline and the newest time seen.  Each micro-batch logs the jobs it touched.  The gates are a
function of the log, so they do not depend on how rows are dealt to batches; a batch that is
replayed finds its folder and changes nothing.

A market of a run *passes* when every job has ended well, *fails* when a job has failed or the
stream's time has passed the deadline of a job without an end, and is *pending* until then.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from itemtrack.operators.common import join_split
from itemtrack.operators.jobs import job_states
from itemtrack.session import path_exists
from itemtrack.streaming.ingest import KEEP_DAYS, stream_name

STATUS_SCHEMA = "run_at timestamp, market string, slot_no int, phase string, status_text string, at timestamp"
ENDS_SCHEMA = ("run_at timestamp, market string, slot_no int, end struct<at:timestamp,state:string>, "
               "seen timestamp, batch string")
JOB = ["run_at", "market", "slot_no"]
DEADLINE = _dt.timedelta(hours=4)


def job_ends(statuses: DataFrame, deadline: _dt.timedelta = DEADLINE, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Per job its first ending (``end``: time and state, null without one) and the newest time.

    A failure of either phase ends a job, a success only in the result phase; what happens after
    the deadline does not count, and of one moment a failure comes first.  Both aggregates are
    partial, so a job with many rows is reduced before the exchange.  On a stream, runs that are
    ``keep_days`` older than the newest are forgotten; rows without a run belong to none.
    """
    if deadline > _dt.timedelta(days=keep_days):
        raise ValueError("a run must be kept until its deadline")
    ends = (F.col("state") == "failed") | (~F.col("phase").eqNullSafe("submit") & (F.col("state") == "ok"))
    in_time = F.col("at") <= F.col("run_at") + F.lit(deadline)
    return (job_states(statuses.where(F.col("run_at").isNotNull())).withWatermark("run_at", f"{keep_days} days")
            .groupBy(*JOB).agg(F.min(F.when(ends & in_time, F.struct("at", "state"))).alias("end"),
                               F.max("at").alias("seen")))


def run_gates(ends: DataFrame, now: Column, deadline: _dt.timedelta = DEADLINE,
              expected: DataFrame | None = None) -> DataFrame:
    """run_at, market, jobs, late (jobs without an end at their deadline), gate and decided_at.

    ``expected`` (run_at, market, slot_no) are the jobs handed in: one that never reports is
    late like any other.  Without it only jobs that have reported are known.
    """
    if expected is not None:
        never = join_split(expected.select(*JOB).distinct(), ends.select(*JOB), JOB, "left_anti")
        ends = ends.unionByName(never, allowMissingColumns=True)
    limit = F.col("run_at") + F.lit(deadline)
    outcome = (F.when(F.col("end").isNotNull(), F.col("end.state"))
               .when(now > limit, "late").otherwise("pending"))
    bad = F.col("outcome").isin("failed", "late")
    jobs = ends.select(*JOB, outcome.alias("outcome"), F.coalesce("end.at", limit).alias("ended"))
    return (jobs.groupBy("run_at", "market")
            .agg(F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("outcome") == "late").alias("late"),
                 F.bool_or(bad).alias("_bad"), F.bool_and(F.col("outcome") == "ok").alias("_ok"),
                 F.min(F.when(bad, F.col("ended"))).alias("_first_bad"), F.max("ended").alias("_last"))
            .select("run_at", "market", "jobs", "late",
                    F.when(F.col("_bad"), "failed").when(F.col("_ok"), "passed").otherwise("pending").alias("gate"),
                    F.when(F.col("_bad"), F.col("_first_bad")).when(F.col("_ok"), F.col("_last")).alias("decided_at")))


@dataclass(frozen=True)
class JobLog:
    """Job states by batch under ``root``."""

    spark: SparkSession
    root: str

    def append(self, ends: DataFrame, name: str) -> None:
        folder = f"{self.root.rstrip('/')}/batch={name}"
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            ends.write.mode("overwrite").parquet(folder)

    def ends(self) -> DataFrame:
        """One row per job, from all batches and streams."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], ENDS_SCHEMA).drop("batch")
        rows = self.spark.read.schema(ENDS_SCHEMA).parquet(self.root)
        return rows.groupBy(*JOB).agg(F.min("end").alias("end"), F.max("seen").alias("seen"))

    def gates(self, deadline: _dt.timedelta = DEADLINE, lateness: _dt.timedelta = _dt.timedelta(0),
              expected: DataFrame | None = None, as_of: _dt.datetime | None = None) -> DataFrame:
        """The gates at ``as_of``; by default at the stream's own time: that of its newest row
        less ``lateness``, by which rows may arrive after later ones."""
        ends = self.ends()
        now = (F.lit(as_of) if as_of is not None
               else ends.select(F.max("seen")).scalar() - F.lit(lateness))
        return run_gates(ends, now, deadline, expected)

    def passed(self, **options) -> DataFrame:
        """Runs and markets whose results may be read."""
        return self.gates(**options).where(F.col("gate") == "passed").select("run_at", "market")


def start_gate_stream(spark: SparkSession, source_path: str, log: JobLog, checkpoint: str,
                      deadline: _dt.timedelta = DEADLINE, keep_days: int = KEEP_DAYS, available_now: bool = True,
                      max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """Follow a folder of status rows (``STATUS_SCHEMA``).  With ``available_now`` the stream takes
    what has arrived and stops."""
    reader = spark.readStream.schema(STATUS_SCHEMA).format(fmt).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = stream_name(checkpoint)
    writer = (job_ends(reader.load(source_path), deadline, keep_days).writeStream.outputMode("update")
              .foreachBatch(lambda batch, number: log.append(batch, f"{stream}-{number}"))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
