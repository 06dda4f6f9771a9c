"""AGG-06 job gate over a job-status table (JST-01 states per job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from itemtrack.functions.scalars import job_state


def job_states(jobs: DataFrame) -> DataFrame:
    """JST-01: (market, slot_no, phase, status_text) -> + state."""
    return jobs.withColumn("state", job_state(F.col("phase"), F.col("status_text")))


def job_gate(jobs: DataFrame) -> DataFrame:
    """AGG-06: per market 'passed' when every job is ok, 'failed' when any job
    failed, else 'pending'.  Only passed markets feed results."""
    s = job_states(jobs)
    g = s.groupBy("market").agg(
        F.bool_and(F.col("state") == "ok").alias("_all_ok"),
        F.bool_or(F.col("state") == "failed").alias("_any_failed"),
        F.count(F.lit(1)).alias("jobs"))
    gate = (F.when(F.col("_any_failed"), "failed").when(F.col("_all_ok"), "passed")
            .otherwise("pending"))
    return g.select("market", "jobs", gate.alias("gate"))


def passed_markets(jobs: DataFrame) -> DataFrame:
    """Markets whose results may be read."""
    return job_gate(jobs).where(F.col("gate") == "passed").select("market")
