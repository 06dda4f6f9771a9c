"""AGG-06 over arriving status rows: passes at the last good end, fails at a failure or the deadline."""
import datetime as dt
import random

import pytest

from itemtrack.streaming import gate

T0 = dt.datetime(2024, 3, 5, 8)
HOUR = dt.timedelta(hours=1)
TEXTS = ["Success", "Job Error", "Executing", "Job Deleted", "Waiting for Resources", "?", None]


def plain_gates(rows, now, deadline, expected=()):
    """(run, market) -> (jobs, late, gate, time of the decision)."""
    jobs = {job: [] for job in expected}
    for run, market, slot, phase, text, at in rows:
        if run is not None:
            jobs.setdefault((run, market, slot), []).append((at, phase, text or ""))
    out = {}
    for (run, market, _), seen in jobs.items():
        ends = []
        for at, phase, text in seen:
            if at is None or at > run + deadline:
                continue
            if phase == "submit":
                bad = text != "Waiting for Resources" and "Executing" not in text and ("Error" in text or "Deleted" in text)
                good = False                          # handed in, but not ended
            else:
                good, bad = "Success" in text, "Error" in text or "Deleted" in text
            if good or bad:
                ends.append((at, "ok" if good else "failed"))
        end = min(ends, default=None)
        state = end[1] if end else "late" if now > run + deadline else "pending"
        out.setdefault((run, market), []).append((state, end[0] if end else run + deadline))
    gates = {}
    for key, jobs in out.items():
        bad = [t for s, t in jobs if s in ("failed", "late")]
        good = all(s == "ok" for s, _ in jobs)
        gates[key] = (len(jobs), sum(s == "late" for s, _ in jobs), "failed" if bad else "passed" if good else "pending",
                      min(bad) if bad else max(t for _, t in jobs) if good else None)
    return gates


def found(df):
    return {(r["run_at"], r["market"]): (r["jobs"], r["late"], r["gate"], r["decided_at"]) for r in df.collect()}


def some_rows(n=400, seed=4):
    rng = random.Random(seed)
    weights = [8, 1, 6, 1, 3, 1, 1]
    return [(None if rng.random() < .02 else T0 + rng.randrange(3) * dt.timedelta(days=1),
             rng.choice(["US", "UK", "DE", "FR", None]), rng.randrange(3), rng.choice(["submit", "result", None]),
             rng.choices(TEXTS, weights)[0]) for _ in range(n)]


def timed(rows, seed=5):
    rng = random.Random(seed)
    return [(*r, None if rng.random() < .02 else (r[0] or T0) + rng.randrange(400) * dt.timedelta(minutes=1)) for r in rows]


@pytest.mark.parametrize("per_trigger", [1, None])
def test_stream_equals_all_rows_at_once(spark, tmp_dir, per_trigger):
    rows = timed(some_rows())
    df = spark.createDataFrame(rows, gate.STATUS_SCHEMA)
    for part in range(4):                             # a job's rows are spread over files, in no order
        spark.createDataFrame(rows[part::4], gate.STATUS_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/in/p{part}")
    log = gate.JobLog(spark, f"{tmp_dir}/log")
    for _ in range(2):                                # started again: nothing new
        gate.start_gate_stream(spark, f"{tmp_dir}/in", log, f"{tmp_dir}/c",
                               max_files_per_trigger=per_trigger).awaitTermination()
    now = max(r[5] for r in rows if r[0] is not None and r[5] is not None)
    want = plain_gates(rows, now, gate.DEADLINE)
    assert found(log.gates()) == want
    assert len({g for _, _, g, _ in want.values()}) == 2
    for back in (3, 30):                              # a clock behind: later deadlines are still open
        assert found(log.gates(lateness=back * HOUR)) == plain_gates(rows, now - back * HOUR, gate.DEADLINE)
    ends = gate.job_ends(df)
    at = dt.datetime(2024, 3, 6, 9)
    from pyspark.sql import functions as F
    assert found(gate.run_gates(ends, F.lit(at))) == found(log.gates(as_of=at)) == plain_gates(rows, at, gate.DEADLINE)


def test_market_passes_then_deadline_fails_the_rest(spark, tmp_dir):
    log = gate.JobLog(spark, f"{tmp_dir}/log")
    expected = spark.createDataFrame([(T0, m, s) for m in ("US", "UK", "DE") for s in (1, 2)],
                                     "run_at timestamp, market string, slot_no int")

    def arrive(name, rows):
        full = [(T0, m, s, "result", text, T0 + h * HOUR) for m, s, text, h in rows]
        spark.createDataFrame(full, gate.STATUS_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/in/{name}")
        gate.start_gate_stream(spark, f"{tmp_dir}/in", log, f"{tmp_dir}/c").awaitTermination()
        return {k[1]: v for k, v in found(log.gates(expected=expected)).items()}

    first = arrive("a", [("US", 1, "Success", 1), ("US", 2, "Executing", 1), ("UK", 1, "Success", 1)])
    assert {m: g[2] for m, g in first.items()} == {"US": "pending", "UK": "pending", "DE": "pending"}
    second = arrive("b", [("US", 2, "Success", 2)])
    assert second["US"] == (2, 0, "passed", T0 + 2 * HOUR) and second["UK"][2] == "pending"
    third = arrive("c", [("UK", 2, "Success", 5)])    # after the deadline, which its time shows to have passed
    assert third["US"] == (2, 0, "passed", T0 + 2 * HOUR)
    assert third["UK"] == (2, 1, "failed", T0 + 4 * HOUR) and third["DE"] == (2, 2, "failed", T0 + 4 * HOUR)
    assert [(r["run_at"], r["market"]) for r in log.passed(expected=expected).collect()] == [(T0, "US")]


def test_replayed_batch_empty_log_and_old_runs(spark, tmp_dir):
    log = gate.JobLog(spark, f"{tmp_dir}/none")
    assert log.gates().count() == 0
    ends = gate.job_ends(spark.createDataFrame([(T0, "US", 1, "result", "Success", T0)], gate.STATUS_SCHEMA))
    log.append(ends, "x-0")
    log.append(ends.limit(0), "x-0")                  # a replay does not write again
    assert found(log.gates()) == {(T0, "US"): (1, 0, "passed", T0)}
    with pytest.raises(ValueError):
        gate.job_ends(ends, deadline=dt.timedelta(days=8))
