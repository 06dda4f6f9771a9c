"""STM-02: a day's files give one result however they are dealt to batches and streams."""
import datetime as dt
import itertools
import os

import pytest

from itemtrack import schemas
from itemtrack.operators import changes
from itemtrack.plans import refresh as P
from itemtrack.sources.sinks import VersionedTable
from itemtrack.streaming import ingest

HEADER = "\t".join(schemas.OBSERVATION_FILE_COLUMNS)
DAY = dt.datetime(2024, 3, 5, 12, tzinfo=dt.timezone.utc)


def write(path, rows, when=DAY):
    """rows: (item, market code, text); the text may hold a line break."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER] + [f"{i}\t{c}\tOperationalRule\t{t}\t{c}" for i, c, t in rows]) + "\n")
    os.utime(path, (when.timestamp(),) * 2)


@pytest.fixture()
def sheets(spark):
    codes = spark.createDataFrame([("US", 1, 1), ("UK", 2, 2)], "market string, market_code int, seq int")
    rules = spark.createDataFrame([(m, 1, "large", "LARGE") for m in ("US", "UK")]
                                  + [(m, 2, "heavy", "HEAVY") for m in ("US", "UK")],
                                  "market string, rule_no int, keyword string, blocker_type string")
    return rules, codes


def initial(spark):
    from tests.test_changes import tracker
    rows = [(f"{i:010d}", m, t, "WIP", f"OLD{i}{t}", i) for i in range(1, 8) for m in ("US", "UK") for t in ("A B", "A")]
    return tracker(spark, rows).drop("seq")


FILES = [("a", [(1, 1, "?"), (2, 1, "too large"), (3, 1, ""), (4, 1, "large"), (5, 1, '"so\nheavy"')]),
         ("b", [(1, 1, "too large"), (2, 2, "heavy"), (3, 1, ""), (4, 1, "heavy"), (6, 1, "")]),
         ("c", [(2, 1, "too large"), (4, 2, "large"), (7, 2, ""), (3, 1, "?"), (5, 1, "")])]


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*schemas.TRACKER_COLUMNS).collect())


def batch_job(spark, tracker, source, sheets):
    """The batch job over the same files."""
    rules, codes = sheets
    out = P.refresh_status(P.tracker_order(tracker), ingest.read_observations(spark, source), rules, codes)
    return rows(out["tracker"]), sorted(str(tuple(r)) for r in decisions(out["decisions"]))


def decisions(df):
    return df.select("item_id", "market", "new_reason", "reason_text", "reason", "next_reason", "next_status",
                     "rule").collect()


def test_one_file_a_trigger_equals_all_at_once(spark, tmp_dir, sheets):
    source = f"{tmp_dir}/in"
    for name, content in FILES:
        write(f"{source}/{name}.txt", content)
    tracker = initial(spark)
    want, want_decisions = batch_job(spark, tracker, source, sheets)
    for n, options in enumerate([{}, {"max_files_per_trigger": 1, "state_files_per_trigger": 1}]):
        store = ingest.tracker_store(spark, f"{tmp_dir}/t{n}", tracker)
        sink = f"{tmp_dir}/d{n}"
        stream = ingest.start_status_stream(spark, source, store, *sheets, f"{tmp_dir}/c{n}", decisions_sink=sink,
                                            **options)
        assert stream.awaitTermination(300)
        assert (store.current_version() > 1) == bool(options)
        assert rows(store.read(schema=schemas.TRACKER_SCHEMA)) == want
        assert sorted(str(tuple(r)) for r in decisions(spark.read.parquet(sink))) == want_decisions


def test_any_arrival_and_any_stream(spark, tmp_dir, sheets):
    """Files arrive one by one in every order, a second stream with its own checkpoint takes over
    and reads old files again: the log alone decides.  A replayed batch changes nothing."""
    tracker = initial(spark)
    for n, order in enumerate(list(itertools.permutations(range(3)))[3::2]):
        source, log = f"{tmp_dir}/in{n}", f"{tmp_dir}/log{n}"
        store = ingest.tracker_store(spark, f"{tmp_dir}/t{n}", tracker)
        for step, i in enumerate(order):
            write(f"{source}/{FILES[i][0]}.txt", FILES[i][1])
            ingest.start_status_log_stream(spark, source, store, log, *sheets, f"{tmp_dir}/c{n}-{step // 2}") \
                .awaitTermination(300)
        want = batch_job(spark, tracker, source, sheets)[0]
        assert store.current_version() == 0                        # the base is not rewritten
        assert rows(ingest.current_tracker(spark, store, log)) == want
    again = ingest.status_log_apply(store, ingest.DayLog(spark, log), ingest.stream_name(f"{tmp_dir}/c{n}-1"))
    again(spark.createDataFrame([], ingest.FIRSTS_SCHEMA).drop("batch"), 0)
    assert rows(ingest.current_tracker(spark, store, log)) == want
    # Folding keeps the state; later files of the day still count from the tracker before the day.
    assert ingest.compact(spark, store, log) == 1
    assert rows(store.read(schema=schemas.TRACKER_SCHEMA)) == want
    assert rows(ingest.current_tracker(spark, store, log)) == want
    write(f"{source}/d.txt", [(3, 1, "heavy"), (6, 1, "?")])
    ingest.start_status_log_stream(spark, source, store, log, *sheets, f"{tmp_dir}/c{n}-1").awaitTermination(300)
    assert rows(ingest.current_tracker(spark, store, log)) == batch_job(spark, tracker, source, sheets)[0]


def test_days_follow_each_other(spark, tmp_dir, sheets):
    """Each day is decided on its own, against the tracker the day before left; a file of the
    first day that comes last changes both days."""
    tracker, source = initial(spark), f"{tmp_dir}/in"
    store = ingest.tracker_store(spark, f"{tmp_dir}/t", tracker)
    first, second = [(1, 1, "large"), (2, 1, "heavy"), (3, 1, "?")], [(1, 1, ""), (2, 1, "large"), (2, 1, "heavy")]
    late = [(1, 1, "heavy")]
    sent = [("x", second, DAY + dt.timedelta(days=1)), ("y", first, DAY), ("z", late, DAY)]

    def by_days():
        state = P.tracker_order(tracker)
        for day in (DAY, DAY + dt.timedelta(days=1)):
            files = [f"{source}/{n}.txt" for n, _, when in sent if when == day and os.path.exists(f"{source}/{n}.txt")]
            if files:
                obs = ingest.read_observations(spark, files)
                state = P.refresh_status(state, obs, *sheets)["tracker"]
        return rows(state)

    for n, (name, content, when) in enumerate(sent):
        write(f"{source}/{name}.txt", content, when)
        ingest.start_status_stream(spark, source, store, *sheets, f"{tmp_dir}/c").awaitTermination(300)
        assert store.current_version() == n + 1
        assert rows(store.read(schema=schemas.TRACKER_SCHEMA)) == by_days()
    ingest.compact(spark, store, f"{store.root}-log", forget_before=DAY.date() + dt.timedelta(days=1))
    assert list(ingest.DayLog(spark, f"{store.root}-log").days()) == [DAY.date() + dt.timedelta(days=1)]


def test_changes_of_other_jobs_stay(spark, tmp_dir, sheets):
    tracker, source = initial(spark), f"{tmp_dir}/in"
    store = ingest.tracker_store(spark, f"{tmp_dir}/t", tracker)
    write(f"{source}/a.txt", [(1, 1, "large")])
    ingest.start_status_stream(spark, source, store, *sheets, f"{tmp_dir}/c").awaitTermination(300)
    flags = spark.createDataFrame([("0000000001", "US", "True", "True", 1)],
                                  "item_id string, market string, has_dimensions string, has_weight string, seq int")
    store.commit(changes.set_dimension_flags(store.read(schema=schemas.TRACKER_SCHEMA), flags))
    write(f"{source}/b.txt", [(1, 1, "heavy")])
    ingest.start_status_stream(spark, source, store, *sheets, f"{tmp_dir}/c").awaitTermination(300)
    got = {(r.reason, r.status, r.has_weight) for r in
           store.read().where("item_id = '0000000001' AND market = 'US'").collect()}
    assert got == {("LARGE,HEAVY", "WIP", "True")}


def test_a_key_collision_publishes_nothing(spark, tmp_dir, sheets):
    from tests.test_changes import tracker
    store = ingest.tracker_store(spark, f"{tmp_dir}/t", tracker(
        spark, [("0000000001", "US", "t", "WIP", "A", 1), ("0000000001", "US", "t", "WIP", "B", 2)]).drop("seq"))
    write(f"{tmp_dir}/in/a.txt", [(1, 1, "large")])
    with pytest.raises(Exception, match="collide"):
        ingest.start_status_stream(spark, f"{tmp_dir}/in", store, *sheets, f"{tmp_dir}/c").awaitTermination(300)
    assert store.current_version() == 0


# --------------------------------------------------------------- commits ----

def two_tables(spark, tmp_dir):
    df = spark.createDataFrame([("a", "US", 1), ("b", "UK", 1), ("c", None, 1)], "item_id string, market string, n int")
    tables = {n: VersionedTable(spark, f"{tmp_dir}/{n}") for n in ("tracker", "history")}
    for t in tables.values():
        t.commit(df)
    return df, tables


def content(table, version=None):
    return sorted((r["item_id"], r["market"] or "", r["n"]) for r in table.read(version=version).collect())


def test_two_tables_change_by_one_act(spark, tmp_dir, monkeypatch):
    from itemtrack.sources import sinks
    df, tables = two_tables(spark, tmp_dir)
    new = df.withColumn("n", df["n"] + 1)
    real = VersionedTable.prepare
    calls = []

    def dies_at_the_second(self, *args, **kw):
        calls.append(self)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, *args, **kw)

    monkeypatch.setattr(VersionedTable, "prepare", dies_at_the_second)
    parts = {n: (t, new) for n, t in tables.items()}
    with pytest.raises(RuntimeError):
        sinks.commit_together(parts, f"{tmp_dir}/commits")
    assert [t.current_version() for t in tables.values()] == [0, 0]
    # Dying after both writes, before the record, leaves the old pair as well.
    monkeypatch.setattr(VersionedTable, "prepare", real)
    write_text = VersionedTable._write_text

    def no_record(self, path, text):
        if "/commits/" in path and "_linked" not in path:
            raise RuntimeError("lost")
        write_text(self, path, text)

    monkeypatch.setattr(VersionedTable, "_write_text", no_record)
    with pytest.raises(RuntimeError):
        sinks.commit_together(parts, f"{tmp_dir}/commits")
    assert [t.current_version() for t in tables.values()] == [0, 0]
    monkeypatch.setattr(VersionedTable, "_write_text", write_text)
    assert sinks.commit_together(parts, f"{tmp_dir}/commits") == {"tracker": 1, "history": 1}
    both = sinks.read_together(tables)
    assert {r["n"] for t in both.values() for r in t.collect()} == {2}


def test_a_version_of_one_market(spark, tmp_dir):
    df, tables = two_tables(spark, tmp_dir)
    table = tables["tracker"]
    table.commit(df.where("market = 'UK'").withColumn("n", df["n"] + 5), replaces=["UK", "none"])
    assert content(table) == [("a", "US", 1), ("b", "UK", 6), ("c", "", 1)]
    assert [d for d in os.listdir(table.path(1)) if "=" in d] == ["market=UK"]
    table.commit(df.where("market = 'US'").withColumn("n", df["n"] + 7), replaces=["US"])
    table.commit(df.limit(0), replaces=["UK"])                     # a market that lost its rows
    assert content(table) == [("a", "US", 8), ("c", "", 1)]
    assert content(table, 1) == [("a", "US", 1), ("b", "UK", 6), ("c", "", 1)]
    assert table.read().where("market = 'US'").count() == 1
    # Old versions go, but not the files that the current one refers to.
    assert table.vacuum([]) == ["v=00000001"]
    assert content(table) == [("a", "US", 8), ("c", "", 1)] and table.versions() == [0, 2, 3]


def test_a_check_that_fails_publishes_nothing(spark, tmp_dir):
    df, tables = two_tables(spark, tmp_dir)

    def refuse(written):
        assert written.count() == 3
        raise ValueError("no")

    with pytest.raises(ValueError):
        tables["tracker"].commit(df, check=refuse)
    assert tables["tracker"].versions() == [0]


def test_an_update_reads_the_tracker_once(spark, tmp_dir):
    """Planning runs nothing, and the plan of a keyed update has one scan of the tracker."""
    store = ingest.tracker_store(spark, f"{tmp_dir}/t", initial(spark))
    updates = spark.createDataFrame([("0000000001", "US", "X", "TP", 1)],
                                    "item_id string, market string, reason string, status string, seq int")
    tracker_of_job = spark.sparkContext.statusTracker()
    before = tracker_of_job.getJobIdsForGroup(None)
    new = changes.set_reason_status(store.read(schema=schemas.TRACKER_SCHEMA), updates)
    assert tracker_of_job.getJobIdsForGroup(None) == before
    assert new._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1


def test_insert_exchanges_the_incoming_rows_once(spark, tmp_dir):
    from itemtrack.operators.common import materialize
    table = materialize(P.tracker_order(initial(spark)), "table")
    incoming = materialize(P.tracker_order(initial(spark)), "incoming")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changes.insert_if_absent(table, incoming)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2               # one a side


def test_landing_files_follow_from_bytes_not_from_tasks(spark, tmp_dir, sheets):
    """A result file read by many tasks lands in one small file, so that the day is decided once."""
    source = f"{tmp_dir}/in"
    write(f"{source}/a.txt", [(i % 7 + 1, 1 + i % 2, ("large", '"so\nheavy"', "?", "")[i % 4]) for i in range(300)])
    write(f"{source}/b.txt", FILES[1][1])
    tracker = initial(spark)
    store = ingest.tracker_store(spark, f"{tmp_dir}/t", tracker)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        stream = ingest.start_status_stream(spark, source, store, *sheets, f"{tmp_dir}/c", max_files_per_trigger=1,
                                            state_files_per_trigger=2)
        assert stream.awaitTermination(300)
        want = batch_job(spark, tracker, source, sheets)[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landed = [f for _, _, files in os.walk(f"{tmp_dir}/c/landing") for f in files if f.endswith(".parquet")]
    assert len(landed) == 2 and store.versions() == [0, 1]
    assert rows(store.read(schema=schemas.TRACKER_SCHEMA)) == want
