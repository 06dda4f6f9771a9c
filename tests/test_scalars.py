import datetime as dt

from pyspark.sql import functions as F

from itemtrack.functions import scalars as S


def one(spark, col, value=None, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col.alias("y")).first()["y"]


def test_zfill_pads_and_never_cuts(spark):
    rows = [("123",), ("0012345678",), ("12345678901",), ("-42",), ("",)]
    df = spark.createDataFrame(rows, "x string").select("x", S.zfill("x").alias("y"))
    got = {r.x: r.y for r in df.collect()}
    for (x,) in rows:
        assert got[x] == x.zfill(10)


def test_run_dates_golden(spark):
    # On Tue 2024-01-02: two days ago 2023/12/31, Tuesday 2024/01/02, Sunday 2023/12/31;
    # on Mon 2024-01-01: Tuesday 2023/12/26.
    assert one(spark, S.run_date("two_days_ago", dt.date(2024, 1, 2))) == "2023/12/31"
    assert one(spark, S.run_date("tuesday", dt.date(2024, 1, 2))) == "2024/01/02"
    assert one(spark, S.run_date("sunday", dt.date(2024, 1, 2))) == "2023/12/31"
    assert one(spark, S.run_date("tuesday", dt.date(2024, 1, 1))) == "2023/12/26"
    assert one(spark, S.run_date("manual", manual="20210312")) == "2021/03/12"


def test_run_dates_match_python_loop(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(21)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", S.run_date("tuesday", F.col("d")).alias("t"), S.run_date("sunday", F.col("d")).alias("s"))
    for r in df.collect():
        t = r.d
        while t.weekday() != 1:
            t -= dt.timedelta(days=1)
        assert r.t == t.strftime("%Y/%m/%d")
        assert r.s == (t - dt.timedelta(days=2)).strftime("%Y/%m/%d")


def test_contains_any_semantics(spark):
    cases = [("too heavy", "heavy;weight", True), ("Too Large", "large", False),
             ("abc", "x;", True), ("abc", "", True), ("abc", "x;y", False)]
    df = spark.createDataFrame(cases, "t string, k string, want boolean")
    for r in df.select("want", S.contains_any("t", "k").alias("got")).collect():
        assert r.got == r.want


def test_zero_date_and_iso_text(spark):
    df = spark.createDataFrame([("0000-00-00",), ("2024-03-01",), (None,)], "x string")
    got = [r.d for r in df.select(S.zero_date_to_null("x").alias("d")).collect()]
    assert got == [None, dt.date(2024, 3, 1), None]
    assert one(spark, S.iso_date_text(F.lit(dt.date(2024, 3, 1)))) == "2024-03-01"


def test_completeness_flags(spark):
    rows = [("1", "2", "3", "4"), ("1", "", "3", "4"), (None, "2", "3", ""), ("1", "2", "3", None)]
    df = spark.createDataFrame(rows, "pkg_height string, pkg_length string, pkg_width string, "
                                     "pkg_weight string")
    got = [(r.has_dimensions, r.has_weight) for r in S.completeness_flags(df).collect()]
    assert got == [("True", "True"), ("False", "True"), ("False", "False"), ("True", "False")]


def test_job_states_first_match(spark):
    rows = [("submit", "Waiting for Resources"), ("submit", "Executing step"),
            ("submit", "Job Deleted"), ("submit", "Success"), ("submit", "Error"),
            ("submit", "Publishing"), ("submit", "Queued"), ("result", "Success"),
            ("result", "Error"), ("result", "Deleted"), ("result", "Executing"),
            ("submit", "Waiting for Resources now")]
    df = spark.createDataFrame(rows, "phase string, status_text string")
    got = [r.s for r in df.select(S.job_state(F.col("phase"), F.col("status_text")).alias("s")).collect()]
    assert got == ["ok", "ok", "failed", "ok", "failed", "ok", "waiting", "ok", "failed",
                   "failed", "pending", "waiting"]


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("N/A",), ("None",), ("x",), ("",)], "x string")
    got = [r.y for r in df.select(S.na_to_null("x").alias("y")).collect()]
    assert got == [None, None, None, "None", "x", None]


def test_case_insensitive_queue_option(spark):
    import datetime as _d
    from itemtrack.operators import queues
    df = spark.createDataFrame([("a", "US", "tp", None), ("b", "US", "TP", None), ("c", "US", None, None)],
                               "item_id string, market string, status string, export_date date")
    assert sorted(r.item_id for r in queues.status_queue(df).collect()) == ["a", "c"]
    got = sorted(r.item_id for r in queues.status_queue(df, case_insensitive=True).collect())
    assert got == ["c"]


def test_cluster_conf_and_literal_tables(spark):
    from itemtrack.operators.common import literal_table
    from itemtrack.session import cluster_conf
    conf = cluster_conf(100 << 40, 8000)          # 100 TiB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    t = literal_table(spark, [("US", 1), ("UK", 2)], "market string, code int")
    assert sorted(tuple(r) for r in t.collect()) == [("UK", 2), ("US", 1)]
    assert literal_table(spark, [], "market string").count() == 0
