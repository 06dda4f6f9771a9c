import datetime as dt

from hypothesis import given, settings, strategies as st

from itemtrack.operators import joins, quota


def plan(spark, queue, quotas):
    q = spark.createDataFrame([(i, m, s) for i, m, s in queue], "item_id string, market string, seq long")
    c = spark.createDataFrame(quotas, "market string, slot_no int, capacity int, slot_ref string")
    assigned, unassigned = quota.plan_batches(q, c)
    return ({r.item_id: r.slot_no for r in assigned.collect()},
            sorted(r.item_id for r in unassigned.collect()))


def test_golden_quota(spark):
    queue = [(x, "US", i) for i, x in enumerate("abcde")]
    quotas = [("US", 1, 2, "q1"), ("US", 2, 2, "q2")]
    assigned, left = plan(spark, queue, quotas)
    assert assigned == {"a": 1, "b": 1, "c": 2, "d": 2} and left == ["e"]
    assigned, left = plan(spark, queue[:2], quotas)
    assert assigned == {"a": 1, "b": 1} and left == []


def test_market_without_slots_assigns_nothing(spark):
    assigned, left = plan(spark, [("a", "DE", 1), ("b", "US", 2)], [("US", 1, 5, "q")])
    assert assigned == {"b": 1} and left == ["a"]


@settings(max_examples=10, deadline=None)
@given(sizes=st.lists(st.integers(0, 40), min_size=1, max_size=3),
       caps=st.lists(st.lists(st.integers(0, 9), min_size=0, max_size=3), min_size=3, max_size=3))
def test_quota_properties(spark, sizes, caps):
    markets = ["M0", "M1", "M2"]
    queue = [(f"{m}-{i}", m, i * 3 + k) for k, (m, n) in enumerate(zip(markets, sizes))
             for i in range(n)]
    quotas = [(m, j + 1, c, f"{m}/{j}") for m, cs in zip(markets, caps) for j, c in enumerate(cs)]
    if not queue:
        return
    assigned, left = plan(spark, queue, quotas)
    assert len(assigned) + len(left) == len(queue)
    for (m, j, c, _) in quotas:
        assert sum(1 for item, s in assigned.items() if item.startswith(m + "-") and s == j) <= c
    # queue order is kept: slot numbers never decrease along the queue
    for m in markets:
        slots = [assigned[i] for i, mm, _ in sorted(queue, key=lambda r: r[2]) if mm == m and i in assigned]
        assert slots == sorted(slots)


def test_golden_latest(spark):
    rows = [("x", 1, dt.date(2024, 1, 1)), ("x", 1, dt.date(2024, 3, 1)), ("x", 1, None),
            ("y", 1, None)]
    df = spark.createDataFrame(rows, "item_id string, market_code int, exportable_date date")
    got = [tuple(r) for r in joins.latest_export(df).collect()]
    assert got == [("x", 1, dt.date(2024, 3, 1))]


def test_latest_plan_uses_window_group_limit(spark):
    df = spark.createDataFrame([("x", 1, dt.date(2024, 1, 1))],
                               "item_id string, market_code int, exportable_date date")
    plan_text = joins.latest_export(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan_text


def test_first_n_per_market(spark):
    q = spark.createDataFrame([(f"i{i}", "US" if i % 3 else "DE", i) for i in range(20)],
                              "item_id string, market string, seq long")
    got = quota.first_n_per_market(q, 2).collect()
    by_market = {}
    for r in got:
        by_market.setdefault(r.market, []).append((r.position, r.seq))
    assert sorted(by_market["US"]) == [(1, 1), (2, 2)]
    assert sorted(by_market["DE"]) == [(1, 0), (2, 3)]


def test_rank_within_equals_row_number_with_a_hot_market(spark):
    from pyspark.sql import Window, functions as F
    from itemtrack.operators.common import rank_within
    c = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    # two thirds of the queue in one market
    q = c.select(F.col("c_custkey").alias("seq"),
                 F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string"))
                 .otherwise(F.lit("HOT")).alias("market"))
    got = rank_within(q, "market", ["seq"], num_partitions=7)
    want = q.withColumn("rank", F.row_number().over(Window.partitionBy("market").orderBy("seq")))
    assert sorted(map(tuple, got.select("seq", "market", "rank").collect())) == \
        sorted(map(tuple, want.select("seq", "market", "rank").collect()))


def test_ten_thousand_slots_in_short_stretches(spark, monkeypatch):
    import random
    monkeypatch.setattr(quota, "STRETCH", 50)
    rng = random.Random(7)
    caps = [rng.choice([0, 1, 1, 2, 3, 400]) if n % 500 == 0 else rng.randint(0, 2) for n in range(10_000)]
    queue = [(f"i{n:06d}", "US", n) for n in range(sum(caps) + 70)] + [("n", None, 1), ("d", "DE", 1)]
    quotas = [("US", n, c, f"s{n}") for n, c in enumerate(caps)] + [(None, 1, 9, "none")]
    assigned, left = plan(spark, queue, quotas)
    want = [n for n, c in enumerate(caps) for _ in range(c)]
    assert [assigned[f"i{n:06d}"] for n in range(len(want))] == want
    assert left == sorted([q[0] for q in queue[len(want):]])
