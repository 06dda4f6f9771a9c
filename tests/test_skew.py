"""A hot item holding a third of all rows: same answers as a plain loop, and the
plan reduces groups map-side (partial aggregates) before any shuffle."""
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from itemtrack.operators import changes, decide as D, joins
from itemtrack.plans import bindings as B

from conftest import SF_SMALL


def hot_observations(spark):
    o = B.view(spark, SF_SMALL, "v_obs")
    hot = F.col("seq") % 3 == 0
    o = o.withColumns({
        "item_id": F.when(hot, F.lit("HOT")).otherwise(F.col("item_id")),
        "reason_text": F.when(hot, F.concat("reason_text", F.col("seq").cast("string")))
        .otherwise(F.col("reason_text"))})
    return D.dedup_observations(o)


def brute_force(rows):
    """The decision rules as a plain loop over rows in arrival order."""
    def single(nr, old):
        if nr == "Others":
            return ("Others", "nonaction")
        if nr == "No blocker":
            return (old, "unblocked")
        return (nr, "WIP")

    def ordered(values):
        out = []
        for v in values:
            if v not in out:
                out.append(v)
        return out

    by_item = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["seq"]):
        by_item[r["item_id"]].append(r)
    result = {}
    for item, rs in by_item.items():
        markets = ordered(r["market"] for r in rs)
        for r in rs:
            if len(rs) == 1:
                d = single(r["new_reason"], r["reason"])
            elif len(markets) == 1:
                lst = ordered(x["new_reason"] for x in rs)
                rest = [x for x in lst if x != "No blocker"]
                if "Others" in lst:
                    d = ("Others", "nonaction")
                elif rest:
                    d = (",".join(rest), "WIP")
                else:
                    d = (r["reason"], "unblocked")
            else:
                last = [x for x in rs if x["market"] == markets[-1]]
                if len(last) == 1:
                    d = single(last[0]["new_reason"], r["reason"])
                else:
                    lst = ordered(x["new_reason"] for x in last)
                    d = ("Others", "nonaction") if "Others" in lst else (",".join(lst), "WIP")
            result[r["seq"]] = d
    return result


def test_hot_item_matches_plain_loop(spark):
    obs = hot_observations(spark)
    rows = [r.asDict() for r in obs.collect()]
    assert sum(r["item_id"] == "HOT" for r in rows) * 4 > len(rows)
    got = {r.seq: (r.next_reason, r.next_status) for r in D.decide(obs).collect()}
    assert got == brute_force(rows)


def test_statistics_are_partial_before_the_shuffle(spark):
    plan = D.decide(hot_observations(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan            # keep-first reduced map-side
    assert "partial_count" in plan and "partial_min(" in plan
    # the only window runs over (item, market) statistics: at most one row per market
    assert plan.count("Window ") <= 1


@pytest.fixture()
def shuffled(spark):
    """No broadcasts and low skew limits, so that a hot key shows in small tables."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, value in conf.items():
        spark.conf.set(k, value)
    yield spark
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def hot_rows(spark, n=120_000):
    """A third of the rows on one item; market differs by row."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("item_id"),
        F.when(F.col("id") % 3 == 0, "US").otherwise(F.concat(F.lit("m"), F.col("id") % 5)).alias("market"),
        F.concat(F.lit("r"), F.col("id") % 4).alias("reason"), F.lit("WIP").alias("status"),
        F.repeat(F.md5(F.col("id").cast("string")), 2).alias("filler"), F.col("id").alias("seq"))


@pytest.mark.parametrize("kind", ["rows_per_item", "rows_per_item_market", "attach_state", "restrict_to_keys",
                                  "keyed_difference", "keyed_update"])
def test_hot_keys_are_split(shuffled, kind):
    rows = hot_rows(shuffled)
    keys = rows.select("item_id", "market").where("seq % 2 = 0")
    out = {
        "rows_per_item": lambda: D.rows_per_item(rows),
        "rows_per_item_market": lambda: D.rows_per_item_market(rows),
        "attach_state": lambda: joins.attach_state(rows.drop("reason", "status"), joins.first_state(rows)),
        "restrict_to_keys": lambda: joins.restrict_to_keys(rows, keys),
        "keyed_difference": lambda: changes.keyed_difference(rows, keys.where("item_id <> 'hot'"),
                                                             ["item_id", "market"]),
        "keyed_update": lambda: changes.keyed_update(rows, rows.select("item_id", "market", "reason", "seq"),
                                                     ["reason"]),
    }[kind]()
    counted = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*out.columns) % 1000), F.max("filler"))
    assert counted.collect()[0][0] > 0
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
