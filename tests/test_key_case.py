"""Keys that differ in case only match under ``ignore_case``, and only there."""
import random

import pytest
from pyspark.sql import functions as F

from itemtrack import schemas
from itemtrack.operators import changes, joins
from itemtrack.operators.common import any_case, join_split, key_mark
from tests.test_changes import tracker

LETTERS = "aAbBσΣςéÉßẞkK\u212aİı"
CASES = [("ab", "AB"), ("Σς", "σΣ"), ("ΑΣ", "ας"), ("Kelvin", "KELVIN"), ("İx", "i̇X"), ("ẞ", "ß")]


def folded(text):
    """The collation's view: letters in lower case one by one, final sigma as any other."""
    return None if text is None else "".join(c.lower() for c in text).replace("ς", "σ")


def some_texts(rng, n):
    return [None if rng.random() < .05 else "".join(rng.choice(LETTERS) for _ in range(rng.randrange(3))) for _ in range(n)]


def test_marks_of_equal_texts_are_equal(spark):
    pairs = spark.createDataFrame(CASES, "a string, b string")
    bad = pairs.where(any_case("a") == any_case("b")).where(
        key_mark(pairs, ["a"], True) != key_mark(pairs, ["b"], True))
    assert bad.count() == 0 and pairs.where(any_case("a") == any_case("b")).count() == len(CASES)
    rng = random.Random(1)
    texts = [(t,) for t in sorted({"".join(rng.choice(LETTERS) for _ in range(rng.randrange(5))) for _ in range(400)})]
    df = spark.createDataFrame(texts, "a string")
    by_key = df.groupBy(any_case("a").alias("k")).agg(F.count_distinct(key_mark(df, ["a"], True)).alias("n"))
    assert by_key.where("n > 1").count() == 0
    assert by_key.count() == len({folded(t) for t, in texts})


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join(spark, how):
    rng = random.Random(2)
    left = [(a, b, i) for i, (a, b) in enumerate(zip(some_texts(rng, 120), some_texts(rng, 120)))]
    right = [(a, b, 1000 + i) for i, (a, b) in enumerate(zip(some_texts(rng, 60), some_texts(rng, 60)))]
    got = join_split(spark.createDataFrame(left, "a string, b string, x int"),
                     spark.createDataFrame(right, "a string, b string, y int"), ["a", "b"], how, ignore_case=True)
    want = []
    for row in left:
        hits = [r for r in right if None not in (*row[:2], *r[:2]) and list(map(folded, row[:2])) == list(map(folded, r[:2]))]
        if how in ("inner", "left"):
            want += [(*row, r[2]) for r in hits] or ([(*row, None)] if how == "left" else [])
        elif bool(hits) == (how == "left_semi"):
            want.append(row)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_lookup_insert_and_update(spark):
    t = tracker(spark, [("x1", "US", "T", "WIP", "A", 1), ("X1", "uk", "T", "WIP", "B", 2), ("x2", "us", "T", "WIP", "C", 3)])
    keys = spark.createDataFrame([("X1", "us"), ("x1", "US"), ("X2", "Uk")], "item_id string, market string")
    found = joins.inflow_lookup(t, keys, ignore_case=True).collect()
    assert [tuple(r) for r in found] == [("x1", "US")]
    assert joins.status_lookup(t, keys).count() == 1 and joins.status_lookup(t, keys, ignore_case=True).count() == 1

    new = tracker(spark, [("X1", "us", "t", "WIP", "a", 5), ("x9", "US", "t", "WIP", "n", 7), ("X9", "us", "T", "TP", "N", 6)])
    after = changes.insert_if_absent(t, new, ignore_case=True)
    assert sorted((r["item_id"], r["market"], r["status"]) for r in after.collect()) == [
        ("X1", "uk", "WIP"), ("X9", "us", "TP"), ("x1", "US", "WIP"), ("x2", "us", "WIP")]
    assert after.schema == changes.insert_if_absent(t, new).schema and changes.insert_if_absent(t, new).count() == 6

    updates = spark.createDataFrame([("X1", "us", "R1", "s1", 1), ("x1", "Us", "R2", None, 2), ("q", "US", "R", "s", 3)],
                                    "item_id string, market string, reason string, status string, seq int")
    out = changes.set_reason_status(t, updates, ignore_case=True)
    assert out.schema == t.schema
    assert sorted((r["item_id"], r["market"], r["reason"], r["status"]) for r in out.collect()) == [
        ("X1", "uk", "B", "WIP"), ("x1", "US", "R2", None), ("x2", "us", "C", "WIP")]


def test_keys_that_differ_in_case_collide(spark):
    t = tracker(spark, [("x", "US", "T", "WIP", "A", 1), ("X", "us", "t", "WIP", "a", 2)]).select(*schemas.TRACKER_COLUMNS)
    keys = spark.createDataFrame([("x", "us")], "item_id string, market string")
    changes.require_distinct_keys(t, keys)
    with pytest.raises(changes.KeyCollision):
        changes.require_distinct_keys(t, keys, ignore_case=True)
