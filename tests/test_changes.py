import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from itemtrack import schemas
from itemtrack.operators import changes

D0 = dt.date(2024, 1, 1)


def tracker(spark, rows):
    """rows: (item, market, target, status, reason, seq)."""
    full = []
    for item, market, target, status, reason, seq in rows:
        r = {c: None for c in schemas.TRACKER_COLUMNS}
        r.update(item_id=item, market=market, target=target, offer_type="F", action_date=D0,
                 status=status, reason=reason)
        full.append(tuple(r[c] for c in schemas.TRACKER_COLUMNS) + (seq,))
    schema = T.StructType(schemas.TRACKER_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    return spark.createDataFrame(full, schema)


def test_golden_archive(spark):
    t = tracker(spark, [("x", "US", "t1", "unblocked", "A", 1), ("x", "US", "t1", "WIP", "B", 2),
                        ("x", "US", "t2", "WIP", "C", 3)])
    hist = t.limit(0)
    inflow = spark.createDataFrame([("x", "US")], "item_id string, market string")
    new_t, new_h = changes.archive_move(t, hist, inflow)
    assert [r.seq for r in new_h.collect()] == [1]
    assert [r.seq for r in new_t.collect()] == [3]
    new_t, _ = changes.archive_move(t, hist, inflow, only_archived=True)
    assert sorted(r.seq for r in new_t.collect()) == [2, 3]
    # with only_archived the rows are conserved across tracker and history
    assert new_t.count() + new_h.count() == t.count()


def test_insert_if_absent_idempotent_and_first_wins(spark):
    t = tracker(spark, [("a", "US", "t", "WIP", None, 1)])
    inc = tracker(spark, [("a", "US", "t", "TP", None, 5), ("b", "US", "t", "WIP", "R", 6),
                          ("b", "US", "t", "TP", "R", 7)])
    once = changes.insert_if_absent(t, inc)
    twice = changes.insert_if_absent(once, inc)
    got = sorted((r.item_id, r.status) for r in once.collect())
    assert got == [("a", "WIP"), ("b", "WIP")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_insert_partial_defaults(spark):
    t = tracker(spark, [("a", "US", "t", "WIP", None, 1)])
    inc = spark.createDataFrame([("c", "UK", "t", "F", D0, 9)],
                                "item_id string, market string, target string, offer_type string, "
                                "action_date date, seq long")
    out = changes.insert_partial(t, inc, ["item_id", "market", "target", "offer_type", "action_date"])
    row = out.where("item_id = 'c'").first()
    assert row.status is None and row.export_date is None and out.count() == 2


def test_keyed_update_keeps_rows_last_wins(spark):
    t = tracker(spark, [("a", "US", "t1", "WIP", "A", 1), ("a", "US", "t2", "WIP", "A", 2),
                        ("b", "US", "t1", "WIP", "A", 3)])
    upd = spark.createDataFrame([("a", "US", "X", "TP", 1), ("a", "US", None, "unblocked", 2),
                                 ("z", "US", "Q", "TP", 3)],
                                "item_id string, market string, reason string, status string, seq long")
    out = changes.set_reason_status(t, upd)
    assert out.count() == 3
    got = {r.seq: (r.reason, r.status) for r in out.collect()}
    assert got == {1: (None, "unblocked"), 2: (None, "unblocked"), 3: ("A", "WIP")}


def test_keyed_update_collision(spark):
    t = tracker(spark, [("a", "US", "t1", "WIP", "A", 1), ("a", "US", "t1", "WIP", "B", 2)])
    upd = spark.createDataFrame([("a", "US", "X", "TP", 1)],
                                "item_id string, market string, reason string, status string, seq long")
    new = changes.set_reason_status(t, upd)
    assert sorted(r.seq for r in new.collect()) == [1, 2]       # no row is ever dropped
    with pytest.raises(changes.KeyCollision):
        changes.require_distinct_keys(new, upd)
    changes.require_distinct_keys(t, upd)
    with pytest.raises(ValueError):
        changes.set_reason_status(t, upd.drop("seq"))            # "last wins" needs an order


def test_bulk_delete(spark):
    t = tracker(spark, [("a", "US", "t1", "unblocked", "A", 1), ("a", "US", "t1", "WIP", "A", 2),
                        ("a", "US", "t2", "WIP", "A", 3), ("b", "UK", "t1", None, "A", 4)])
    assert sorted(r.seq for r in changes.bulk_delete_unblocked(t).collect()) == [3, 4]


def test_one_update_per_item_market(spark):
    d = spark.createDataFrame([("a", "US", None, "unblocked", 2), ("a", "US", "X", "WIP", 1),
                               ("a", "UK", "Y", "WIP", 3)],
                              "item_id string, market string, next_reason string, "
                              "next_status string, seq long")
    got = sorted(tuple(r) for r in changes.one_update_per_item_market(d).collect())
    assert got == [("a", "UK", "Y", "WIP", 3), ("a", "US", "X", "WIP", 1)]


def test_create_table(spark, tmp_dir):
    df = changes.create_table(spark, tmp_dir + "/t")
    assert df.count() == 0 and df.schema.fieldNames()[0] == "item_id"



NULL_CASES = [
    ([(None, None)], [(None, None, "x")]),
    ([], [(None, "a", "x"), ("a", None, "y")]),
    ([("a", None)], [(None, "a", "x"), ("a", None, "y")]),
    ([], [(None, None, "x"), (None, None, "y")]),
    ([(None, "")], [("", None, "x"), (None, "", "y")]),
    ([], [("", "", "x"), (None, None, "y"), ("", "", "z")]),
]


@pytest.mark.parametrize("existing,incoming", NULL_CASES)
def test_insert_if_absent_null_safe_keys(spark, existing, incoming):
    """Reason and subtask (key columns) take NULLs and ''; NULL equals NULL but not ''."""
    def rows(data, with_comment):
        out = []
        for i, d in enumerate(data):
            r = {c: None for c in schemas.TRACKER_COLUMNS}
            r.update(item_id="i", market="US", target="t", offer_type="F", action_date=D0,
                     reason=d[0], subtask_type=d[1], comment=d[2] if with_comment else None)
            out.append(tuple(r[c] for c in schemas.TRACKER_COLUMNS) + (i,))
        return out
    schema = T.StructType(schemas.TRACKER_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    t = spark.createDataFrame(rows(existing, False), schema)
    inc = spark.createDataFrame(rows(incoming, True), schema)
    got = sorted(str((r.reason, r.subtask_type, r.comment))
                 for r in changes.insert_if_absent(t, inc).collect())
    seen = [(e[0], e[1]) for e in existing]
    want = [(e[0], e[1], None) for e in existing]
    for reason, subtask, comment in incoming:
        if (reason, subtask) not in seen:
            seen.append((reason, subtask))
            want.append((reason, subtask, comment))
    assert got == sorted(str(w) for w in want)
