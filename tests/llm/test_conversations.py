"""Operator 12 against an exhaustive search over edits and a plain version of the query."""
import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm_helpers import rows_of

from itemtrack.llm import conversations as C
from itemtrack.llm.queries import op12_conversation_repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, position string, letter int"


def exhaustive(rows, inserts):
    """Least (cost, audit) over all edits with at most ``inserts`` inserts; rows: (initial, fault)."""
    found = []

    def go(i, left, cost, audit, roles):
        if left:
            for symbol in "ua":
                go(i, left - 1, cost + 2, audit + "I", roles + symbol)
        if i == len(rows):
            if GRAMMAR.fullmatch(roles):
                found.append((cost, audit))
            return
        initial, fault = rows[i]
        go(i + 1, left, cost + 3, audit + "D", roles)
        if fault not in (1, 2):
            go(i + 1, left, cost + (fault == 3), audit + "K", roles + initial)
            for symbol in "ua":
                go(i + 1, left, cost + 2 + (fault == 3), audit + "R", roles + symbol)

    go(0, inserts, 0, "", "")
    return min(found)


def table(rows):
    """Least (cost, audit) by a table over grammar places: none, s, u, a."""
    steps = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insert(best):
        for _ in range(4):
            for (at, symbol), to in steps.items():
                if symbol != "s" and at in best:
                    best[to] = min(best.get(to, (1 << 60, "")), (best[at][0] + 2, best[at][1] + "I"))
        return best

    best = {"0": (0, "")}
    for initial, fault in rows:
        best, new = insert(dict(best)), {}
        for at, (cost, audit) in best.items():
            offers = [(at, cost + 3, "D")]
            if fault not in (1, 2):
                offers += [(steps.get((at, initial)), cost + (fault == 3), "K")]
                offers += [(steps.get((at, s)), cost + 2 + (fault == 3), "R") for s in "ua"]
            for to, c, edit in offers:
                if to:
                    new[to] = min(new.get(to, (1 << 60, "")), (c, audit + edit))
        best = new
    best = insert(dict(best))
    return min(best[e] for e in ("0", "a") if e in best)


def letters(rows):
    return "".join(C.letter("sua?".index(i), f) for i, f in rows)


def test_short_talks_equal_exhaustive_search():
    rng = random.Random(2)
    for n in range(5):
        for rows in (itertools.product(itertools.product("sua?", (0, 1, 3)), repeat=n) if n < 3 else
                     [[(rng.choice("sua?"), rng.randint(0, 3)) for _ in range(n)] for _ in range(150)]):
            rows = list(rows)
            assert C.repair_letters([letters(rows)]) == exhaustive(rows, 3) == table(rows), rows


@pytest.mark.parametrize("size", [300, 3000])
def test_long_talks_with_frozen_prefixes(size, monkeypatch):
    rng = random.Random(size)
    monkeypatch.setattr(C, "FREEZE", 7)
    for weights in ((1, 5, 5, 1), (1, 1, 1, 1), (0, 9, 1, 0)):
        rows = [(rng.choices("sua?", weights)[0], rng.choice([0, 0, 0, 1, 3])) for _ in range(size)]
        text = letters(rows)
        assert C.repair_letters([text[i:i + 100] for i in range(0, size, 100)]) == table(rows)


def plain(given):
    """The query in plain Python."""
    talks = {}
    for conv, turn, role, text in given:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        talk = talks.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        talk += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, rows = set(), []
        for _, role, text in talk:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0
            seen.add((role, text))
            rows.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        cost, audit = table(rows)
        turns = {t for t, _, _ in talk if t is not None}
        total, lines, i = sum(c != "D" for c in audit), [], 0
        for edit in audit:
            new = ("user", "assistant")[(len(lines) - total % 2) % 2]
            if edit == "I":
                lines.append(f"{new}:")
                continue
            if edit != "D":
                lines.append(f"{talk[i][1] if edit == 'K' else new}:{talk[i][2]}")
            i += 1
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *[sum(f == k for _, f in rows) for k in (1, 2, 3)],
                    sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def query(spark, rows, path, monkeypatch):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    got = rows_of(op12_conversation_repair(spark, path))
    return sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr)


def test_query_equals_plain_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    rng = random.Random(9)
    says = ["Hi there.", "ok", "", None, "Why? ", "so!\n\t", "\x0b \r", "two\nlines.", "a.b"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(12)]),
             rng.choice(["user", "assistant", "system", "tool", "", None, "usr"]), rng.choice(says), "x", 1)
            for _ in range(500)]
    rows += [(77, t, ("user", "assistant")[t % 2], f"turn {t // 3}." + "z" * (t % 5 == 0) * 2000, None, None)
             for t in range(400)]
    rows += [(78, None, "user", "same.", None, None)] * 40 + [(n, 0, "user", "gone.", None, None) for n in range(100, 160)]
    assert query(spark, rows, str(tmp_path), monkeypatch) == plain([r[:4] for r in rows])


def test_empty_table(spark, tmp_path, monkeypatch):
    assert query(spark, [], str(tmp_path), monkeypatch) == []


def test_repaired_rows_follow_the_grammar(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi"), (1, 2, "user", "Hi"), (2, 0, "system", "Be kind."),
            (3, 5, "user", "Bye."), (None, 1, "user", "a."), (None, 2, "assistant", "b.")]
    repair = C.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    talks = {}
    for r in sorted(rows_of(repair.repaired()), key=lambda r: (repr(r["conv_id"]), r["place"])):
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["edit"]))
    assert talks[3] == [("user", "Bye.", "K"), ("assistant", "", "I")]
    assert talks[None] == [("user", "a.", "K"), ("assistant", "b.", "K")]
    assert all(GRAMMAR.fullmatch("".join(role[0] for role, _, _ in t)) for t in talks.values())
    assert {r["conv_id"]: r["audit"] for r in rows_of(repair.summary)}[2] == "D"
