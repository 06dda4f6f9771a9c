"""Operator 11 against a brute-force version: phrases, proximity, edge rows."""
import random
import re

from llm_helpers import SCHEMA, docs, edge_rows, edges, empty, rows_of  # noqa: F401

from itemtrack.llm.positional import PositionalIndex, contamination, phrase_matches, proximity_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(texts, items, size):
    wins = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - size, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + size]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                got = wins.get(tuple(w[s:s + n]))
                if got:
                    hit.update(range(s, s + n))
                    names |= got
        out.append((len(w), len(hit), len(names), sorted(names), bool(hit)))
    return out


def result(df):
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"])
                  for r in rows_of(df))


def expected(rows, items, size):
    return sorted((repr(i), *b) for (i, _), b in zip(rows, brute([t for _, t in rows], items, size)))


def test_edge_rows_equal_brute_force(spark, edges):
    rows = [(r[0], r[1]) for r in edge_rows()]
    prose = [t for _, t in rows if t and len(t) > 100]
    items = [(1, prose[0]), (2, "one two"), (3, None), (4, ""), (None, "THREE"), (5, prose[-1][7:300]), (5, "x x x"),
             (6, " ".join(prose[1].split()[9000:9030])), (7, "naïve Café"), (8, "no such words at all here"), (9, "x")]
    table = spark.createDataFrame([(i, t, "k", 1) for i, t in items], "item_id int, text string, phrase string, row int")
    assert result(contamination(edges, table, 10)) == expected(rows, items, 10)


def test_random_texts_of_few_words(spark):
    rng = random.Random(11)

    def text(n):
        return " ".join(rng.choice("a b c D é ü7".split()) for _ in range(n))

    rows = [(n, text(rng.randint(0, 60))) for n in range(80)] + [(80, "a " * 3000)]
    items = [(n, text(rng.randint(0, 9))) for n in range(25)] + [(25, "a a a a a a a a"), (26, rows[3][1])]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    assert result(contamination(docs_, table, 4)) == expected(rows, items, 4)


def test_empty_tables(spark, empty, edges):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(empty, none).count() == 0
    judged = rows_of(contamination(edges, none))
    assert len(judged) == len(edge_rows()) and not any(r["contaminated"] or r["n_hit"] for r in judged)


def test_matches_carry_places(spark):
    table = spark.createDataFrame([(7, "To be, or not to be: to be!")], "doc_id int, text string")
    phrases = spark.createDataFrame([(0, "to be"), (1, "not to be to"), (2, "be"), (3, "to or")], "phrase_id int, phrase string")
    found = phrase_matches(PositionalIndex(table), phrases, 4)
    assert sorted((r["phrase_id"], r["start"], r["length"]) for r in rows_of(found)) == [
        (0, 0, 2), (0, 4, 2), (0, 6, 2), (1, 3, 4), (2, 1, 1), (2, 5, 1), (2, 7, 1)]


def test_proximity_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(n, " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randint(0, 40)))) for n in range(40)]
    queries = [(0, "a b"), (1, "C d e"), (2, "a a"), (3, "z a"), (4, ""), (5, "g f e d")]
    index = PositionalIndex(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1))
    ids = {r["row"]: r["doc_id"] for r in rows_of(index.rows)}
    got = proximity_matches(index, spark.createDataFrame(queries, "query_id int, text string"), 5)
    want = []
    for doc, text in rows:
        w = words(text)
        for query, q in queries:
            need = set(words(q))
            for last in range(len(w)) if need else ():
                near = range(max(0, last - 4), last + 1)
                if w[last] in need and need <= {w[i] for i in near}:
                    want.append((doc, query, min(i for i in near if w[i] in need), last))
    assert sorted((ids[r["row"]], r["query_id"], r["first"], r["last"]) for r in rows_of(got)) == sorted(want)
