"""Operator 13 against edit distances computed one by one and a plain version of the query."""
import random
import re
import zlib
from collections import Counter, defaultdict

from llm_helpers import SCHEMA, SF, docs, edge_rows, edges, empty, rows_of  # noqa: F401

from itemtrack.llm.spelling import BitSlices, _codes, near_pairs, spelling_variants, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1:] or len(a) == len(b) and a[p + 1:] == b[p + 1:]


def plain_variants(counts, ratio=10):
    """All words through a table of their forms with one letter left out."""
    shorter = defaultdict(set)
    for w in counts:
        shorter[w].add(w)
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1:]].add(w)
    near = {w: {o for k in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for o in shorter[k] if one_apart(w, o)}
            for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def result(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows_of(df))


def test_bit_slices_equal_edit_distance():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(400)} - {""})
    words += ["x" * 70, "x" * 69, "x" * 35 + "y" + "x" * 34]
    assert sorted(near_pairs(words, words)) == sorted(
        (i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b))
    assert BitSlices(["abc"]).near(_codes(["zbc", "abq"])[0]).tolist() == [[0, 0], [1, 0]]


def chain_counts(rng, letters, n, sizes):
    counts = {}
    for _ in range(n):
        w, c = "".join(rng.choice(letters) for _ in range(rng.randint(*sizes))), 2
        for _ in range(rng.randint(1, 5)):            # chains of ever more frequent words
            counts[w] = max(counts.get(w, 0), c)
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            c *= rng.choice([3, 10, 11])
    return {w: c for w, c in counts.items() if len(w) >= 7}


def test_variants_with_tiles_and_chains(spark):
    rng = random.Random(4)
    for letters, sizes, tile in (("ab", (7, 9), 8), ("abcdefgh", (7, 12), 64), ("aß", (7, 90), 16)):
        counts = chain_counts(rng, letters, 150, sizes)
        table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
        assert result(variants(table, tile=tile)) == plain_variants(counts)


def test_documents_and_edge_rows(spark, docs, edges):
    for table in (docs, edges):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        got = result(spelling_variants(table))
        assert got == plain_variants(plain_words(rows)) and got


def test_long_words_and_empty_table(spark, empty):
    assert spelling_variants(empty).count() == 0
    long = "abcdefgh" * 3000
    rows = [(n, f"{long} {long[:-1]} {long[:700]}Q{long[701:]} short") for n in range(40)] + [(41, None), (None, "")]
    got = result(spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_variants(plain_words(rows)) and got
