"""Operators 2, 3 and 7 against brute-force versions."""
import collections
import math
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from itemtrack.llm import dartminhash, queries, search, urls
from itemtrack.llm.urls import UrlFilter, labelled_pages

from llm_helpers import SF, docs, edges, empty, labels, rows_of  # noqa: F401


# -- operator 2 ------------------------------------------------------------------------

def plain_top(docs, asked, k):
    """docs, asked: (id, text) lists.  BM25 of every document for every query."""
    split = lambda t: re.findall(rb"[^\s!-/:-@\[-`{-~]+", (t or "").encode().lower())
    bags = [(i, collections.Counter(split(t))) for i, t in docs]
    df = collections.Counter(w for _, bag in bags for w in bag)
    mean = sum(sum(b.values()) for _, b in bags) / max(len(bags), 1)
    out = {}
    queries_ = collections.defaultdict(collections.Counter)
    for i, t in asked:
        queries_[i].update(split(t))
    for q, words in queries_.items():
        scored = []
        for i, bag in bags:
            norm = 1.2 * (1 - .75 + .75 * sum(bag.values()) / mean) if mean else 0
            hits = [w for w in words if w in bag]
            if hits:
                scored.append((-sum(words[w] * math.log(1 + (len(bags) - df[w] + .5) / (df[w] + .5)) * bag[w] * 2.2
                                    / (bag[w] + norm) for w in hits), i))
        out[q] = sorted(scored, key=lambda x: (round(x[0], 9), x[1] is None, x[1]))[:k]
    return out


def check_top(rows, want):
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        got[r["query_id"]].append(r)
    assert set(got) == {q for q, top in want.items() if top}
    for q, own in got.items():
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [r["score"] for r in own] == pytest.approx([-s for s, _ in want[q]])
        assert [r["doc_id"] for r in own] == [i for _, i in want[q]]


def test_op2_query(spark, docs):
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_top(source, [s for s in source if s[0] % 100 == 0], 10)
    check_top(rows_of(queries.op2_search(spark, SF)), want)


def test_many_shards_give_the_same_lists(docs):
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = docs.filter("doc_id % 7 = 0")
    index = search.build_index(docs.repartition(3), shard_bytes=40_000)
    assert index.count() > 6
    check_top(rows_of(search.top_k(index, asked, 5)), plain_top(source, [s for s in source if s[0] % 7 == 0], 5))


def test_documents_are_skipped(docs):
    """Pruning leaves most documents' frequent terms untouched."""
    row = search.build_index(docs.coalesce(1)).collect()[0].asDict()
    shard = search.Shard(row, 100.0, 1.2, .75)
    df, names = np.array(row["df"]), np.array(row["terms"])
    single = np.nonzero(df == 1)[0]                  # words of one document only
    owner = np.frombuffer(row["docs"], np.int32)[shard.offset[single]]
    one = np.bincount(owner).argmax()
    rare, common = names[single[owner == one]], names[np.argsort(-df, kind="stable")[:3]]
    terms = np.sort(np.concatenate([rare, common]))
    best = shard.search(terms, np.where(np.isin(terms, rare), 5.0, .1), 1)
    only = shard.search(np.sort(rare), np.ones(len(rare)), 3)      # no frequent term at all
    assert [i for i, _ in only] == [row["doc_ids"][one]]
    assert best[0][0] == row["doc_ids"][one] and shard.examined <= len(row["doc_ids"]) * .7


def test_queries_in_blocks_give_the_same_lists(docs):
    """A bound on what is broadcast at once changes no list; blocks below the k-th best are skipped."""
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = docs.filter("doc_id % 5 = 0")
    index = search.build_index(docs.coalesce(1), shard_bytes=100_000)
    check_top(rows_of(search.top_k(index, asked, 3, query_bytes=4_000)),
              plain_top(source, [s for s in source if s[0] % 5 == 0], 3))


def test_a_lower_bound_skips_blocks_and_keeps_ties():
    """Documents that score the given bound stay; blocks that cannot reach it are not visited."""
    n = 8 * search.LEAST
    row = {"doc_ids": list(range(n)), "lengths": [10] * n, "terms": np.array([5]), "df": np.array([n]),
           "docs": np.arange(n, dtype=np.int32).tobytes(),
           "tfs": np.repeat(np.arange(1, 9, dtype=np.int32), search.LEAST).tobytes()}
    shard = search.Shard(row, 10.0, search.K1, search.B)
    best = shard.search(np.array([5]), np.array([1.0]), 2)
    assert [d for d, _ in best] == [n - search.LEAST, n - search.LEAST + 1] and shard.examined == 2 * search.LEAST
    shard.examined = 0
    assert shard.search(np.array([5]), np.array([1.0]), 2, best[0][1]) == best and shard.examined == search.LEAST
    assert shard.search(np.array([5]), np.array([1.0]), 2, best[0][1] * 1.01) == []


def test_queries_together_give_their_own_lists(docs, monkeypatch):
    """Groups of queries, rows of dense runs and postings of the others give the exact sums."""
    row = search.build_index(docs.coalesce(1)).collect()[0].asDict()
    shard = search.Shard(row, 100.0, 1.2, .75)
    asked = [search.terms_of((r["text"] or "").encode())[:2] for r in docs.collect()]
    offset = np.append(0, np.cumsum([len(t) for t, _ in asked]))
    terms, weights = np.concatenate([t for t, _ in asked]), np.concatenate([c for _, c in asked]) + .5
    monkeypatch.setattr(search, "CELLS", 20 * shard.n)
    groups = list(shard.groups(offset, terms))
    assert len(groups) > 5 and [s for s, _ in groups[1:]] == [e for _, e in groups[:-1]]
    for s, e in groups:
        own = slice(offset[s], offset[e])
        found = shard.search_many(offset[s:e + 1] - offset[s], terms[own], weights[own], 4, [0.0] * (e - s))
        for q, top in enumerate(found, s):
            mine = slice(offset[q], offset[q + 1])
            exact = shard._scores(np.arange(shard.n), np.searchsorted(shard.terms, terms[mine]), weights[mine])
            want = sorted(((shard.ids[d], x) for d, x in enumerate(exact.tolist()) if x > 0), key=lambda r: (-r[1], r[0]))
            assert top == want[:4]


def test_queries_are_searched_many_at_once(docs):
    """Terms in rows take no postings of a group: hundreds of queries share its matrix products."""
    row = search.build_index(docs.coalesce(1)).collect()[0].asDict()
    asked = [search.terms_of((r["text"] or "").encode()) for r in docs.collect()]
    n = 40                                            # the shard's documents, many times under other numbers
    df, docs_, tfs = (np.array(row["df"]), np.frombuffer(row["docs"], np.int32), np.frombuffer(row["tfs"], np.int32))
    order = np.lexsort((np.concatenate([np.repeat(np.arange(len(df)), df)] * n),))
    big = {"doc_ids": list(range(n * row["n"])), "lengths": list(row["lengths"]) * n, "terms": row["terms"], "df": df * n,
           "docs": np.concatenate([docs_ + i * row["n"] for i in range(n)]).astype(np.int32)[order].tobytes(),
           "tfs": np.tile(tfs, n)[order].tobytes()}
    shard = search.Shard(big, 100.0, 1.2, .75)
    offset = np.append(0, np.cumsum([len(t) for t, _, _ in asked]))
    groups = list(shard.groups(offset, np.concatenate([t for t, _, _ in asked])))
    assert len(asked) >= 100 and len(groups) <= 4, (len(asked), len(groups))


def test_a_query_visits_blocks_of_texts_like_it():
    """Texts of two vocabularies are not mixed in blocks, though one word is in all of them."""
    rng = random.Random(5)
    vocabulary = [[f"{v}{i}" for i in range(60)] for v in "xy"]
    texts = [" ".join(["all", *rng.choices(vocabulary[i % 2], k=40)]).encode() for i in range(2000)]
    found = [search.terms_of(t) for t in texts]
    sizes, lengths = np.array([len(f[0]) for f in found]), np.array([f[2] for f in found])
    names, which, df = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True, return_counts=True)
    number = search._numbers(which, df, sizes, lengths)
    owner = np.repeat(number, sizes)
    order = np.lexsort((owner, which))
    row = {"doc_ids": np.argsort(number).tolist(), "lengths": lengths[np.argsort(number)], "terms": names, "df": df,
           "docs": owner[order].astype(np.int32).tobytes(),
           "tfs": np.concatenate([f[1] for f in found])[order].astype(np.int32).tobytes()}
    shard = search.Shard(row, float(lengths.mean()), search.K1, search.B)
    idf = np.log(1 + (2000 - df + .5) / (df + .5))
    for i in range(4):
        place = which[sizes[:i].sum():sizes[:i + 1].sum()]
        shard.examined = 0
        best = shard.search(names[place], found[i][1] * idf[place], 5)
        assert best[0][0] == i and all(d % 2 == i % 2 for d, _ in best)
        assert shard.examined <= .6 * len(texts)


def test_later_shards_return_only_what_can_be_among_the_best(spark, monkeypatch):
    """The k-th best scores of the shards searched first bound the others' rows; no list changes."""
    rng = random.Random(8)
    source = [(i, " ".join(f"w{int(rng.paretovariate(.7)) % 300}" for _ in range(rng.randint(1, 60)))) for i in range(600)]
    source += [(600, None), (None, source[3][1]), (601, source[3][1]), (602, "")]
    frame = spark.createDataFrame(source, "doc_id long, text string")
    index = search.build_index(frame.repartition(24))
    shards = {r[0] for r in index.select("shard").collect()}
    assert len(shards) == index.count() == 24
    asked = [r for r in source if r[0] is None or r[0] % 30 == 0 or r[0] > 599]
    rows, plain = [], search._searched

    def counted(*args):
        found = plain(*args)
        rows.append(found.count())
        return found

    monkeypatch.setattr(search, "_searched", counted)
    check_top(rows_of(search.top_k(index, spark.createDataFrame(asked, "doc_id long, text string"), 5)),
              plain_top(source, asked, 5))
    assert sum(rows) < 24 * 5 * len(asked) / 2


def test_a_first_bound_keeps_ties(spark):
    """Equal scores in shards searched first and later: the smaller ids are listed."""
    source = [(i, "river stone" if i % 3 else "river light") for i in range(200)]
    frame = spark.createDataFrame(source, "doc_id long, text string")
    index = search.build_index(frame.repartition(20))
    asked = [(0, "river stone"), (1, "light"), (2, "none")]
    check_top(rows_of(search.top_k(index, spark.createDataFrame(asked, "doc_id long, text string"), 4)),
              plain_top(source, asked, 4))


def test_long_queries_in_single_precision_lose_nothing():
    """Thousands of terms of alike scores: what single precision may be off grows with a query's terms."""
    rng = np.random.default_rng(2)
    n, words = 300, 4000
    tfs = rng.integers(0, 4, (words, n)).astype(np.int32)
    where = [np.nonzero(t)[0].astype(np.int32) for t in tfs]
    row = {"doc_ids": list(range(n)), "lengths": tfs.sum(0), "terms": np.arange(words),
           "df": np.array([len(d) for d in where]), "docs": np.concatenate(where).tobytes(),
           "tfs": np.concatenate([t[d] for t, d in zip(tfs, where)]).tobytes()}
    shard = search.Shard(row, float(tfs.sum(0).mean()), search.K1, search.B)
    weights = rng.random(words)
    exact = shard._scores(np.arange(n), np.arange(words), weights)
    want = sorted(enumerate(exact.tolist()), key=lambda r: (-r[1], r[0]))[:10]
    assert shard.search(np.arange(words), weights, 10) == want
    assert shard.search(np.arange(words), weights, 10, want[9][1]) == want


def test_search_edges(spark, edges, empty):
    source = [(r["key"], r["text"]) for r in edges.collect()]
    index = search.build_index(edges, id_col="key", shard_bytes=3000)
    check_top(rows_of(search.top_k(index, edges, 4, id_col="key")), plain_top(source, source, 4))
    twice = spark.createDataFrame([(1, "river stone"), (1, "river light"), (2, "nowhere-word"), (3, None)],
                                  "doc_id long, text string")
    check_top(rows_of(search.top_k(index, twice, 6)),
              plain_top(source, [(1, "river stone"), (1, "river light"), (2, "nowhere-word"), (3, None)], 6))
    assert search.top_k(search.build_index(empty), edges, 3).count() == 0
    assert search.top_k(index, empty, 3).count() == 0


# -- operator 7 ------------------------------------------------------------------------

def shingle_counts(text, weighted=True):
    words = (text or "").encode().split()
    k = min(5, len(words))
    counts = collections.Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1 if words else 0))
    return counts if weighted else collections.Counter(set(counts))


def plain_classes(source, similarity=0.8, weighted=True):
    """Class (smallest row number) of every row, over all pairs."""
    sets = [shingle_counts(t, weighted) for _, t in source]
    parent = list(range(len(source)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and (sets[i] & sets[j]).total() >= similarity * (sets[i] | sets[j]).total():
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(source))]


def expected_ids(source, weighted=True):
    classes = plain_classes(source, weighted=weighted)
    least = {}
    for (i, _), c in zip(source, classes):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    return [(i, least[c] if least[c] is not None else i) for (i, _), c in zip(source, classes)]


def test_op7_query(spark, docs):
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = rows_of(queries.op7_dart_minhash(spark, SF))
    assert sorted((r["doc_id"], r["class_id"]) for r in rows) == sorted(expected_ids(source))


def chained(n=40, words=400, step=20):
    """Each text shares enough with the next only: one class by a chain of links."""
    rng = random.Random(11)
    stream = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(words + step * n)]
    return [(i, " ".join(stream[step * i:step * i + words])) for i in range(n)]


def test_chains_strays_and_hot_groups(spark):
    rng = random.Random(12)
    source = chained()
    base = source[0][1].split()
    for i in range(100, 160):                        # near copies of one text, some too far
        words = list(base)
        for _ in range(rng.choice([2, 5, 8, 12, 30])):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 10 ** 6)}"
        source.append((i, " ".join(words)))
    source += [(200 + i, source[3][1]) for i in range(50)]
    rng.shuffle(source)
    df = spark.createDataFrame(source, "doc_id long, text string").repartition(4)
    rows = rows_of(dartminhash.near_duplicates(df))
    assert sorted((r["doc_id"], r["class_id"]) for r in rows) == sorted(expected_ids(source))
    kept = dartminhash.keep_one(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in expected_ids(source)})


def test_repeated_lines_weigh(spark):
    rng = random.Random(13)
    lines = [" ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(12)) for _ in range(40)]
    source = []
    for i in range(60):                               # most lines of one text, some with two lines repeated
        own = lines[:rng.choice([36, 38, 40])]
        repeats = rng.choice([0, 1, 9]) * rng.sample(lines[:3], 2)
        source.append((i, "\n".join(own + repeats)))
    df = spark.createDataFrame(source, "doc_id long, text string").repartition(4)
    found = {}
    for weighted in (True, False):
        want = sorted(expected_ids(source, weighted))
        got = rows_of(dartminhash.near_duplicates(df, weighted=weighted))
        assert sorted((r["doc_id"], r["class_id"]) for r in got) == want
        kept = dartminhash.keep_one(df, weighted=weighted)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want})
        found[weighted] = len({c for _, c in want})
    assert found[True] > found[False]                 # repeats set texts apart only by their weight


def test_near_copies_too_far_apart_are_not_written_as_pairs(spark, monkeypatch):
    """Texts with other words of one text left out share shingles with each other, but few are similar:
    only pairs near the bound go on to the exact comparison, and no link is lost."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(150)]
    source = [(i, " ".join(w for w in base if rng.random() > .045)) for i in range(160)]
    compared, links = [], dartminhash._links

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(dartminhash, "_links", counted)
    rows = rows_of(dartminhash.near_duplicates(spark.createDataFrame(source, "doc_id long, text string")))
    want = expected_ids(source)
    assert sorted((r["doc_id"], r["class_id"]) for r in rows) == sorted(want)
    assert len({c for _, c in want}) > 40
    assert len(compared) == 2 and compared[1] < len(source), compared


def test_parities_bound_the_difference():
    rng = np.random.default_rng(18)
    for n, apart in ((1, 0), (40, 7), (300, 60), (5000, 900)):
        one = rng.integers(0, 2 ** 63, n, np.uint64)
        two = np.concatenate([one[apart:], rng.integers(0, 2 ** 63, apart, np.uint64)])
        differ = sum(bin(int(x) & (2 ** 64 - 1)).count("1")
                     for x in dartminhash._parities(one) ^ dartminhash._parities(two))
        assert differ <= 2 * apart and (n > 300 or differ >= 1.6 * apart)


def test_weighted_candidates_recall():
    rng = np.random.default_rng(5)
    bands, rows, hit, pairs = dartminhash.BANDS, dartminhash.ROWS, 0, 0
    for _ in range(60):
        elements = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
        wa = rng.integers(1, 6, 200)
        wb = np.maximum(wa + (rng.random(200) < .28) * rng.integers(-4, 5, 200), 0)
        if not .8 <= np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum() < .9:
            continue
        a, b = (dartminhash.band_keys(dartminhash.dart_sketch(elements[w > 0], w[w > 0], bands * rows), bands, rows)
                for w in (wa, wb))
        pairs, hit = pairs + 1, hit + bool((a == b).any())
    assert pairs > 20 and hit == pairs                # a pair at 0.8 is missed with probability 8e-6


def test_dedup_edges(edges, empty):
    rows = rows_of(dartminhash.near_duplicates(edges))
    source = [(r["doc_id"], r["text"]) for r in edges.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)
    assert sorted(((r["doc_id"], r["class_id"]) for r in rows), key=key) == sorted(expected_ids(source), key=key)
    kept = dartminhash.keep_one(edges)
    assert kept.columns == edges.columns
    got, every = kept.collect(), edges.collect()
    assert all(r in every for r in got)
    bare = [r for r in every if not (r["text"] or "").split()]
    assert sorted(r["c0"] for r in got if not (r["text"] or "").split()) == sorted(r["c0"] for r in bare)
    worded = [(r["doc_id"], r["text"]) for r in every if (r["text"] or "").split()]
    assert len(got) - len(bare) == len(set(plain_classes(worded)))
    assert dartminhash.near_duplicates(empty).count() == 0 and dartminhash.keep_one(empty).count() == 0


def test_sketches_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    for _ in range(5):
        wa, wb = rng.random(300) * 3 * (rng.random(300) < .7), rng.random(300) * 3 * (rng.random(300) < .7)
        want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        a, b = (dartminhash.dart_sketch(elements[w > 0], w[w > 0], 2048) for w in (wa, wb))
        assert abs((a == b).mean() - want) < 0.05
    ones = dartminhash.dart_sketch(elements, np.ones(300), 512)
    assert (ones == dartminhash.dart_sketch(elements, None, 512)).all()
    assert not (dartminhash.dart_sketch(elements[:1], None, 512) == 2 ** 64 - 1).any()


# -- operator 3 ------------------------------------------------------------------------

def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for text, verdict in queries.URL_RULES:
        own, _, start = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(text), text, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


ODD_URLS = [None, "", "no scheme", "http://", "https://NET/x", "HTTP://A.Example.NET/en/x?q=1#f", "x://example.net",
            "http://example.net?en/", "http://example.net/EN/", "http://notexample.com/de/", "http://a.example.com/de/",
            "http://org/fr/://net/", "a://b://net/", "http://ÄX.net/ü", "http://u:p@example.com:80/de/x", "http://net//",
            "http://x/" + "é%20" * 4000, "http://a.net/\nen"]


def test_op3_query(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = rows_of(queries.op3_url_filter(spark, SF))
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, verdict = plain_rule(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["probability"] > .5 else "allow"))


def test_trees_learn_lexical_labels_and_handle_odd_urls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        bad = rng.random() < .4
        host = f"{'x%d-win' % rng.randint(10, 999) if bad else 'news'}.site{rng.randint(0, 30)}.{'biz' if bad else 'org'}"
        rows.append((i, f"http://{host}/{rng.randint(1, 99)}{'?a=%d&b=2' % i if bad else ''}", int(bad)))
    data = spark.createDataFrame(rows, "page_id long, url string, label int")
    model = UrlFilter(trees=5, depth=3).fit(data.filter("page_id < 600"))
    out = rows_of(model.judge(data.filter("page_id >= 600"), []))
    truth = {i: "block" if bad else "allow" for i, _, bad in rows}
    assert sum(truth[r["page_id"]] == r["verdict"] for r in out) >= .95 * len(out)
    odd = spark.createDataFrame([(i, u, "h", "r", .5) for i, u in enumerate(ODD_URLS)] + [(None, "http://a.net/", "h", "r", .1)],
                                "page_id long, url string, host string, rule string, probability double")
    judged = {r["page_id"]: r for r in rows_of(model.judge(odd, queries.URL_RULES))}
    for i, url in enumerate(ODD_URLS):
        host, path, rule, verdict = plain_rule(url)
        assert (judged[i]["host"], judged[i]["path"], judged[i]["rule"]) == (host, path, rule), url
        assert judged[i]["verdict"] in ("allow", "block") and (verdict or judged[i]["verdict"]) == judged[i]["verdict"]
    assert judged[None]["verdict"] == "block"
    assert model.judge(odd.limit(0), queries.URL_RULES).count() == 0


def test_few_labels(spark):
    odd = spark.createDataFrame([(1, "http://a.example.com/x"), (2, None)], "page_id long, url string")
    none = spark.createDataFrame([], "url string, label int")
    assert {r["verdict"] for r in rows_of(UrlFilter().fit(none).judge(odd, []))} == {"allow"}
    bad = spark.createDataFrame([("http://z.com", 1), (None, 1), ("http://y.com", None)], "url string, label int")
    assert {r["verdict"] for r in rows_of(UrlFilter().fit(bad).judge(odd, []))} == {"block"}


def test_labels_reach_urls_by_document_number(spark):
    pages = spark.createDataFrame([("http://a/en/7.html",), ("http://a/en/8/?x=1",), ("http://a/9#t",), (None,), ("a",)],
                                  "url string")
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 1), (8, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted((r["url"], r["label"]) for r in rows_of(labelled_pages(pages, labels))) == [
        ("http://a/9#t", 0), ("http://a/en/7.html", 1), ("http://a/en/8/?x=1", 1)]


def test_a_hot_url_does_not_fill_the_sample(spark):
    given = [f"http://{'x9-win' if i % 2 else 'news'}.site{i}.org/{i}" for i in range(200)]
    hashed = spark.createDataFrame([(u,) for u in given], "url string").orderBy(F.xxhash64("url"))
    hot = hashed.first()["url"]
    rows = [(u, int("win" in u)) for u in given + [hot] * 100]
    model = UrlFilter(max_labelled=100, trees=3, depth=2).fit(spark.createDataFrame(rows, "url string, label int"))
    assert model.model is not None and 0 < model.prior < 1
    mixed = spark.createDataFrame([(given[0], 1)] * 3 + [(given[0], 0)], "url string, label int")
    assert UrlFilter(trees=1).fit(mixed).prior == 0.75


def test_small_shards_hold_no_more_than_their_postings():
    """A few long texts take one maximum for every word and block, not a row of floats for every word."""
    n, words = 3, 5000
    row = {"doc_ids": list(range(n)), "lengths": [words] * n, "terms": np.arange(n * words), "df": np.ones(n * words, int),
           "docs": np.repeat(np.arange(n, dtype=np.int32), words).tobytes(), "tfs": np.ones(n * words, np.int32).tobytes()}
    shard = search.Shard(row, float(words), search.K1, search.B)
    assert len(shard.run_max) == n * words and shard.n_blocks == 1
    assert [d for d, _ in shard.search(np.array([1, words + 2]), np.array([1.0, 2.0]), 2)] == [1, 0]


def plain_features(url):
    """The lexical features of a url in plain Python."""
    import math
    import re
    from collections import Counter
    text = (url or "").lower()
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    host = host.translate({c: c + 32 for c in range(65, 91)})
    n = max(len(text), 1)
    classes = collections.Counter(c if c in urls.ALPHABET else "" for c in text)
    entropy = -sum(c / n * math.log2(c / n) for c in classes.values())
    query = re.search(r"\?([^#]*)", text)
    digits = sum(c in "0123456789" for c in text)
    return [len(text), len(host), len(path), path.count("/"), host.count("."), digits / n,
            sum(c in "0123456789" for c in host), entropy, text.count("-"), text.count("="),
            len(query.group(1)) if query else 0, int("#" in text), int(text.startswith("https")), text.count("%"),
            path.count("."), ".".join(host.split(".")[-1:]), ".".join(host.split(".")[-2:])]


def test_lexical_features_equal_plain_ones(spark):
    given = ["https://www.A-b.example.co.uk/x/y-z.html?a=1&b=%20#t", "http://casino-77.win", "x", "", None, "://", "http://",
             "ftp://h.com//a..b/?q", "http://é.org/ü/%C3%BC?=#", "HTTP://UP.COM/PATH/1/22/333.PDF?x=y?z=1#a#b", "http://a.b?c/d#e"]
    given += [f"https://s{i}.d{i % 3}.net/p{'/q' * (i % 5)}?{'k=v&' * (i % 4)}" for i in range(30)]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "id int, url string")
    names = [*urls.FEATURES[:15], "suffix1", "suffix2"]
    got = {r["id"]: [r[c] for c in names] for r in rows_of(urls.lexical(urls.with_parts(table, "url"), "url"))}
    for i, url in enumerate(given):
        for name, have, want in zip(names, got[i], plain_features(url)):
            assert have == want or abs(have - want) < 1e-9, (url, name, have, want)


def test_rates_of_training_rows_leave_their_fold_out(spark):
    """A url alone on its host knows nothing of its own label."""
    rows = [(f"http://host{i}.org/", i % 2) for i in range(60)] + [(f"http://same.net/{i}", 1) for i in range(20)]
    model = UrlFilter(trees=1, smoothing=2.0).fit(spark.createDataFrame(rows, "url string, label int"))
    train = urls.lexical(urls.with_parts(spark.createDataFrame(rows, "url string, label int"), "url"), "url")
    train = train.withColumn("host_key", F.col("host")).withColumn("weight", F.lit(1.0))
    got = {r["url"]: r["host_rate"] for r in rows_of(model._out_of_fold(train))}
    folds = {r["url"]: r["f"] for r in rows_of(train.select("url", F.pmod(F.xxhash64("url"), F.lit(urls.FOLDS)).alias("f")))}
    for url, _ in rows:
        others = [x for x, _ in rows if "same.net" in x and "same.net" in url and folds[x] != folds[url]]
        assert abs(got[url] - (len(others) + 2 * model.prior) / (len(others) + 2)) < 1e-9


def test_hot_url_and_hot_document_are_reduced_or_split(spark):
    pages = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, "http://hot/1").otherwise(
        F.concat(F.lit("http://h"), "id", F.lit("/2"))).alias("url"))
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["label"]: (r["urls"], r["pages"]) for r in rows_of(
        labelled_pages(pages, labels).groupBy("label").agg(F.count("*").alias("urls"), F.sum("pages").alias("pages")))}
    assert got == {1: (1, 20_000), 0: (40_000, 40_000)}
    plan = labelled_pages(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "_key_hash" in plan
