"""Operators 6, 8, 9 and 10 against brute-force versions."""
import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from itemtrack.llm import langid, lm, quality, queries, sharding
from itemtrack.llm.common import fold, word_hashes

from llm_helpers import SF, docs, edges, empty, labels, rows_of  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# -- operator 6 ------------------------------------------------------------------------

def test_language_of_held_out_documents(spark, docs):
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = rows_of(queries.op6_language_id(spark, SF))
    assert len(rows) == len(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in out) >= 0.97 * len(out)


def plain_vector(text, dim):
    """Letter by letter, as the definition says."""
    kept = [c if c.isalpha() else " " for c in " " + text.lower() + " "]
    total = np.zeros(dim)
    for a, b, c in zip(kept, kept[1:], kept[2:]):
        if b != " ":
            va, vb, vc = (langid._letter_vector(ord(x), dim).astype(float) for x in (a, b, c))
            total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_bundles_equal_the_definition(edges):
    texts = [r["text"] or "" for r in edges.collect() if len(r["text"] or "") < 3000]
    got = langid.bundle(*langid.grams_of(texts), len(texts), 64)
    assert np.array_equal(got, np.array([plain_vector(t, 64) for t in texts]))


def test_language_edges(edges, empty):
    profiles = langid.LanguageProfiles().fit(edges)
    rows = {r["c0"]: r for r in rows_of(profiles.predict(edges, "c0", "doc_id"))}
    for r in edges.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (rows[r["c0"]]["lang_pred"], rows[r["c0"]]["score"]) == ("und", 0.0)
        else:
            assert rows[r["c0"]]["lang_pred"] in ("en", "de", "fr")
    kept = profiles.keep_rows(edges, 0.01)
    assert kept.columns == edges.columns
    good = {c for c, r in rows.items() if r["lang_pred"] != "und" and r["score"] >= 0.01}
    want = {r["c0"]: r for r in edges.collect() if r["c0"] in good}
    assert {r["c0"]: r for r in kept.collect()} == want
    nothing = langid.LanguageProfiles().fit(empty)
    assert {r["lang_pred"] for r in nothing.predict(edges, "c0").collect()} == {"und"}
    assert profiles.predict(empty, "doc_id").count() == 0
    with pytest.raises(ValueError):
        langid.LanguageProfiles(max_languages=1).fit(edges)


# -- operator 8 ------------------------------------------------------------------------

def check_shards(rows, source, n):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source)
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    total = sum(r["size"] for r in rows)
    # Groups of equal texts (here: of equal checksum and size) that fit a shard lie in one.
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text_crc32"], r["size"]].append(r)
    whole = {g: sum(r["size"] for r in own) for g, own in groups.items() if sum(r["size"] for r in own) * n <= total}
    assert all(len({r["shard"] for r in groups[g]}) == 1 for g in whole)
    largest = max([r["size"] for r in rows] + list(whole.values()))
    for shard, own in shards.items():
        assert 0 <= shard < n
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / n) <= largest


def test_op8_query(spark, docs):
    rows = rows_of(queries.op8_sharding(spark, SF))
    check_shards(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 16)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    cur = con.execute(queries.ORACLE["op8_sharding"])
    names = [d[0] for d in cur.description]
    key = lambda r: tuple(str(r[c]) for c in sorted(names))
    assert sorted(key(r) for r in rows) == sorted(key(dict(zip(names, r))) for r in cur.fetchall())


def test_shard_edges(edges, empty):
    source = [(r["doc_id"], r["text"]) for r in edges.collect()]
    check_shards(rows_of(sharding.byte_shards(edges, 5)), source, 5)
    check_shards(rows_of(sharding.byte_shards(edges, 1)), source, 1)
    assert sharding.byte_shards(empty, 5).count() == 0


# -- operator 9 ------------------------------------------------------------------------

def plain_base(text):
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 2000
            else len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def check_base(rows, texts):
    for r, text in zip(rows, texts):
        want = plain_base(text)
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def plain_ratio(model, text):
    """Buckets one by one."""
    words = WORDS.findall(text)
    hashes = word_hashes([w.encode() for w in words])
    cells = list(quality.buckets(hashes, model.n_buckets))
    assert len(cells) == max(0, 2 * len(words) - 1)
    return sum(model.ratio[c] for c in cells) / len(cells) if cells else 0.0


def test_op9_query(spark, docs, labels):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = rows_of(queries.op9_quality_rules(spark, SF))
    assert len(rows) == len(texts)
    check_base(rows, [texts[r["doc_id"]] for r in rows])
    model = quality.QualityRatio().fit(docs, labels)
    for r in rows:
        assert r["score"] == pytest.approx(plain_ratio(model, texts[r["doc_id"]]))
        assert r["kept"] == (not r["base_failed"] and r["score"] >= model.threshold)
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [r for r in rows if marks.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r for r in rows if marks.get(r["doc_id"]) == 0]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.5 * len(bad)


def test_ratio_counts_every_document(docs, labels):
    small = quality.QualityRatio(n_buckets=64).fit(docs, labels)
    raw = np.zeros(64)
    for r in docs.collect():
        np.add.at(raw, quality.buckets(word_hashes((r["text"] or "").encode().split()), 64), 1)
    target = np.exp(small.ratio) * (raw + 1) / (raw.sum() + 64)
    assert target.sum() == pytest.approx(1.0)        # the target's multinomial comes back


def test_quality_edges(spark, edges, empty):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (14, 1, None), (13, 0, 0), (None, 1, 0), (99, None, 1)],
                                   "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for marks in (labels, none):
        model = quality.QualityRatio(n_buckets=256).fit(edges, marks)
        rows = {r["c0"]: r for r in rows_of(model.measure(edges, "c0"))}
        source = edges.collect()
        check_base([rows[r["c0"]] for r in source], [r["text"] or "" for r in source])
        kept = model.keep_rows(edges)
        assert kept.columns == edges.columns
        assert {r["c0"]: r for r in kept.collect()} == {r["c0"]: r for r in source if rows[r["c0"]]["kept"]}
    assert quality.QualityRatio().fit(empty, none).measure(empty, "doc_id").count() == 0


# -- operator 10 -----------------------------------------------------------------------

def tokens(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)) + ["\n"]


def check_lm(rows, texts, training, prior):
    """Exact base; scores as from the true counts' levels (the filter is nearly empty)."""
    words, pairs = collections.Counter(), collections.Counter()
    for i, text in texts.items():
        if training(i):
            seen = tokens(text)
            words.update(seen)
            pairs.update(zip([" "] + seen, seen))
            words[" "] += 1
    starts = words.pop(" ", 0)
    n, v = sum(words.values()), len(words)
    level = lambda c: 0 if not c else lm.level_count(np.array([math.floor(math.log2(c)) + 1]))[0]
    for r in rows:
        seen = tokens(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(seen), sum(words[t] > 0 for t in seen), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[t] + .5) / (n + .5 * (v + 1))) for t in seen))
        want = 0
        for a, b in zip([" "] + seen, seen):
            both = level(pairs[a, b])
            context = level(starts if a == " " else words[a])
            alone = (level(words[b]) + .5) / (n + .5 * (v + 1))
            want += math.log10((both + prior * alone) / (max(context, both) + prior))
        assert r["score"] == pytest.approx(want)


def test_op10_query(spark, docs):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = rows_of(queries.op10_lm_scoring(spark, SF))
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    assert {r["doc_id"] for r in rows if r["held_out"]} == held and len(rows) == len(texts)
    check_lm(rows, texts, lambda i: i not in held, lm.PRIOR)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_filter_never_loses_a_level(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-2 ** 63, 2 ** 63 - 1, 4000)
    counts = 1 + (rng.pareto(1.0, 4000) * 2).astype(int)
    rows = [(int(h), int(c)) for h, c in zip(hashes, counts)] + [(int(hashes[0]), 5)]
    counts[0] += 5
    built = lm.build_filter(spark.createDataFrame(rows, "h long, c long"), 1 << 20)
    got = built.level(hashes.astype(np.uint64))
    assert (got >= lm.levels(counts)).all()
    assert (got == lm.levels(counts)).mean() > 0.99
    strangers = built.level(rng.integers(0, 2 ** 63, 4000).astype(np.uint64))
    assert (strangers > 0).mean() < 0.01
    nothing = lm.build_filter(spark.createDataFrame([], "h long, c long"), 1 << 16)
    assert (nothing.level(hashes.astype(np.uint64)) == 0).all()


def test_lm_edges(edges, empty):
    source = edges.collect()
    texts = {r["key"]: r["text"] or "" for r in source}
    rows = rows_of(lm.score(edges, fold("key", 3) != 1, id_col="key", n_bits=1 << 24, block_bytes=20_000))
    assert len(rows) == len(source)
    check_lm(rows, texts, lambda i: zlib.crc32(str(i).encode()) % 3 != 1, lm.PRIOR)
    untaught = rows_of(lm.score(edges, fold("key", 1) == 1, id_col="key", n_bits=1 << 16))
    assert {(r["n_known"], r["train_tokens"]) for r in untaught} == {(0, 0)}
    assert lm.score(empty, fold("doc_id", 5) != 1, n_bits=1 << 16).count() == 0


def test_filter_grows_with_the_corpus(spark):
    """Hits of unseen n-grams stay rare and counts right, however many levels are put in."""
    for n in (2_000, 200_000):
        counts = spark.range(n).select(F.xxhash64("id").alias("h"), (1 + F.col("id") % 3).alias("c"))
        built = lm.build_filter(counts, 1 << 16)
        rows = counts.limit(4000).toPandas()
        got, want = built.level(rows["h"].to_numpy().astype(np.uint64)), lm.levels(rows["c"].to_numpy())
        assert (got >= want).all() and (got == want).mean() > 0.97
        strangers = built.level(np.random.default_rng(2).integers(0, 2 ** 64, 20_000, np.uint64))
        assert (strangers > 0).mean() < 0.025
    assert lm.segments_for(0) == lm.SEGMENTS and lm.segments_for(30 * 10 ** 9) == 1024


def test_scores_from_many_segments(edges, monkeypatch):
    """More text takes more segments; the scores stay those of the true levels."""
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 100)
    texts = {r["key"]: r["text"] or "" for r in edges.collect()}
    assert lm.segments_for(sum(map(len, texts.values()))) > lm.SEGMENTS
    check_lm(rows_of(lm.score(edges, fold("key", 3) != 1, id_col="key", block_bytes=20_000)), texts,
             lambda i: zlib.crc32(str(i).encode()) % 3 != 1, lm.PRIOR)
