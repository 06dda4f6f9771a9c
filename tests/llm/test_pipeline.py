"""The corpus pipeline, stage by stage, against brute-force versions."""
import random

import numpy as np
import public_tokenizers as P
import tokenizers

import corpus_pipeline
from itemtrack.llm import langid, quality
from itemtrack.llm.common import fold, materialize

from llm_helpers import SF, docs, edges, empty, labels  # noqa: F401
from test_documents import plain_base, plain_ratio, plain_vector
from test_search_dedup_urls import expected_ids
from test_tokenizers import check_pieces


def expected_after(name, docs, before, labels):
    """The rows that stage ``name`` must keep of ``before``."""
    if name == "language":
        profiles = langid.LanguageProfiles().fit(docs.filter(fold("doc_id", 4) != 2))
        out = []
        for r in before:
            if any(c.isalpha() for c in r["text"] or ""):
                vector = plain_vector(r["text"], langid.DIM)
                if (profiles.prototypes @ vector).max() / np.linalg.norm(vector) >= corpus_pipeline.MIN_LANGUAGE_SCORE:
                    out.append(r)
        return out
    if name == "quality":
        model = quality.QualityRatio().fit(docs, labels)
        base = {id(r): plain_base(r["text"] or "") for r in before}
        return [r for r in before if base[id(r)]["n_words"] >= 20
                and 100 * base[id(r)]["n_repeat_words"] <= 30 * base[id(r)]["n_words"]
                and plain_ratio(model, r["text"]) >= model.threshold]
    first = {c for _, c in expected_ids([(r["doc_id"], r["text"]) for r in before])}
    return [r for r in before if r["doc_id"] in first]


def test_stages(spark, docs, labels):
    model = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        out = materialize(stage(spark, now, SF), "test")
        if name != "packing":
            assert out.columns == docs.columns
            want = expected_after(name, now, before, labels)
            assert 0 < len(want) and sorted(map(tuple, want)) == sorted(map(tuple, out.collect()))
        now = out
    ids = {r["doc_id"]: np.array(model.encode(r["text"], add_special_tokens=False).ids + [2], "<u4") for r in before}
    rows = [r.asDict() for r in now.collect()]
    assert check_pieces(rows, ids) == sum(map(len, ids.values()))
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_stages_take_edge_rows(spark, edges, empty):
    for source in (edges, empty):
        now = source
        for name, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, SF), "test")
            if name != "packing":
                assert now.columns == source.columns
    assert now.count() == 0
    alone = [stage(spark, edges, SF) for _, stage in corpus_pipeline.STAGES]
    assert all(df.count() > 0 for df in alone)


def test_texts_of_no_learned_language_go(spark, docs):
    """Unlearned scripts and random letters go; very short clean texts and excerpts stay."""
    rng = random.Random(1)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω",
                 "bcdfghjklmnpqrstvwxz"]
    noise = [" ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 9))) for _ in range(n))
             for a in alphabets for n in (50, 500) for _ in range(20)]
    clean = [r["text"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    clean += [" ".join(t.split()[10:60]) for t in clean if len(t.split()) > 60]
    clean += ["A.", "A.\nAll rights reserved."]
    rows = [(-1 - i, t, None) for i, t in enumerate(noise)] + [(10 ** 9 + i, t, None) for i, t in enumerate(clean)]
    added = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, added, SF).collect()}
    assert sum(-1 - i in kept for i in range(len(noise))) <= 0.01 * len(noise)
    assert all(10 ** 9 + i in kept for i in range(len(clean)))
