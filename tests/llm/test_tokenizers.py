"""Operators 1, 4 and 5 against the tokenizer libraries and a brute-force packer."""
import base64
import bisect
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers

from itemtrack.llm import queries
from itemtrack.llm.bpe import BpeTokenizer, PrefixBpe, load_tokens
from itemtrack.llm.packing import OpenBins, best_fit_plan, pack
from itemtrack.llm.token_counts import Counter, UnigramVocabulary, count_tokens

from llm_helpers import SF, docs, edges, empty, labels, rows_of  # noqa: F401

ODD = list("ab  \n\t'sétT1２½   中文字é́😀.,!?'ll") + [
    "the", "   ", "\n\n", " a", "<|endoftext|>", "'re", "ing", " \n", "\x1c", "\x85", "▁", "▁▁"]
BPE_JSON = P.path("byte_bpe_50k.json")


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def coder():
    return PrefixBpe(load_tokens(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_prefix_tables_grow_by_exact_appends(coder, library):
    data = "internationalisation'saaaaaaaaaaaaaaaa".encode()
    table = []
    for end in range(1, len(data) + 1):
        table = coder.last_tokens(data[:end], table)
        assert list(coder.walk_back(table)) == library._core_bpe.encode_single_piece(data[:end])


def test_odd_texts_and_edits_equal_the_library(coder, library):
    rng = random.Random(2)
    for text in odd_texts(3000):
        want = library.encode_ordinary(text)
        assert coder.encode(text).tolist() == want, text
        start = rng.randint(0, len(text))
        end, new = rng.randint(start, len(text)), "".join(rng.choices(ODD, k=3))
        changed, ids = coder.edit(text, np.array(want, np.int32), start, end, new)
        assert changed == text[:start] + new + text[end:]
        assert ids.tolist() == library.encode_ordinary(changed), (text, start, end, new)


def test_long_runs(coder, library):
    for text in ("a" * 20_000, " " * 5000 + "x", "\n" * 5000, "ab" * 9000):
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def check_op1(rows, texts, library):
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_op1_query(spark, docs, library):
    got = rows_of(queries.op1_byte_bpe(spark, SF))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(got) == len(texts)
    check_op1(got, texts, library)


def test_bpe_operator_edges(spark, edges, empty, library):
    bpe = BpeTokenizer(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = rows_of(bpe.decode(bpe.encode(edges, "c0", "key"), "c0", "ids", ids_col="ids"))
    texts = {r["c0"]: r["text"] or "" for r in edges.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert r["ids"] == library.encode_ordinary(texts[r["c0"]])
        assert bytes(r["decoded"]) == texts[r["c0"]].encode()
    assert bpe.decode(bpe.encode(empty, "doc_id"), "doc_id").count() == 0


def test_bpe_edit_operator(spark, library):
    rows = [(1, "a b c", library.encode_ordinary("a b c"), 5, 5, " and more"), (2, None, None, 0, 0, "new"),
            (3, "hello world", library.encode_ordinary("hello world"), 0, 5, None)]
    df = spark.createDataFrame(rows, "id long, t string, i array<int>, s int, e int, n string")
    bpe = BpeTokenizer(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = {r["id"]: r for r in rows_of(bpe.edit(df, "id", text_col="t", ids_col="i", start_col="s", end_col="e",
                                                  new_col="n"))}
    assert [got[i]["text"] for i in (1, 2, 3)] == ["a b c and more", "new", " world"]
    assert all(r["ids"] == library.encode_ordinary(r["text"]) for r in got.values())


# -- operator 4 ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return UnigramVocabulary.from_model(P.path("piece_bpe_32k.model"))


def unigram(vocabulary):
    model = tokenizers.Tokenizer(tokenizers.models.Unigram(
        list(vocabulary.pieces), unk_id=vocabulary.unknown, byte_fallback=vocabulary.byte_fallback))
    model.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return lambda text: len(model.encode(text).ids)


def test_counts_equal_the_library(spark, docs, vocabulary):
    want = unigram(vocabulary)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op4_token_counts(spark, SF).collect()}
    assert got == {i: want(t) for i, t in texts.items()}


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_of_odd_texts(vocabulary, fallback):
    own = UnigramVocabulary(vocabulary.pieces, vocabulary.unknown, fallback)
    counter, want = Counter(own), unigram(own)
    for text in odd_texts(1500, 4):
        assert counter.count(text)[0] == want(text), text


def test_ties_and_fractional_scores():
    own = UnigramVocabulary((("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0),
                             ("ba", -1.5), ("aba", -3.0), ("bb", -2.0)), 0, False)
    counter, want = Counter(own), unigram(own)
    rng = random.Random(5)
    for _ in range(800):
        text = "".join(rng.choices("ab ?", k=rng.randint(0, 12)))
        assert counter.count(text)[0] == want(text), text


def test_count_operator_edges(edges, empty, vocabulary):
    want = unigram(vocabulary)
    got = {r["c0"]: r["n_tokens"] for r in count_tokens(edges, vocabulary, "c0").collect()}
    assert got == {r["c0"]: want(r["text"] or "") for r in edges.collect()}
    assert count_tokens(empty, vocabulary, "doc_id").count() == 0


# -- operator 5 ------------------------------------------------------------------------

def best_fit_bins(lengths, capacity):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        room = rooms.pop(i) if i < len(rooms) else capacity
        n += room == capacity
        if room > x:
            bisect.insort(rooms, room - x)
    return n


def test_segment_tree_finds_the_tightest_bin():
    rng, bins, rooms = random.Random(1), OpenBins(37), []
    for step in range(2000):
        if rng.random() < 0.5 or not rooms:
            room = rng.randint(1, 37)
            bins.add(room, step, 1)
            bisect.insort(rooms, room)
        size = rng.randint(1, 37)
        i = bisect.bisect_left(rooms, size)
        want = rooms[i] if i < len(rooms) else None
        assert bins.tightest(size) == want
        if want is not None and rng.random() < 0.7:
            bins.take(rooms.pop(i))


def test_plan_equals_best_fit_decreasing_over_all_pieces():
    rng = random.Random(7)
    for _ in range(300):
        capacity = rng.randint(1, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        plan = best_fit_plan(counts, capacity)
        used = {}
        for k, n in counts.items():
            rows = plan[plan[:, 0] == k]
            for rank in range(n):
                row = rows[np.searchsorted(rows[:, 1], rank, "right") - 1]
                turn = rank - row[1]
                used.setdefault(row[3] + turn // row[2], []).append((row[4] + turn % row[2] * k, k))
        assert len(used) == best_fit_bins(lengths, capacity)
        for spans in used.values():
            at = 0
            for offset, k in sorted(spans):
                assert offset == at
                at += k
            assert at <= capacity


def check_pieces(rows, ids, capacity=1024):
    """``ids``: token ids of every document, in any order of equal documents."""
    by_bin, total = {}, 0
    for r in rows:
        data = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(data) == r["length"] and zlib.crc32(data.tobytes()) == r["ids_crc32"]
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total += r["length"]
    for spans in by_bin.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_bin) == best_fit_bins([r["length"] for r in rows], capacity)
    return total


def test_op5_query(spark, docs):
    model = tokenizers.Tokenizer.from_file(BPE_JSON)
    model.encode_special_tokens = True
    ids = {r["doc_id"]: np.array(model.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
           for r in docs.collect()}
    rows = rows_of(queries.op5_packing(spark, SF))
    assert check_pieces(rows, ids) == sum(map(len, ids.values()))
    for i, x in ids.items():
        own = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert [p for p, _, _ in own] == list(range(-(-len(x) // 1024)))
        assert [n for _, _, n in own[1:]] == [1024] * (len(own) - 1)


def test_pack_edges(edges, empty):
    model = tokenizers.Tokenizer.from_file(BPE_JSON)
    model.encode_special_tokens = True
    source = edges.collect()
    rows = rows_of(pack(edges, BPE_JSON, capacity=64, id_col="key", with_ids=True))
    ids = {r["key"]: np.array(model.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
           for r in source}
    assert check_pieces(rows, ids, 64) == sum(map(len, ids.values()))
    for r in rows:
        assert r["ids"] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tolist()
    assert pack(empty, BPE_JSON).count() == 0


def test_tables_after_edits_equal_the_library(coder, library):
    rng = random.Random(8)
    data = "".join(rng.choice(["inter", "nation", "al", "zq", "é", "aaa", "ß"]) for _ in range(800)).encode()
    table = coder.last_tokens(data)
    for _ in range(40):
        start = rng.randrange(len(data))
        end, new = min(len(data), start + rng.randint(0, 9)), rng.choice([b"", b"x", b"tion", b"aaaaaaaa"])
        changed, after = coder.edit_table(data, table, start, end, new)
        assert changed == data[:start] + new + data[end:] and list(after) == list(coder.last_tokens(changed))
        data, table = changed, after
    assert list(coder.walk_back(table)) == library._core_bpe.encode_single_piece(data)


def test_texts_without_spaces_of_many_megabytes(coder, library, vocabulary):
    """Nothing of such texts is remembered, and counting holds a window of them."""
    import tracemalloc
    text = "".join(random.Random(5).choices("abcdefgh", k=2_000_000))
    assert coder.encode(text).tolist() == library.encode_ordinary(text)
    assert all(len(p) <= 64 for p in coder.chunks.held)
    counter = Counter(vocabulary)
    small = text[:20_000]
    want = counter.viterbi(small)
    tracemalloc.start()
    counter.viterbi(text[:400_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20
    library_counter = tokenizers.Tokenizer(tokenizers.models.Unigram(list(vocabulary.pieces), vocabulary.unknown,
                                                                     byte_fallback=vocabulary.byte_fallback))
    assert want[0] == len(library_counter.encode(small, add_special_tokens=False).ids)


def test_memories_are_bounded_and_released(coder):
    from itemtrack.llm.common import Remembered, slices
    import pyarrow as pa
    memory, other = Remembered(2_000), Remembered()
    assert not memory.put("x" * 65, b"") and memory.put("a", b"1", 1)
    assert not all(memory.put(f"p{i}", b"", 0) for i in range(100)) and len(memory.held) <= 10
    other.put("b", b"")
    list(slices(iter([pa.record_batch({"text": ["t"]})]), own=memory))
    assert memory.held and not other.held and other.left == other.max_bytes


def test_packing_ids_equal_the_tokenizers_library():
    """Byte-level files run in another library than others do; both give the file's ids."""
    import json
    from itemtrack.llm.packing import Encoder, byte_level_ranks
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        with open(P.path(name), encoding="utf-8") as f:
            text = f.read()
        assert (byte_level_ranks(json.loads(text)) is not None) == name.startswith("byte")
        library = tokenizers.Tokenizer.from_str(text)
        library.encode_special_tokens = True
        given = odd_texts(1500, 9) + ["", " ", "a" * 5000, "x\r\n\r\n  y"]
        for t, ids in zip(given, Encoder(text).encode(given)):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_unigram_best_path_against_all_paths():
    """Random vocabularies, equal scores included: tokens and score of the path that the rule names."""
    import random
    from itemtrack.llm.token_counts import Counter, UnigramVocabulary
    rnd = random.Random(4)

    def plain(counter, text):                       # (score, tokens, ends in an unknown character) by place
        pieces, best = dict(counter.vocabulary.pieces), [(0.0, 0, False)]
        for end in range(1, len(text) + 1):
            paths = [(best[i][0] + pieces[text[i:end]], best[i][1] + 1, False) for i in range(end)
                     if text[i:end] in pieces]
            found = max(paths, key=lambda p: p[0], default=None)     # of equal ones the longest last piece
            score, tokens, open_ = best[-1]
            if text[end - 1] not in pieces and (found is None or score + counter.unknown > found[0]):
                found = (score + counter.unknown, tokens + (len(text[end - 1].encode()) if counter.vocabulary.byte_fallback
                                                            else not open_), True)
            best.append(found)
        return best[-1][1], best[-1][0]

    for trial in range(200):
        made = {"".join(rnd.choice("abé€") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(2, 12))}
        scores = {p: float(-rnd.randint(0, 3)) if trial % 2 else -rnd.random() for p in sorted(made)}
        counter = Counter(UnigramVocabulary(tuple(scores.items()), 0, trial % 4 < 2))
        for _ in range(5):
            text = "".join(rnd.choice("abé€z😀") for _ in range(rnd.randint(1, 30)))
            assert counter.viterbi(text) == plain(counter, text), (scores, text)
