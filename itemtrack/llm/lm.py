"""Operator 10: language-model scores from a log-frequency Bloom filter.

Word and word-pair counts of the training documents are quantised by their logarithm;
an n-gram of level q is put into a Bloom filter q times, once per level.  A count
is read back by asking for level 1, 2, ... until one is missing, and the pair's count is
smoothed with the word's.  The filter grows with the corpus, so it is never in one place:
it is built in segments by the n-grams' hashes, each sized by the levels counted in it, and
the distinct n-grams of each block of documents are sent to their segments and the levels
found there sent back.

The exact unigram baseline needs exact counts of an open vocabulary, which must not be
broadcast: documents are grouped into blocks of bounded text, each block's distinct
words are joined with the global counts, and block and dictionary meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.llm.common import materialize, mix64, slices, text_bytes, word_hashes
from itemtrack.session import path_exists, remove_path, scratch_path

FILTER_BITS = 1 << 29      # all segments together at least
LEVEL_BITS = 10            # bits of a segment per n-gram level in it at least: 1.7 % false hits a level with 3 probes
SEGMENTS = 256             # at least; a power of two
SEGMENT_BYTES = 32 << 20   # training text per segment at most: bounds a segment's n-grams and bits
KEY_BYTES = 5              # of a hash after its segment's bits; a segment's n-grams meet in 1e-5 of cases at most
PROBES = 3
PRIOR = 50.0               # weight of the word's own probability against its context's count
MAX_LEVEL = 48
BLOCK_BYTES = 8 << 20      # text of the documents that share one dictionary
FLUSH = 4_000_000          # n-gram occurrences that a task adds up at a time

_GOLD = np.uint64(0x9E3779B97F4A7C15)
START, END = word_hashes([b" ", b"\n"])  # no word holds a blank


def token_hashes(data: bytes) -> np.ndarray:
    """Hashes of the lower-cased (A-Z) words and the end of one text."""
    return np.append(word_hashes(data.lower().split()), END)


def pair_hashes(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix64(mix64(before * _GOLD + np.uint64(1)) + tokens)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count))."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level (0: none)."""
    low = np.exp2(level - 1.0)
    return np.where(level > 0, (low + 2 * low - 1) / 2, 0.0)


def places(keys: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    """Bit of a probe inside the n-gram's segment of ``size`` bits (a power of two)."""
    salt = np.uint64((level * 131 + probe + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(keys + salt) & np.uint64(size - 1)).astype(np.int64)


def found_levels(bits: np.ndarray, keys: np.ndarray, probes: int) -> np.ndarray:
    """The largest level of each n-gram of a segment up to which all levels are present."""
    found = np.zeros(len(keys), np.uint8)
    alive = np.arange(len(keys))
    for level in range(1, MAX_LEVEL + 1):
        for probe in range(probes):
            at = places(keys[alive], level, probe, 8 * len(bits))
            alive = alive[((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)]
        if not len(alive):
            break
        found[alive] = level
    return found


def short_hashes(hashes: np.ndarray, n_segments: int) -> np.ndarray:
    """The hashes without the bits that ``pack`` leaves out."""
    drop = np.uint64(max(64 - 8 * KEY_BYTES - (n_segments - 1).bit_length(), 0))
    return hashes.astype(np.uint64) >> drop << drop


def keys_of(hashes: np.ndarray, n_segments: int) -> np.ndarray:
    """The hashes' keys inside their segments, in the same order."""
    return hashes << np.uint64((n_segments - 1).bit_length()) >> np.uint64(64 - 8 * KEY_BYTES)


def pack(keys: np.ndarray) -> bytes:
    """Keys byte place by byte place: the high bytes of sorted keys compress well."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].T.tobytes()


def unpack(rows: list[bytes]) -> np.ndarray:
    """The keys of some packed rows, one after the other."""
    out = np.zeros((sum(map(len, rows)) // KEY_BYTES, 8), np.uint8)
    at = 0
    for row in rows:
        n = len(row) // KEY_BYTES
        out[at:at + n, :KEY_BYTES] = np.frombuffer(row, np.uint8).reshape(KEY_BYTES, n).T
        at += n
    return out.view("<u8").ravel()


def segment_cuts(hashes: np.ndarray, n_segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segments (top bits) that sorted hashes fall into, and where each one's begin, with the end."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    segment = (hashes >> np.uint64(64 - (n_segments - 1).bit_length())).astype(np.int64)
    starts = np.concatenate([[0], np.nonzero(segment[1:] != segment[:-1])[0] + 1])
    return segment[starts], np.append(starts, len(hashes))


def segments_for(text_bytes: int) -> int:
    """How many segments a training text of that size needs."""
    return max(SEGMENTS, 1 << (-(-text_bytes // SEGMENT_BYTES) - 1).bit_length())


class LogFrequencyFilter:
    """All segments of a filter in one process, for those that fit there."""

    def __init__(self, segments: dict[int, np.ndarray], n_segments: int, probes: int = PROBES):
        self.segments, self.n_segments, self.probes = segments, n_segments, probes

    def level(self, hashes: np.ndarray) -> np.ndarray:
        hashes, which = np.unique(hashes, return_inverse=True)
        found, keys = np.zeros(len(hashes), np.int64), keys_of(hashes, self.n_segments)
        names, cuts = segment_cuts(hashes, self.n_segments)
        for s, lo, hi in zip(names, cuts, cuts[1:]):
            if int(s) in self.segments:
                found[lo:hi] = found_levels(self.segments[int(s)], keys[lo:hi], self.probes)
        return found[which]


def ngram_counts(texts: DataFrame, n_segments: int = SEGMENTS) -> DataFrame:
    """(segment, h, c): hashes of words and word pairs of ``text`` and their counts, summed
    per task and packed by segment."""

    def summed(parts: list[np.ndarray]) -> pa.RecordBatch:
        hashes = short_hashes(np.concatenate(parts), n_segments)
        return _packed(*np.unique(hashes, return_counts=True), n_segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0
        for part in slices(batches):
            for data in text_bytes(part):
                tokens = token_hashes(data)
                before = np.concatenate([[START], tokens[:-1]])
                parts += [tokens, [START], pair_hashes(before, tokens)]
                held += 2 * len(tokens) + 1
            if held >= FLUSH:
                yield summed(parts)
                parts, held = [], 0
        if parts:
            yield summed(parts)

    return texts.mapInArrow(run, "segment long, h binary, c binary")


def _packed(hashes: np.ndarray, counts: np.ndarray, n_segments: int) -> pa.RecordBatch:
    """Sorted hashes and their counts as one row per segment."""
    names, cuts = segment_cuts(hashes, n_segments)
    keys, counts = keys_of(hashes, n_segments), counts.astype(np.int64)
    return pa.record_batch({"segment": pa.array(names, pa.int64()),
                            "h": pa.array([pack(keys[lo:hi]) for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
                            "c": pa.array([counts[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary())})


def filter_segments(counts: DataFrame, n_segments: int = SEGMENTS, n_bits: int = FILTER_BITS,
                    probes: int = PROBES) -> DataFrame:
    """(segment, bits): the written filter of all n-grams in ``counts`` (packed; an n-gram may
    be in several rows).  A segment has its share of ``n_bits``, and ``LEVEL_BITS`` for each
    level of the n-grams in it; a task holds one segment's n-grams and bits at a time."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def built(segment: int, h: list[bytes], c: list[bytes]) -> pa.RecordBatch:
        keys, ones = unpack(h), np.frombuffer(b"".join(c), np.int64)
        order = np.argsort(keys, kind="stable")  # sorted runs
        keys, ones = keys[order], ones[order]
        starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
        keys, level = keys[starts], np.minimum(levels(np.add.reduceat(ones, starts)), MAX_LEVEL)
        size = 1 << (max(n_bits // n_segments, LEVEL_BITS * int(level.sum()), 8) - 1).bit_length()
        bits = np.zeros(size, bool)
        for q in range(1, int(level.max()) + 1):
            keys, level = keys[level >= q], level[level >= q]
            for probe in range(probes):
                bits[places(keys, q, probe, size)] = True
        return pa.record_batch({"segment": pa.array([segment], pa.int64()),
                                "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, h, c = None, [], []
        for batch in batches:
            for i, segment in enumerate(batch.column(0).to_pylist()):
                if h and segment != current:
                    yield built(current, h, c)
                    h, c = [], []
                current = segment
                h.append(batch.column(1)[i].as_py())
                c.append(batch.column(2)[i].as_py())
        if h:
            yield built(current, h, c)

    rows = counts.repartition(parts, "segment").sortWithinPartitions("segment")
    return materialize(rows.mapInArrow(run, "segment long, bits binary"), "lm-filter")


def build_filter(counts: DataFrame, n_bits: int = FILTER_BITS, probes: int = PROBES) -> LogFrequencyFilter:
    """The filter of the n-grams in ``counts`` (h, c; an n-gram may have several rows) in this process."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, c = batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy()
            order = np.argsort(h)
            yield _packed(h[order], c[order], SEGMENTS)

    rows = filter_segments(counts.mapInArrow(run, "segment long, h binary, c binary"), SEGMENTS, n_bits, probes)
    return LogFrequencyFilter({r["segment"]: np.frombuffer(r["bits"], np.uint8) for r in rows.toLocalIterator()},
                              SEGMENTS, probes)


def look_up(segments: DataFrame, asked: DataFrame, probes: int = PROBES) -> DataFrame:
    """(block, segment, levels): for every row of ``asked`` (block, segment, keys: packed)
    the levels of its n-grams, one byte each; written.  In each partition a segment's bits come
    first, then the rows asking it."""
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, bits = None, None
        for batch in batches:
            names = batch.column("segment").to_numpy()
            out: list[bytes] = []
            blocks: list[int] = []
            starts = np.concatenate([[0], np.nonzero(names[1:] != names[:-1])[0] + 1, [len(names)]])
            for lo, hi in zip(starts, starts[1:]):
                first = lo
                if hi > lo and batch.column("bits")[lo].is_valid:
                    owner, bits = names[lo], np.frombuffer(batch.column("bits")[lo].as_py(), np.uint8)
                    first = lo + 1
                if first >= hi:
                    continue
                keys = [x.as_py() for x in batch.column("keys")[first:hi]]
                got = (found_levels(bits, unpack(keys), probes).tobytes() if owner == names[lo]
                       else bytes(sum(map(len, keys)) // KEY_BYTES))  # a segment without n-grams has no row
                cuts = np.cumsum([0] + [len(k) // KEY_BYTES for k in keys])
                out += [got[a:b] for a, b in zip(cuts, cuts[1:])]
                blocks += [*zip(batch.column("block")[first:hi].to_pylist(), names[first:hi])]
            if out:
                yield pa.record_batch({"block": pa.array([b for b, _ in blocks], pa.int64()),
                                       "segment": pa.array([int(s) for _, s in blocks], pa.int64()),
                                       "levels": pa.array(out, pa.binary())})

    null = F.lit(None)
    rows = (segments.select("segment", "bits", null.cast("long").alias("block"), null.cast("binary").alias("keys"))
            .unionByName(asked.select("segment", null.cast("binary").alias("bits"), "block", "keys"))
            .withColumn("asks", F.col("bits").isNull())
            .repartition(parts, "segment").sortWithinPartitions("segment", "asks"))
    return materialize(rows.mapInArrow(run, "block long, segment long, levels binary"), "lm-levels")


def block_pairs(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Pair hashes of the tokens of several documents that begin at ``starts``."""
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[starts] = START
    return pair_hashes(before, flat)


def block_grams(words: np.ndarray, pairs: np.ndarray, n_segments: int) -> np.ndarray:
    """All n-grams that a block asks the filter for: the start, its words, its pairs."""
    return short_hashes(np.concatenate([[START], words, pairs]), n_segments)


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
          n_bits: int = FILTER_BITS, probes: int = PROBES, prior: float = PRIOR,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score and score per row.

    ``training`` says which rows are learned from (null: not).  A null or empty text has
    one token, its end; repeated rows count and score each; without training rows all
    counts are 0 and every score is that of an unknown token.  An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"),
                        F.col(text_col).alias("text"))
    learned = plain.filter("training").select("text")
    n_segments = segments_for(learned.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    segments = filter_segments(ngram_counts(learned, n_segments), n_segments, n_bits, probes)
    kind = plain.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as places in their block's sorted words, those words, and its n-grams by segment."""
        ids, marks, found, size, n = [], [], [], 0, 0
        first = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            flat = np.concatenate(found)
            words, which = np.unique(flat, return_inverse=True)
            own = np.repeat(np.array(marks), [len(f) for f in found])
            seen = np.bincount(which[own], minlength=len(words))
            docs_n, cuts = len(found), np.cumsum([len(f) for f in found])[:-1]
            lists = [x.astype(np.int32) for x in np.split(which, cuts)]
            grams = np.unique(block_grams(words, block_pairs(flat, np.append(0, cuts)), n_segments))
            names, ends = segment_cuts(grams, n_segments)
            keys = keys_of(grams, n_segments)
            packed = [pack(keys[lo:hi]) for lo, hi in zip(ends, ends[1:])]
            asks = len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n] * (docs_n + 1 + asks), pa.int64()),
                 pa.concat_arrays([pa.array(ids, id_type), pa.nulls(1 + asks, id_type)]),
                 pa.array(marks + [None] * (1 + asks), pa.bool_()),
                 pa.array(lists + [None] * (1 + asks), pa.list_(pa.int32())),
                 pa.array([None] * docs_n + [words.astype(np.int64)] + [None] * asks, pa.list_(pa.int64())),
                 pa.array([None] * docs_n + [seen] + [None] * asks, pa.list_(pa.int64())),
                 pa.array([None] * (docs_n + 1) + names.tolist(), pa.int64()),
                 pa.array([None] * (docs_n + 1) + packed, pa.binary())],
                ["block", "doc_id", "training", "tokens", "words", "seen", "segment", "keys"])

        for part in slices(batches):
            id_type = part.schema.field("doc_id").type
            for i, m, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), text_bytes(part)):
                ids.append(i)
                marks.append(m)
                found.append(token_hashes(data))
                size += len(data) + 1
                if size >= block_bytes:
                    yield out()
                    ids, marks, found, size, n = [], [], [], 0, n + 1
        if found:
            yield out()

    # One folder per kind of row, so that the keys can go once they are answered.
    schema = (f"block long, doc_id {kind}, training boolean, tokens array<int>, words array<long>, "
              "seen array<long>, segment long, keys binary")
    path = scratch_path(spark, "lm-blocks")
    of_kind = F.when(F.col("keys").isNotNull(), "keys").when(F.col("words").isNotNull(), "words").otherwise("tokens")
    plain.mapInArrow(blocks, schema).withColumn("kind", of_kind).write.partitionBy("kind").option("compression", "zstd").parquet(path)

    def rows_of(name: str) -> DataFrame:
        folder = f"{path}/kind={name}"
        return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)

    answers = look_up(segments, rows_of("keys").select("block", "segment", "keys"), probes)
    remove_path(spark, f"{path}/kind=keys")
    for file in segments.inputFiles()[:1]:             # the filter has answered all it will be asked
        remove_path(spark, file.rsplit("/", 1)[0])
    words = (rows_of("words").select("block", F.posexplode(F.arrays_zip("words", "seen")))
             .select("block", F.col("pos").alias("place"), F.col("col.words").alias("h"), F.col("col.seen").alias("c")))
    counts = materialize(words.groupBy("h").agg(F.sum("c").alias("total")).filter("total > 0"), "lm-counts")
    whole = counts.agg(F.sum("total").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, n_words = int(whole["n"] or 0), int(whole["v"])
    entries = (words.join(counts, "h", "left")
               .select("block", "place", "h", F.coalesce("total", F.lit(0)).cast("long").alias("c"))
               .unionByName(answers, allowMissingColumns=True))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.filter(pc.is_valid(right.column("place"))).sort_by("place")
        heard = right.filter(pc.is_valid(right.column("levels"))).sort_by("segment")
        h, c = (known.column(x).to_numpy() for x in ("h", "c"))
        h = h.astype(np.uint64)
        total = n_train + 0.5 * (n_words + 1)
        exact = np.log10((c + 0.5) / total)
        tokens = left.column("tokens").combine_chunks()
        flat = tokens.values.to_numpy() if len(tokens) else np.zeros(0, np.int32)
        cuts = tokens.offsets.to_numpy().astype(np.int64) - int(tokens.offsets[0].as_py())
        flat = flat[int(tokens.offsets[0].as_py()):int(tokens.offsets[len(tokens)].as_py())].astype(np.int64)
        # The filter's counts of the block's n-grams, answered in the order of their hashes.
        grams, which = np.unique(block_grams(h, block_pairs(h[flat], cuts[:-1]), n_segments), return_inverse=True)
        answered = np.frombuffer(b"".join(heard.column("levels").to_pylist()), np.uint8)
        if len(answered) != len(grams):
            raise ValueError(f"{len(answered)} levels for {len(grams)} n-grams of a block")
        filtered = level_count(answered.astype(np.int64))[which]
        begin, about, both = filtered[0], filtered[1:len(h) + 1], filtered[len(h) + 1:]
        alone = (about + 0.5) / total
        context = np.empty(len(flat))
        context[1:], context[cuts[:-1]] = about[flat[:-1]], begin
        # Dirichlet smoothing; a context cannot be rarer than a pair it begins.
        p = np.log10((both + prior * alone[flat]) / (np.maximum(context, both) + prior))
        return pa.table({"doc_id": left.column("doc_id"), "training": left.column("training"),
                         "n_tokens": pa.array(np.diff(cuts)),
                         "n_known": pa.array(np.add.reduceat(c[flat] > 0, cuts[:-1], dtype=np.int64)),
                         "base_score": pa.array(np.add.reduceat(exact[flat], cuts[:-1])),
                         "score": pa.array(np.add.reduceat(p, cuts[:-1]))})

    texts = rows_of("tokens").select(F.col("block").alias("own"), "doc_id", "training", "tokens")
    scored = texts.groupBy("own").cogroup(entries.groupBy("block")).applyInArrow(
        judge, f"doc_id {kind}, training boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "training", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                         "base_score", "score")
