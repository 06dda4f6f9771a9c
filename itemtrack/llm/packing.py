"""Operator 5: best-fit-decreasing packing of documents into token sequences.

Best fit depends only on how many pieces there are of each length.  Spark counts them
(at most ``capacity`` rows), the plan is made for runs of equal pieces - a segment tree
over remaining capacities finds the tightest open bin - and every piece finds its bin
and offset from its rank among the pieces of its length.  The result is the packing
that best-fit decreasing gives over all pieces of the corpus, while no task and not
the driver ever holds the pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.llm.common import materialize, slices, texts


# Fixed value: how byte-level tokenizers split a text before they merge.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_level_ranks(tokenizer: dict) -> dict[bytes, int] | None:
    """Token bytes and ids of a byte-level BPE tokenizer file whose merges are in the order of
    the ids they give, so that ids serve as merge ranks; None for any other."""
    model, split = tokenizer["model"], tokenizer.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and not tokenizer.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    # The vocabulary writes a byte as a printable character: itself, or one from 256 on, in order.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    special = {t["content"] for t in tokenizer.get("added_tokens", ())}
    return {bytes(map(byte_of.get, t)): i for t, i in model["vocab"].items() if t not in special}


class Encoder:
    """Ids of whole texts by a public tokenizer file, without special tokens (their strings in
    a text are ordinary text).  Byte-level BPE files run in the faster of the two public
    libraries, which gives the same ids; nothing is remembered between texts."""

    def __init__(self, tokenizer_json: str):
        ranks = byte_level_ranks(json.loads(tokenizer_json))
        if ranks is not None:
            import tiktoken
            coder = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.ids = lambda text: coder.encode_to_numpy(text, disallowed_special=())
        else:
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_str(tokenizer_json)
            tokenizer.encode_special_tokens = True
            self.ids = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, strings: list[str]) -> list[np.ndarray]:
        return [self.ids(text) for text in strings]


@lru_cache(2)
def _encoder(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


class OpenBins:
    """Runs of equal open bins by remaining capacity, under a segment tree that finds the
    least remaining capacity of at least a given size in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            self.runs.setdefault(room, []).append((first, n))
            node = self.leaves + room
            while node and not self.some[node]:
                self.some[node] = True
                node >>= 1

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        node = self.leaves + room
        if not self.runs[room]:
            self.some[node] = False
            while node > 1:
                node >>= 1
                self.some[node] = self.some[2 * node] or self.some[2 * node + 1]
        return run

    def tightest(self, size: int) -> int | None:
        node = self.leaves + size
        if node >= 2 * self.leaves:
            return None
        while not self.some[node]:                   # up to the first subtree to the right
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:                    # down to its first leaf
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, bins' pieces each, first bin, offset): the pieces of a
    length with rank >= first rank fill bins from ``first bin`` on, so many in each."""
    bins, n_bins, rows = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, n = n_bins, -(-left // (capacity // length))
                n_bins += n
            else:
                first, n = bins.take(room)
            # After a piece the same bin is the tightest one as long as another piece fits.
            each = room // length
            full = min(n, left // each)
            used = full
            if full:
                rows.append((length, rank, each, first, capacity - room))
                bins.add(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:
                rows.append((length, rank, left, first + full, capacity - room))
                bins.add(room - left * length, first + full, 1)
                rank, left, used = rank + left, 0, full + 1
            if used < n:
                bins.add(room, first + used, n - used)
    return np.array(rows, np.int64).reshape(-1, 5)


def document_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Cut the token ids of every document (its text's, then ``end_id``) into pieces of at
    most ``capacity``: doc_id, piece, start, length, ids_crc32 (of the little-endian ids)
    and, if asked for, ids.  Only longer documents are cut; then the first piece takes the
    rest and the others are full.  ``pid`` and ``rank`` number the pieces of one length
    within a task; they are fixed by the written table this returns."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "pid", "rank"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pid = _encoder(shared.value), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for part in slices(batches):
            owner, out = [], []
            for i, ids in enumerate(encoder.encode(texts(part))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = 0 if not piece else end - capacity
                    data = ids[start:end].tobytes()
                    owner.append(i)
                    out.append((piece, start, end - start, zlib.crc32(data), pid, seen[end - start], data))
                    seen[end - start] += 1
            cols = list(zip(*out))
            arrays = [part.column(0).take(pa.array(owner)), pa.array(cols[0], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in cols[1:4]), pa.array(cols[4], pa.int32()),
                      pa.array(cols[5], pa.int64())]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(d, "<u4").astype(np.int32) for d in cols[6]],
                                       pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
              "ids_crc32 long, pid int, rank long" + ", ids array<int>" * with_ids)
    return materialize(rows.mapInArrow(run, schema), "pack-pieces")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and
    ids if asked for).  Null and empty texts are one piece holding ``end_id`` alone;
    repeated rows are packed each; an empty table gives an empty result; other columns
    are ignored."""
    pieces = document_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    counts = pieces.groupBy("length", "pid").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialize(counts.select("length", "pid", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                                       .alias("first")), "pack-firsts")
    by_length = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(by_length, capacity)        # size bounded by the capacity, not by the corpus
    plan = {int(k): plan[plan[:, 0] == k, 1:] for k in np.unique(plan[:, 0])}
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    ranked = (pieces.join(firsts.select("length", "pid", "first"), ["length", "pid"])
              .withColumn("rank", F.col("rank") + F.col("first")))
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("pid", "rank")], "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            length = part.column(part.schema.get_field_index("length")).to_numpy()
            rank = part.column(part.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                own, rows = length == k, shared.value[int(k)]
                row = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1]
                turn = rank[own] - row[:, 0]
                sequence[own] = row[:, 2] + turn // row[:, 1]
                offset[own] = row[:, 3] + turn % row[:, 1] * k
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sequence), pa.array(offset)],
                                             [*part.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1]]
                       + ["sequence_id long", "offset long"])
    return ranked.mapInArrow(place, schema)
