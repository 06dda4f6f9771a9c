"""Operator 2: exact BM25 top-k over sharded inverted indexes with block-max WAND.

Documents are indexed in shards of bounded text; every shard row holds sorted terms,
their postings and document lengths.  Document frequencies, the number of documents and
their mean length are global, so a document's score does not depend on its shard.

Inside a shard the documents are numbered by clusters of their widespread terms and their
length, so that neighbours are alike, and cut into blocks; every term keeps, per block in
which it occurs, its largest contribution and its postings there.  A query adds up the
maxima of all its terms by block.  A block is a pivot if that sum reaches the k-th best
score so far; the pivots of the highest sums are visited first, their postings scored,
and the k-th best score raised; the postings of all other blocks are skipped.  The shards'
lists are merged by score and id.

Queries go past the shards in blocks of bounded size: a block is broadcast, and every
task searches the shards it reads from the index table, which is not shuffled.  Some
shards are searched first; their k-th best scores bound what the others return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.llm.common import materialize, shuffles_removed, slices, text_bytes, word_hashes
from itemtrack.operators.common import join_split
from itemtrack.session import remove_path, scratch_path

K1, B = 1.2, 0.75
SHARD_BYTES = 64 << 20     # text in one shard, unless a task's input ends before
QUERY_BYTES = 64 << 20     # terms and weights of the queries that are broadcast at once
BLOCKS = 8                 # of neighbouring documents under one maximum: at least so many in a shard,
LEAST, MOST = 16, 512      # of so many documents
DENSE = 12                 # a term in one of so many documents of a block is kept there as a row of its documents
CELLS = 8 << 20            # of queries searched at once: their number times the shard's documents or the terms with rows
TERMS = 1 << 20            # of queries searched at once, unless one query has more
POSTINGS = 1 << 16         # of short runs that are added up at once
FIRST = 16                 # one in so many shards is searched before the others
FEATURES, CLUSTERS, ROUNDS = 256, 16, 4  # terms by which texts are clustered, clusters, rounds of that
SLACK, ROUNDED = 1e-4, 2e-7  # relative: what sums may be off, and what they may be off more for each of a query's terms
TINY = 1e-30               # less than the score of any document that holds a term

# Words end at ASCII blanks and punctuation; A-Z count as a-z.
_TO_BLANK = bytes(32 if chr(c) in "\t\n\x0b\x0c\r !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256))

INDEX = ("n int, doc_ids array<{id}>, lengths array<int>, terms array<long>, df array<int>, "
         "docs binary, tfs binary")


def terms_of(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct term hashes, their counts and the number of words of one text."""
    hashes = word_hashes(data.lower().translate(_TO_BLANK).split())
    terms, counts = np.unique(hashes.astype(np.int64), return_counts=True)
    return terms, counts, len(hashes)


def _alike(which: np.ndarray, df: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text (of ``sizes`` terms, ``which`` of ``df``) the place of its cluster: texts that share many of the
    ``FEATURES`` most widespread terms, as those of one language do, get the same place or a near one."""
    n = len(sizes)
    wide = np.argsort(-df, kind="stable")[:FEATURES]
    column = np.full(len(df), -1, np.int32)
    column[wide] = np.arange(len(wide))
    held = np.nonzero((column >= 0)[which])[0]
    rows = np.zeros((n, len(wide)), np.float32)
    rows[np.searchsorted(np.cumsum(sizes), held, "right"), column[which[held]]] = 1
    rows /= np.maximum(np.sqrt(rows.sum(1, keepdims=True)), 1)
    centres = rows[np.unique(np.linspace(0, max(n - 1, 0), min(n, CLUSTERS)).astype(int))]
    own = np.zeros(n, np.int64)
    for _ in range(ROUNDS if len(wide) else 0):
        own = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[own == c].sum(0) for c in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-9)
    near, left = [], list(range(len(centres)))       # each centre by the one most like it
    while left:
        near.append(max(left, key=lambda c: float(centres[near[-1]] @ centres[c])) if near else left[0])
        left.remove(near[-1])
    return np.argsort(near)[own] if near else own


def _numbers(which: np.ndarray, df: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers for a shard's documents: by their cluster, then by length.  Texts of a language and a length
    come together, which keeps a block's maxima near its documents' scores."""
    number = np.empty(len(sizes), np.int32)
    number[np.lexsort((lengths, _alike(which, df, sizes)))] = np.arange(len(sizes))
    return number


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard, written to the shared folder.  Every row of ``docs`` is indexed;
    null and empty texts count as documents of length 0."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The bits of the partition's number, turned round: shards of low numbers come from all over the input.
        first, n, size = int(f"{TaskContext.get().partitionId():030b}"[::-1], 2) << 32, 0, 0
        ids, lengths, terms, counts = [], [], [], []

        def out() -> pa.RecordBatch:
            flat = np.concatenate(terms)
            sizes = np.array([len(t) for t in terms])
            names, which, df = np.unique(flat, return_inverse=True, return_counts=True)
            number = _numbers(which, df, sizes, np.array(lengths))
            owner = np.repeat(number, sizes)
            order = np.lexsort((owner, which))  # by term, then by document
            turn = np.argsort(number)
            cols = [("shard", [first + n], pa.int64()), ("n", [len(ids)], pa.int32()),
                    ("doc_ids", [[ids[i] for i in turn]], pa.list_(id_type)),
                    ("lengths", [np.array(lengths, np.int32)[turn]], pa.list_(pa.int32())),
                    ("terms", [names], pa.list_(pa.int64())), ("df", [df.astype(np.int32)], pa.list_(pa.int32())),
                    ("docs", [owner[order].tobytes()], pa.binary()),
                    ("tfs", [np.concatenate(counts).astype(np.int32)[order].tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for _, v, t in cols], [c for c, _, _ in cols])

        for part in slices(batches):
            id_type = part.schema.field("doc_id").type
            for i, data in zip(part.column(0).to_pylist(), text_bytes(part)):
                t, c, length = terms_of(data)
                ids.append(i)
                lengths.append(length)
                terms.append(t)
                counts.append(c)
                size += len(data) + 16               # many empty texts fill a shard, too
                if size >= shard_bytes:
                    yield out()
                    ids, lengths, terms, counts, size, n = [], [], [], [], 0, n + 1
        if ids:
            yield out()

    return materialize(plain.mapInArrow(run, "shard long, " + INDEX.format(id=kind)), "search-index")


class Shard:
    """One shard's postings with their contributions, by block, and every term's maxima by block.

    A term's postings in one block are a run.  A run that holds one in ``DENSE`` of the block's documents
    or more (two at least) is kept as a row of them, a shorter one as it is.  So one matrix product adds up,
    for a block and all queries that visit it, what many queries and documents have in common, and only
    the rest is added one by one.  All are in single precision and decide what is visited; a document's
    score comes from its own terms, in double precision and in the order of terms, so it is the same in
    every shard.
    """

    def __init__(self, row: dict, mean_length: float, k1: float, b: float):
        self.ids = row["doc_ids"]
        self.n = len(self.ids)
        self.terms = np.asarray(row["terms"], np.int64)
        df = np.asarray(row["df"], np.int64)
        docs = np.frombuffer(row["docs"], np.int32)
        norm = k1 * (1 - b + b * np.asarray(row["lengths"], np.float64) / max(mean_length, 1e-9))
        tf = np.frombuffer(row["tfs"], np.int32).astype(np.float64)
        gain = tf * (k1 + 1)
        tf += norm[docs]
        gain /= tf
        del tf
        term = np.repeat(np.arange(len(df), dtype=np.int32), df)
        self.offset = np.append(0, np.cumsum(df))
        # By document: its terms and their contributions.
        order = _grouped(docs, self.n)
        self.doc_terms = term[order]
        self.doc_gains = gain[order]
        self.doc_offset = np.append(0, np.cumsum(np.bincount(docs, minlength=self.n)))
        # By block: its runs, their terms and maxima.
        self.block = LEAST
        while self.block < MOST and self.n >= 2 * BLOCKS * self.block:
            self.block *= 2
        self.n_blocks = -(-self.n // self.block)
        blocks = np.arange(self.n_blocks + 1)
        block = docs // self.block
        order = _grouped(block, self.n_blocks)
        block, term, gain = block[order], term[order], gain[order].astype(np.float32)
        place = (docs[order] % self.block).astype(np.int16)
        del order
        new = np.ones(len(block), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.nonzero(new)[0]
        block, self.run_term, size = block[first], term[first], np.diff(np.append(first, len(term)))
        del term, new
        self.run_offset = np.searchsorted(block, blocks)
        self.run_max = np.maximum.reduceat(gain, first) if len(first) else gain
        dense = size * DENSE >= max(self.block, 2 * DENSE)
        posts, which = ranges(first[dense], first[dense] + size[dense])
        self.rows = np.zeros((int(dense.sum()), self.block), np.float32)
        self.rows[which, place[posts]] = gain[posts]
        self.row_term = self.run_term[dense]
        self.row_offset = np.searchsorted(block[dense], blocks)
        del posts, which
        # The other runs by block and size: their terms and postings.
        order = np.nonzero(~dense)[0]
        order = order[np.lexsort((size[order], block[order]))]
        first, size, block = first[order], size[order], block[order]
        self.single_term = self.run_term[order]
        self.single_size = size.astype(np.int16)
        self.single_start = np.append(0, np.cumsum(size))
        self.single_offset = np.searchsorted(block, blocks)
        self.n_sizes = int(size.max(initial=0)) + 1
        self.size_offset = np.searchsorted(block * self.n_sizes + size, np.arange(self.n_blocks * self.n_sizes + 1))
        posts, _ = ranges(first, first + size)
        self.place = place[posts]
        self.gain = gain[posts]
        self.in_rows = np.zeros(len(self.terms), bool)
        self.in_rows[self.row_term] = True
        self.asked = np.zeros(len(self.terms))       # weights of one query's terms, while it is scored
        self.examined = 0                            # documents of visited blocks

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int,
               least: float = 0.0) -> list[tuple[object, float]]:
        """:meth:`search_many` for one query."""
        return self.search_many(np.array([0, len(terms)]), terms, weights, k, [least])[0]

    def places(self, names: np.ndarray) -> np.ndarray:
        """Where terms are in the shard's; -1: not there."""
        if not len(self.terms):
            return np.full(len(names), -1, np.int32)
        place = np.minimum(np.searchsorted(self.terms, names), len(self.terms) - 1).astype(np.int32)
        return np.where(self.terms[place] == names, place, np.int32(-1))

    def groups(self, offset: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of queries (``offset``: of their ``terms``) that are searched at once in bounded memory."""
        most = min(max(self.n, int(self.in_rows.sum())), max(len(terms), self.n))
        offset, start = offset.tolist(), 0
        while start < len(offset) - 1:
            end = start + 1
            while (end < len(offset) - 1 and (end + 1 - start) * min(most, max(offset[end + 1] - offset[start], self.n))
                    <= CELLS and offset[end + 1] - offset[start] <= TERMS):
                end += 1
            yield start, end
            start = end

    def search_many(self, offset: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int,
                    least: list[float]) -> list[list[tuple[object, float]]]:
        """For each query (its sorted terms are ``terms[offset[q]:offset[q + 1]]``) the best ``k``
        documents that hold one of them, by score and then by id, of those that score
        ``least[q]`` or more."""
        names, which = np.unique(terms, return_inverse=True)
        return self.search_places(offset, self.places(names)[which], weights, k, least)

    def search_places(self, offset: np.ndarray, place: np.ndarray, weights: np.ndarray, k: int,
                      least: list[float]) -> list[list[tuple[object, float]]]:
        """:meth:`search_many` with the terms' places (:meth:`places`) instead of the terms."""
        g = len(offset) - 1
        here = np.nonzero(place >= 0)[0]
        query = np.repeat(np.arange(g, dtype=np.int32), np.diff(offset))[here]
        place, weights = place[here], weights[here]
        heavy, start = weights.astype(np.float32), np.searchsorted(query, np.arange(g + 1))
        # The weights of the terms that have rows.
        held = np.nonzero(self.in_rows[place])[0]
        column = np.full(len(self.terms), -1, np.int32)
        column[place[held]] = 0
        asked = np.nonzero(column == 0)[0]
        column[asked] = np.arange(len(asked))
        matrix = np.zeros((len(asked), g), np.float32)
        matrix[column[place[held]], query[held]] = heavy[held]
        # Every term's maxima, added up by query and block.
        bound = np.zeros((g, self.n_blocks))
        full = np.nonzero(np.diff(start))[0]
        maxima = np.zeros(len(self.terms), np.float32)
        for b in range(self.n_blocks):
            runs = slice(self.run_offset[b], self.run_offset[b + 1])
            maxima[self.run_term[runs]] = self.run_max[runs]
            if len(place):
                bound[full, b] = np.add.reduceat(maxima[place] * heavy, start[full])
            maxima[self.run_term[runs]] = 0
        slack = SLACK + ROUNDED * np.diff(start)
        bound *= (1 + slack)[:, None]
        enough = np.array(least, float) * (1 - slack)
        hits = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]  # query, document, score about
        # First the blocks of the highest sums of each query, then all others that can reach its k-th best score.
        n = max(2, -(-2 * k // self.block))
        best = np.zeros(bound.shape, bool)
        if self.n_blocks:
            np.put_along_axis(best, np.argsort(-bound, axis=1, kind="stable")[:, :n], True, 1)
        where = np.zeros(len(self.terms), np.int32)  # a term's run in the block, from 1 (0: it has none)
        for now in (best, ~best):
            wait = now is best                        # the scores of a query's first blocks count together
            raised = enough.copy()
            for b in np.nonzero(now.any(0))[0].tolist():
                of = np.nonzero(now[:, b] & (bound[:, b] > 0) & (bound[:, b] >= enough))[0]
                if not len(of):
                    continue
                score = self._block_scores(b, of, start, query, place, heavy, column, matrix, where)
                self.examined += len(of) * self.block
                stays = score >= np.maximum(raised[of], TINY).astype(np.float32)[:, None]
                if self.block >= k and np.count_nonzero(stays) > 2 * k * len(of):
                    kth = np.partition(score, self.block - k, axis=1)[:, self.block - k]  # the k-th best of this block
                    raised[of] = np.maximum(raised[of], kth * (1 - 2 * slack[of]))
                    stays = score >= np.maximum(raised[of], TINY).astype(np.float32)[:, None]
                cells = np.flatnonzero(stays)
                found = (of[cells // self.block], b * self.block + cells % self.block, score.reshape(-1)[cells])
                hits = [np.concatenate(h) for h in zip(hits, found)] if len(cells) else hits
                if len(hits[0]) > 4 * k * g:
                    hits, raised = self._raised(hits, k, raised, slack)
                if not wait:
                    enough = raised
            hits, enough = self._raised(hits, k, raised, slack)
        ends = np.cumsum(np.bincount(hits[0], minlength=g))
        return [self._top(hits[1][s:e], place[i:j], weights[i:j], k, x) if e > s else []
                for s, e, i, j, x in zip(np.append(0, ends).tolist(), ends.tolist(), start, start[1:], least)]

    def _block_scores(self, b: int, of: np.ndarray, start: np.ndarray, query: np.ndarray, place: np.ndarray,
                      heavy: np.ndarray, column: np.ndarray, matrix: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Scores, about, of one block's documents for the queries ``of``."""
        g = matrix.shape[1]
        rows = slice(self.row_offset[b], self.row_offset[b + 1])
        cols = column[self.row_term[rows]]
        held = cols >= 0
        heavies = matrix[cols[held]]
        if 2 * len(of) < g:
            score = heavies[:, of].T @ self.rows[rows][held]
        else:                                         # one product for all costs less than picking weights
            score = heavies.T @ self.rows[rows][held]
            score = score if len(of) == g else score[of]
        # The runs that have no rows, by size: those of one size are rows of a matrix.
        runs = slice(self.single_offset[b], self.single_offset[b + 1])
        where[self.single_term[runs]] = np.arange(1, runs.stop - runs.start + 1, dtype=np.int32)
        if len(of) < g:
            own, slot = ranges(start[of], start[of + 1])
            run = where[place[own]]
            inside = np.nonzero(run != 0)[0]
            run, slot, heavy = run[inside], slot[inside], heavy[own[inside]]
        else:
            run = where[place]
            inside = np.nonzero(run != 0)[0]
            run, slot, heavy = run[inside], query[inside], heavy[inside]
        where[self.single_term[runs]] = 0
        size = self.single_size[runs][run - 1]
        order = _grouped(size, self.block)
        run, base, heavy = run[order] + (runs.start - 1), slot[order].astype(np.int64) * self.block, heavy[order]
        ends = np.cumsum(np.bincount(size, minlength=1)).tolist()
        flat, offset = score.reshape(-1), self.size_offset[b * self.n_sizes:]
        for size in range(1, len(ends)):
            posts = slice(self.single_start[offset[size]], self.single_start[offset[size + 1]])
            places, gains = self.place[posts].reshape(-1, size), self.gain[posts].reshape(-1, size)
            for i in range(ends[size - 1], ends[size], max(1, POSTINGS // size)):
                own = slice(i, min(ends[size], i + max(1, POSTINGS // size)))
                at = run[own] - offset[size]
                cells, adds = places.take(at, 0) + base[own, None], gains.take(at, 0)
                adds *= heavy[own, None]
                np.add.at(flat, cells.ravel(), adds.ravel())
        return score

    def _raised(self, hits: list[np.ndarray], k: int, enough: np.ndarray,
                slack: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The hits that can still be among the best ``k`` of their query, and what they must score."""
        hits, kth = self._best(hits, k, len(enough))
        enough = np.maximum(enough, kth * (1 - 2 * slack))
        stays = hits[2] >= enough[hits[0]].astype(np.float32)
        return [h[stays] for h in hits], enough

    @staticmethod
    def _best(hits: list[np.ndarray], k: int, g: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The hits by query and falling score, and every query's k-th best score (0: fewer hits)."""
        order = np.lexsort((-hits[2], hits[0]))
        hits = [h[order] for h in hits]
        count = np.bincount(hits[0], minlength=g)
        start = np.cumsum(count) - count
        kth = np.zeros(g)
        full = np.nonzero(count >= k)[0]
        kth[full] = hits[2][start[full] + k - 1]
        return hits, kth

    def _top(self, docs: np.ndarray, place: np.ndarray, weights: np.ndarray, k: int,
             least: float) -> list[tuple[object, float]]:
        exact = self._scores(docs, place, weights)
        if len(exact) > k:
            least = max(least, np.partition(exact, len(exact) - k)[len(exact) - k])
        stays = exact >= least
        return sorted(((self.ids[d], float(x)) for d, x in zip(docs[stays], exact[stays])),
                      key=lambda r: (-r[1], r[0] is None, r[0]))[:k]

    def _scores(self, docs: np.ndarray, place: np.ndarray, weights: np.ndarray) -> np.ndarray:
        posts, which = ranges(self.doc_offset[docs], self.doc_offset[docs + 1])
        self.asked[place] = weights
        scores = np.bincount(which, self.doc_gains[posts] * self.asked[self.doc_terms[posts]], len(docs))
        self.asked[place] = 0
        return scores


def _grouped(keys: np.ndarray, n: int) -> np.ndarray:
    """The order by ``keys`` below ``n``; equal ones keep theirs.  Narrow whole numbers are sorted by their digits."""
    return np.argsort(keys.astype(np.uint16) if n <= 1 << 16 else keys, kind="stable")


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of some ranges, and for each the range it is from."""
    sizes = ends - starts
    which = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
    return np.arange(sizes.sum(), dtype=np.int32) + (starts - (np.cumsum(sizes) - sizes)).astype(np.int32)[which], which


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
          k1: float = K1, b: float = B, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank (from 1), doc_id and score: the exact BM25 top ``k`` of every query.

    Score: sum over the query's words of ln(1 + (N - df + 0.5) / (df + 0.5)) *
    tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length)).  Ties go to the smaller
    id.  Only documents holding a word of the query are listed; a null, empty or unknown
    query has no rows.  Rows with the same query id are one query of all their words.
    The queries are searched when called, ``query_bytes`` of terms and weights at a time.
    """
    plain = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("text"))
    kind = plain.schema["query_id"].dataType.simpleString()
    doc_kind = index.schema["doc_ids"].dataType.elementType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [terms_of(data) for data in text_bytes(part)]
            owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner)), pa.array(np.concatenate([f[0] for f in found])),
                 pa.array(np.concatenate([f[1] for f in found]).astype(np.int64))], ["query_id", "h", "tf"])

    whole = index.agg(F.sum("n").alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"),
                                                               lambda a, x: a + x)).alias("words")).first()
    n_docs, mean = int(whole["n"] or 0), float(whole["words"] or 0) / max(int(whole["n"] or 0), 1)
    df = (index.select(F.inline(F.arrays_zip("terms", "df"))).groupBy(F.col("terms").alias("h"))
          .agg(F.sum("df").alias("df")))
    words = plain.mapInArrow(split, f"query_id {kind}, h long, tf long").groupBy("query_id", "h").agg(
        F.sum("tf").alias("tf"))
    idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = materialize(join_split(words, df, "h", "inner").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("h", (F.col("tf") * idf).alias("w")))).alias("q"))
        .select("query_id", F.col("q.h").alias("h"), F.col("q.w").alias("w")), "search-queries")
    # The stated query set goes past all shards in blocks of about QUERY_BYTES.
    spark = index.sparkSession
    n_terms = asked.agg(F.sum(F.size("h").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-n_terms * 16 // query_bytes))
    by_block = scratch_path(spark, "search-blocks")
    (asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))).repartition("block")
     .write.partitionBy("block").parquet(by_block))
    blocks = spark.read.schema(f"query_id {kind}, h array<long>, w array<double>, block long").parquet(by_block)
    schema = f"query_id {kind}, doc_id {doc_kind}, score double"
    top = f"query_id {kind}, rank int, doc_id {doc_kind}, score double"
    path = scratch_path(spark, "search-top")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    id_type = index.limit(0).toArrow().schema.field("doc_ids").type.value_type
    cut = _first_shards(index)
    with shuffles_removed(spark):
        for block in range(n_blocks):
            names, sent = _broadcast(blocks.filter(F.col("block") == block).drop("block"), id_type)
            rest, least, early, found = index, np.zeros(len(names)), None, None
            if cut is not None:
                # Some shards are searched first; what the k-th best scores there, the best of all reach as well.
                rest, early = index.filter(F.col("shard") >= cut), scratch_path(spark, "search-early")
                (_searched(index.filter(F.col("shard") < cut), sent, least, k, mean, k1, b, schema)
                 .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).write.parquet(early))
                found = spark.read.schema(schema + ", rank int").parquet(early)
                kth = found.filter(F.col("rank") == k).select("query_id", "score").toArrow()
                kth = dict(zip(kth.column("query_id").to_pylist(), kth.column("score").to_pylist()))
                least = np.array([kth.get(name, 0.0) for name in names])
            later = _searched(rest, sent, least, k, mean, k1, b, schema)
            found = found.drop("rank").unionByName(later) if early else later
            (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
             .select("query_id", "rank", "doc_id", "score").write.mode("append").parquet(path))
            if early:
                remove_path(spark, early)
            sent.destroy()
    remove_path(spark, by_block)
    return spark.read.schema(top).parquet(path)


def _first_shards(index: DataFrame) -> int | None:
    """The number below which shards are searched first: one in ``FIRST``, but enough for all cores.
    None if there are too few shards for two rounds."""
    shards = sorted(r[0] for r in index.select("shard").collect())
    slots = index.sparkSession.sparkContext.defaultParallelism
    if len(shards) < 4 * slots:
        return None
    return shards[slots * max(1, len(shards) // (FIRST * slots))]


def _broadcast(queries: DataFrame, id_type: pa.DataType) -> tuple[list, Broadcast]:
    """The ids of ``queries`` and what is broadcast of them: ids, the distinct terms, and by query which of
    them with what weights.  Queries that share many widespread terms come together, so that a group's
    matrix products have few zeros."""
    table = queries.toArrow().combine_chunks()
    h, w = (table.column(c).combine_chunks() for c in ("h", "w"))
    offset = np.append(0, np.cumsum(pc.list_value_length(h).to_numpy(zero_copy_only=False).astype(np.int64)))
    terms, which = np.unique(h.flatten().to_numpy(), return_inverse=True)
    which, weights, sizes = which.astype(np.int32), w.flatten().to_numpy(), np.diff(offset)
    order = np.argsort(_alike(which, np.bincount(which, minlength=len(terms)), sizes), kind="stable")
    picked, _ = ranges(offset[order], offset[order + 1])
    names = table.column("query_id").take(pa.array(order)).to_pylist()
    lists = (np.append(0, np.cumsum(sizes[order])), which[picked], weights[picked])
    kinds = [table.schema.field("query_id").type, id_type]
    return names, queries.sparkSession.sparkContext.broadcast((names, terms, lists, kinds))


def _searched(index: DataFrame, sent: Broadcast, least: np.ndarray, k: int, mean: float, k1: float, b: float,
              schema: str) -> DataFrame:
    """For each of the broadcast queries the best ``k`` documents of each shard that score ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, (offset, which, weights), kinds = sent.value
        pa.default_memory_pool().release_unused()    # what building the index left in this worker
        known = least.tolist()                       # and what the task's earlier shards give for sure
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy() for c in ("lengths", "terms", "df")}
                row |= {c: batch.column(c)[i].as_buffer() for c in ("docs", "tfs")}
                shard = Shard({"doc_ids": batch.column("doc_ids")[i].as_py(), **row}, mean, k1, b)
                place = shard.places(terms)[which]
                out: tuple[list, list, list] = ([], [], [])
                for start, end in shard.groups(offset, place):
                    own = slice(offset[start], offset[end])
                    for q, found in enumerate(shard.search_places(offset[start:end + 1] - offset[start], place[own],
                                                                  weights[own], k, known[start:end]), start):
                        if len(found) == k:
                            known[q] = found[-1][1]
                        for d, x in found:
                            out[0].append(names[q])
                            out[1].append(d)
                            out[2].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, [*kinds, pa.float64()])],
                                                 ["query_id", "doc_id", "score"])

    return index.select("doc_ids", "lengths", "terms", "df", "docs", "tfs").mapInArrow(run, schema)
