"""Operator 13: spelling variants of corpus words by a bit-sliced position index.

The index of a set of words holds, per (position, letter), the bits of the words that have
the letter there.  A query word is compared with all of them at once: per position four sets
are carried - no error so far, and one error by a replaced, an additional or a missing
letter, the last two reading the slices one position on or back - and the word lengths pick
the answers at the end.

Words are compared in blocks.  Of two words one error apart the shorter has ``s`` letters; cut
in three parts, at least two of them are equal in both (read from the near end of the word),
so both words are in the block named by ``s`` and these two parts.  Blocks with more words than
``TILE`` are cut into tiles, each asked by all words of the block; small blocks share an index,
which can only find the same pairs again.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from itemtrack.llm.common import materialize
from itemtrack.operators.common import join_split

LETTERS = r"A-Za-zÀ-ÿ"    # fixed values: what words are made of
DAMAGED_EACH = 31                    # fixed value: a run whose checksum this divides loses a letter
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
TILE = 2048                          # words in one index, fewer if they are long
QUERIES = 512                        # words asked at once, fewer if they are long
USUAL = 64                           # letters up to which a word is not long


def damaged_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_length: int = LEAST_LENGTH) -> DataFrame:
    """word: one row per maximal run of letters that still has ``least_length`` letters.  A-Z
    become lower case; if the checksum of ``<id>:<run>`` is divisible by 31 the run loses the letter
    at the checksum modulo its length.  Null texts have no runs; a null id is the empty text."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        # Shorter runs cannot become words: a run only loses letters.
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")),
                                       F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    plain = F.octet_length("run") == F.length("run")
    runs = runs.select("id", F.when(plain, F.lower("run")).otherwise(
        F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % DAMAGED_EACH == 0, F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least_length)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of words that occur at least ``least_count`` times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# -- the index ----------------------------------------------------------------------------

def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words in rows (0 behind the end) and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    codes = np.zeros((len(words), int(sizes.max())), np.uint32)
    codes[np.arange(codes.shape[1]) < sizes[:, None]] = flat
    return codes, sizes


class BitSlices:
    """Bit-sliced index of up to a few thousand words; answers many queries of one length."""

    def __init__(self, words: list[str]):
        self.n = len(words)
        codes, self.sizes = _codes(words)
        self.alphabet, places = np.unique(codes, return_inverse=True)
        self.places = places.reshape(codes.shape)
        self.width = -(-self.n // 64)
        self._slices: dict[int, np.ndarray] = {}

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        """Boolean rows over the words as rows of 64-bit blocks."""
        out = np.zeros((len(bits), 8 * self.width), np.uint8)
        packed = np.packbits(bits, axis=1, bitorder="little")
        out[:, :packed.shape[1]] = packed
        return out.view(np.uint64)

    def slices(self, at: int) -> np.ndarray:
        """Per letter of the alphabet the words that have it at position ``at``, and a last row
        without words.  The slices of three neighbouring positions are held."""
        found = self._slices.get(at)
        if found is None:
            rows = len(self.alphabet) + 1
            if 0 <= at < self.places.shape[1]:
                bits = self.places[:, at] == np.arange(rows)[:, None]
                if self.alphabet[0] == 0:          # the mark behind the end is no letter
                    bits[0] = False
                found = self._pack(bits)
            else:
                found = np.zeros((rows, self.width), np.uint64)
            self._slices = {k: v for k, v in self._slices.items() if abs(k - at) <= 2}
            self._slices[at] = found
        return found

    def near(self, codes: np.ndarray) -> np.ndarray:
        """Pairs (query, word) one error apart; ``codes``: a row per query, all of one length."""
        n, m = codes.shape
        where = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        letter = np.where(self.alphabet[where] == codes, where, len(self.alphabet))
        same = np.full((n, self.width), ~np.uint64(0))
        swap, more, less = (np.zeros((n, self.width), np.uint64) for _ in range(3))
        for i in range(m):
            back, here, on = (self.slices(i + k)[letter[:, i]] for k in (-1, 0, 1))
            swap = swap & here | same & ~here      # the word has another letter here
            more = (more | same) & on              # the word has one letter more before this one
            less = less & back | same              # the word lacks this letter
            same &= here
        length = self._pack(self.sizes == np.array([[m], [m + 1], [m - 1]]))
        hits = swap & length[0] | (more | same) & length[1] | less & length[2]
        asked = np.flatnonzero(hits.any(axis=1))
        bits = np.unpackbits(hits[asked].view(np.uint8), axis=1, bitorder="little")[:, :self.n]
        rows, found = np.nonzero(bits)
        return np.stack([asked[rows], found], axis=1)


def near_pairs(index: list[str], queries: list[str]) -> Iterator[tuple[int, int]]:
    """Places (query, indexed word) of all pairs one error apart."""
    slices = BitSlices(index)
    order = np.argsort([len(q) for q in queries], kind="stable")
    sizes = np.array([len(queries[i]) for i in order])
    for size in np.unique(sizes):
        own = order[sizes == size]
        step = max(1, QUERIES * USUAL // max(int(size), USUAL))
        for lo in range(0, len(own), step):
            some = own[lo:lo + step]
            for q, w in slices.near(_codes([queries[i] for i in some])[0]):
                yield int(some[q]), int(w)


# -- Spark --------------------------------------------------------------------------------

def _blocks(words: DataFrame) -> DataFrame:
    """key, s, word, n: every word in the blocks of its own length and of one letter less."""
    size = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("s"))
    one, two = F.floor(F.col("s") / 3).cast("int"), F.floor(F.col("s") * 2 / 3).cast("int")
    back = F.length("word") - F.col("s")           # the last part is read from the end

    def part(first, last, from_end):
        shift = back if from_end else F.lit(0)
        return F.substring("word", first + shift + 1, last - first)

    head, middle, tail = (F.lit(0), one), (one, two), (two, F.col("s"))
    # The error lies in the last, the middle or the first part; the parts behind it end alike.
    keys = F.array(F.concat_ws("|", F.lit("a"), "s", part(*head, False), part(*middle, False)),
                   F.concat_ws("|", F.lit("b"), "s", part(*head, False), part(*tail, True)),
                   F.concat_ws("|", F.lit("c"), "s", part(*middle, True), part(*tail, True)))
    return sized.select(F.explode(keys).alias("key"), "s", "word", "n")


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n, other, other_n: all ordered pairs of different words one error apart (each once).
    ``words``: word, n, each word once."""
    # A word alone in its block meets nobody there.
    blocks = _blocks(words)
    sizes = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    letters = F.col("size") * F.greatest(F.col("s") / USUAL, F.lit(1.0))
    sized = join_split(blocks, sizes, "key", "inner").withColumn("tiles", F.ceil(letters / tile).cast("int"))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    # Blocks of one tile: one row is asked and answers.  Others: a row in the word's tile, one asked in each.
    asked = sized.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    asked = asked.select("key", "tile", "word", "n", (F.col("tile") == own).alias("held"))
    ordered = asked.repartition("key", "tile").sortWithinPartitions("key", "tile", F.col("held").desc(), "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, index_n, pending, pending_n = [], [], [], []
        group, closed, longest = None, False, 0

        def answer():
            pairs = list(near_pairs(index, pending)) if index and pending else []
            out = pa.RecordBatch.from_arrays(
                [pa.array([pending[q] for q, _ in pairs], pa.string()), pa.array([pending_n[q] for q, _ in pairs], pa.int64()),
                 pa.array([index[w] for _, w in pairs], pa.string()), pa.array([index_n[w] for _, w in pairs], pa.int64())],
                ["word", "n", "other", "other_n"])
            pending.clear()
            pending_n.clear()
            return out

        for batch in batches:
            for key, part, word, n, held in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (key, part) != group:
                    # A full index is asked and dropped when a group ends; small groups share one.
                    longest = max(longest, len(word) + 1)
                    if index and (closed or len(index) >= tile or len(index) * longest > USUAL * tile):
                        yield answer()
                        index.clear()
                        index_n.clear()
                        closed, longest = False, len(word) + 1
                    group = (key, part)
                if held:
                    index.append(word)
                    index_n.append(n)
                else:
                    closed = True                   # further words of this group are only asked
                pending.append(word)
                pending_n.append(n)
                if not held and len(pending) >= 4 * tile:
                    yield answer()
        if pending:
            yield answer()

    found = ordered.mapInArrow(run, "word string, n long, other string, other_n long")
    return found.dropDuplicates(["word", "other"])


def variants(words: DataFrame, ratio: int = FORM_RATIO, tile: int = TILE) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    The form is the near word of largest n (of equals the first in code-point order), if it is
    ``ratio`` times as frequent; the root is where following the forms ends.
    """
    words = materialize(words.select("word", "n"), "spelling-words")
    best = (near_words(words, tile).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top")))
    judged = join_split(words, best, "word").withColumn("form_n", -F.col("top.less"))
    takes = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    judged = materialize(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("top.other")).alias("form"), F.when(takes, F.col("form_n")).alias("form_n")),
        "spelling-forms")
    # Following forms doubles its reach each round; a chain grows by the ratio in every step, so
    # 19 steps leave the counts' range and five rounds reach the end of all chains.
    roots = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):
        ends = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(join_split(roots, ends, "root").select("word", F.coalesce("next", "root").alias("root")),
                            "spelling-roots")
    return join_split(judged, roots, "word").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                    "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Variants of the words of damaged runs of ``docs``: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; repeated rows count each; words may have any length; an
    empty table gives an empty result; other columns are ignored.
    """
    return variants(vocabulary(damaged_runs(docs, id_col, text_col)))
