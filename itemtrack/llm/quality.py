"""Operator 9: quality rules and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets.  The counts of a
trusted target (labelled good documents) and of the whole raw corpus give two
multinomials; a text's score is the mean over its n-grams of
log(p_target / p_raw).  Every text at or above one threshold is kept, so the same
text gets the same verdict on every run.  The base rules are exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.llm.common import materialize, mix64, slices, text_bytes, word_hashes

N_BUCKETS = 1 << 16
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SCORE_BINS = 4096          # between -8 and 8, for the threshold

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True

BASE_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice in the text, each counted once."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for i in range(window):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.nonzero(counts[which] > 1)[0]
    if not len(starts):
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def base_counts(raw: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    octets = np.frombuffer(raw, np.uint8)
    chars = len(octets) - int(np.count_nonzero(_SPACE[octets] | _CONTINUES[octets]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(hashes), chars, int(np.count_nonzero(_SYMBOL[octets])), len(lines) - len(set(lines)),
            repeated_words(hashes))


def buckets(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets of the words and word pairs of one text."""
    pairs = mix64(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    return (np.concatenate([hashes, pairs]) % np.uint64(n_buckets)).astype(np.int64)


class QualityRatio:
    """Two multinomials of ``n_buckets`` cells and a threshold (all of fixed size).

    Of the labelled documents at most ``max_labelled`` (those of the smallest id hash)
    are used: three quarters are the target, the last quarter sets the threshold.  The
    raw multinomial counts every document.  The threshold is the score that best tells
    good from bad (Youden's index) among those that reject at most ``max_loss`` of the
    good ones; without both kinds of labels nothing is rejected by the ratio.
    """

    def __init__(self, n_buckets: int = N_BUCKETS, max_labelled: int = 20_000, smoothing: float = 1.0,
                 max_loss: float = 0.002):
        self.n_buckets, self.max_labelled = n_buckets, max_labelled
        self.smoothing, self.max_loss = smoothing, max_loss
        self.ratio = np.zeros(n_buckets)
        self.threshold = -np.inf

    def fit(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> "QualityRatio":
        """``labels``: doc_id, quality (1 good, 0 bad), toxic (1 is not trusted either)."""
        n_buckets, smoothing = self.n_buckets, self.smoothing
        marks = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
                 .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
                 .orderBy(F.xxhash64("doc_id"), "doc_id").limit(self.max_labelled)
                 .select(F.col("doc_id").alias("mark_id"),
                         F.when(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3,
                                F.when(F.col("q") == 1, "good").otherwise("bad"))
                         .when((F.col("q") == 1) & (F.col("t") == 0), "target").alias("mark")))
        marks = F.broadcast(materialize(marks.coalesce(1), "quality-marks"))  # at most max_labelled rows
        plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw, target = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
            for part in slices(batches):
                for data, mark in zip(text_bytes(part), part.column("mark").to_pylist()):
                    cells = np.bincount(buckets(word_hashes(data.split()), n_buckets), minlength=n_buckets) \
                        if len(data) > 50_000 else buckets(word_hashes(data.split()), n_buckets)
                    if len(data) > 50_000:
                        raw += cells
                        target += cells * (mark == "target")
                    else:
                        np.add.at(raw, cells, 1)
                        if mark == "target":
                            np.add.at(target, cells, 1)
            used = np.nonzero(raw)[0]
            yield pa.record_batch({"bucket": pa.array(used), "n_raw": pa.array(raw[used]),
                                   "n_target": pa.array(target[used])})

        cells = (plain.join(marks, plain["id"] == F.col("mark_id"), "left").select("text", "mark")
                 .mapInArrow(count, "bucket long, n_raw long, n_target long")
                 .groupBy("bucket").agg(F.sum("n_raw").alias("r"), F.sum("n_target").alias("t")).collect())
        raw, target = np.zeros(n_buckets), np.zeros(n_buckets)  # n_buckets rows at most
        for row in cells:
            raw[row["bucket"]], target[row["bucket"]] = row["r"], row["t"]
        if target.sum():
            self.ratio = (np.log((target + smoothing) / (target.sum() + smoothing * n_buckets))
                          - np.log((raw + smoothing) / (raw.sum() + smoothing * n_buckets)))
            self.threshold = self._threshold(plain.join(marks.filter("mark IN ('good', 'bad')"),
                                                        plain["id"] == F.col("mark_id")))
        return self

    def _threshold(self, marked: DataFrame) -> float:
        scored = self.measure(marked.select("mark", "text"), "mark").filter(f"n_words >= {MIN_WORDS}")
        place = F.least(F.greatest(F.floor((F.col("score") + 8) * (SCORE_BINS / 16)), F.lit(0)), F.lit(SCORE_BINS - 1))
        rows = scored.groupBy(place.alias("bin"), "mark").count().collect()  # 2 * SCORE_BINS rows at most
        n = {"good": np.zeros(SCORE_BINS), "bad": np.zeros(SCORE_BINS)}
        for row in rows:
            n[row["mark"]][row["bin"]] = row["count"]
        if not n["good"].sum() or not n["bad"].sum():
            return -np.inf
        lost = np.concatenate([[0], np.cumsum(n["good"])]) / n["good"].sum()     # if bins below the cut go
        caught = np.concatenate([[0], np.cumsum(n["bad"])]) / n["bad"].sum()
        index = np.where(lost <= self.max_loss, caught - lost, -np.inf)
        first, last = int(index.argmax()), len(index) - 1 - int(index[::-1].argmax())
        return (first + last) / 2 * 16 / SCORE_BINS - 8  # the middle of equally good cuts

    def _score(self, hashes: np.ndarray) -> float:
        if not len(hashes):
            return 0.0
        return float(self.ratio[buckets(hashes, self.n_buckets)].mean())

    def measure(self, docs: DataFrame, *keep: Column | str, text_col: str = "text") -> DataFrame:
        """The columns ``keep`` of every row, the base counts, base_failed, score and kept.
        A null or empty text has no words, fails the base rules and scores 0."""
        kept = docs.select(*keep)
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
                           + [BASE_FIELDS, "score double"])
        kept_names = kept.columns
        n = len(kept_names)
        threshold = float(self.threshold)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "__text"):
                rows = []
                for data in text_bytes(part, "__text"):
                    hashes = word_hashes(data.split())
                    rows.append((*base_counts(data, hashes), self._score(hashes)))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())],
                    [*kept_names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

        out = docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)
        failed = ((F.col("n_words") < MIN_WORDS)
                  | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        return out.withColumn("base_failed", failed).withColumn(
            "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))

    def keep_rows(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of ``docs``, unchanged, that ``measure`` keeps; all columns pass
        through whatever their names."""
        place = docs.columns.index(text_col)
        names = [f"c{i}" for i in range(len(docs.columns))]
        threshold = self.threshold

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, names[place]):
                ok = []
                for data in text_bytes(part, names[place]):
                    hashes = word_hashes(data.split())
                    failed = (len(hashes) < MIN_WORDS
                              or 100 * repeated_words(hashes) > MAX_REPEAT_PERCENT * len(hashes))
                    ok.append(not failed and self._score(hashes) >= threshold)
                yield part.filter(pa.array(ok, pa.bool_()))

        plain = docs.toDF(*names)
        return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
