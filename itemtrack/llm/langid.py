"""Operator 6: language ID by hyperdimensional profiles.

Every letter has a random vector of +1/-1 drawn from its code point.  A three-letter
gram is the product of its letters' vectors, rotated by their place (binding); a
text is the sum of its grams' vectors (bundling); a language is the sum over its
training texts.  A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.llm.common import slices, texts

DIM = 1024
GRAM_BLOCK = 4096          # grams turned into vectors at a time
DOC_BLOCK = 256            # texts bundled at a time
LONG_GRAMS = 100           # distinct grams from which a text's cosine does not hang on a few words
UNKNOWN = "und"


@lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(4096)
def _letter_vector(code: int, dim: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, dim, dtype=np.int8)
    return (2 * bits - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, dim: int) -> np.ndarray:
    """Bound vectors of grams given as rows of three code points (a blank is a letter)."""
    codes, places = np.unique(grams, return_inverse=True)
    places = places.reshape(grams.shape)
    letters = np.stack([_letter_vector(int(c), dim) for c in codes])
    return (np.roll(letters, 2, 1)[places[:, 0]] * np.roll(letters, 1, 1)[places[:, 1]]
            * letters[places[:, 2]])


def grams_of(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of some texts (rows of code points), and for every occurrence its
    text and its gram.  Letters are lower-cased; what is no letter is a blank; a gram
    has a letter in its middle, so none spans two words or two texts."""
    lowered = [s.lower() for s in strings]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le"), np.uint32)
    codes = np.where(_is_letter()[codes], codes, np.uint32(32))
    owner = np.repeat(np.arange(len(lowered)), [len(s) + 1 for s in lowered])  # of places 1..
    middle = np.nonzero(codes[1:-1] != 32)[0] + 1
    alphabet, small = np.unique(codes, return_inverse=True)
    size = np.int64(len(alphabet))
    keys = (small[middle - 1] * size + small[middle]) * size + small[middle + 1]
    if size ** 3 <= 1 << 22:
        present = np.nonzero(np.bincount(keys, minlength=1))[0]
        place = np.zeros(size ** 3, np.int64)
        place[present] = np.arange(len(present))
        which = place[keys]
    else:
        present, which = np.unique(keys, return_inverse=True)
    grams = np.stack([alphabet[present // (size * size)], alphabet[present // size % size],
                      alphabet[present % size]], 1)
    return grams, owner[middle - 1], which


def bundle(grams: np.ndarray, owner: np.ndarray, which: np.ndarray, n_texts: int, dim: int) -> np.ndarray:
    """Sums of the gram vectors of every text, in blocks of bounded size."""
    out = np.zeros((n_texts, dim), np.float32)
    for g0 in range(0, len(grams), GRAM_BLOCK):
        block = gram_vectors(grams[g0:g0 + GRAM_BLOCK], dim).astype(np.float32)
        inside = (which >= g0) & (which < g0 + GRAM_BLOCK) if len(grams) > GRAM_BLOCK else slice(None)
        own, gram = owner[inside], which[inside] - g0
        cuts = np.searchsorted(own, np.arange(0, n_texts + DOC_BLOCK, DOC_BLOCK))
        for i, d0 in enumerate(range(0, n_texts, DOC_BLOCK)):
            d1, part = min(d0 + DOC_BLOCK, n_texts), slice(cuts[i], cuts[i + 1])
            counts = np.bincount((own[part] - d0) * len(block) + gram[part], minlength=(d1 - d0) * len(block))
            out[d0:d1] += counts.reshape(d1 - d0, len(block)).astype(np.float32) @ block
    return out


class LanguageProfiles:
    """Prototypes by language: at most ``max_languages`` vectors of ``dim`` whole numbers,
    which bounds what the driver holds and the tasks receive."""

    def __init__(self, dim: int = DIM, max_languages: int = 2000):
        self.dim, self.max_languages = dim, max_languages
        self.languages: list[str] = []
        self.prototypes = np.zeros((0, dim))

    def fit(self, docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> "LanguageProfiles":
        """Learn from every row with a language and a text.  Sums are whole numbers, so
        the prototypes do not depend on how rows are dealt to tasks."""
        dim = self.dim

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for part in slices(batches):
                langs = np.array(part.column("lang").to_pylist(), object)
                grams, owner, which = grams_of(texts(part))
                names, index = np.unique(langs.astype(str), return_inverse=True)
                counts = np.bincount(index[owner] * len(grams) + which, minlength=len(names) * len(grams))
                counts = counts.reshape(len(names), len(grams))
                for name in names:
                    total.setdefault(str(name), np.zeros(dim, np.int64))
                for g0 in range(0, len(grams), GRAM_BLOCK):
                    block = gram_vectors(grams[g0:g0 + GRAM_BLOCK], dim).astype(np.float64)
                    add = counts[:, g0:g0 + GRAM_BLOCK].astype(np.float64) @ block  # exact below 2**53
                    for name, row in zip(names, add):
                        total[str(name)] += row.astype(np.int64)
            if total:
                yield pa.record_batch({"lang": pa.array(list(total), pa.string()),
                                       "vector": pa.array([v.tolist() for v in total.values()],
                                                          pa.list_(pa.int64()))})

        learn = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        parts = learn.filter("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(sums, "lang string, vector array<long>")
        rows = (parts.select("lang", F.posexplode("vector").alias("place", "value"))
                .groupBy("lang", "place").agg(F.sum("value").alias("value"))
                .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
                .select("lang", F.col("cells.value").alias("vector")).limit(self.max_languages + 1).collect())
        if len(rows) > self.max_languages:
            raise ValueError(f"more than {self.max_languages} languages; raise max_languages")
        rows = sorted(rows, key=lambda r: r["lang"])
        self.languages = [r["lang"] for r in rows]
        if rows:
            vectors = np.array([r["vector"] for r in rows], np.float64)
            # What all languages share says nothing about any: prototypes are their differences from the mean.
            unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
            centred = unit - unit.mean(0) if len(rows) > 1 else unit
            self.prototypes = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
        return self

    def classify(self, strings: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and cosine (cut to 0..1) of each text; ``und`` and 0 without letters."""
        if not strings:
            return [], np.zeros(0)
        grams, owner, which = grams_of(strings)
        lettered = np.bincount(owner, minlength=len(strings)) > 0
        if not self.languages or not len(grams):
            return [UNKNOWN] * len(strings), np.zeros(len(strings))
        vectors = bundle(grams, owner, which, len(strings), self.dim).astype(np.float64)
        norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
        cosines = vectors @ self.prototypes.T / norms[:, None]
        best = cosines.argmax(1)  # ties: the first name in alphabetical order
        score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
                np.where(lettered, score, 0.0))

    def predict(self, docs: DataFrame, *keep: Column | str, text_col: str = "text") -> DataFrame:
        """The columns ``keep`` of every row, with lang_pred and score.  Null and empty
        texts and texts without letters: ``und``, 0.  Whole texts are used."""
        kept = docs.select(*keep)
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
                           + ["lang_pred string", "score double"])
        kept_names = kept.columns
        n = len(kept_names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "__text"):
                langs, score = self.classify(texts(part, "__text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(langs, pa.string()), pa.array(score)],
                    [*kept_names, "lang_pred", "score"])

        return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)

    def keep_rows(self, docs: DataFrame, min_score: float, min_long: float = 0.0,
                  text_col: str = "text") -> DataFrame:
        """The rows of ``docs``, unchanged, whose text has a language with at least this
        cosine; the others go.  The least cosine grows with the text's distinct grams, up
        to ``min_long`` from ``LONG_GRAMS`` of them.  All columns pass through whatever their names."""
        place = docs.columns.index(text_col)
        names = [f"c{i}" for i in range(len(docs.columns))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, names[place]):
                strings = texts(part, names[place])
                langs, score = self.classify(strings)
                ok = np.array([x != UNKNOWN for x in langs]) & (score >= min_score)
                for i in np.nonzero(ok & (score < min_long))[0]:
                    ok[i] = score[i] >= min_long * min(len(grams_of([strings[i]])[0]) / LONG_GRAMS, 1.0)
                yield part.filter(pa.array(ok))

        plain = docs.toDF(*names)
        return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
