"""Operator 4: unigram token counts without building tokens.

An Aho-Corasick automaton enumerates all vocabulary pieces that end at each place of a
text; the Viterbi pass carries only the best score and the piece count of that path.
Ties follow the tokenizer's rule: of equally good paths to a place the one found first,
that is the one whose last piece starts earliest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from itemtrack.llm.common import Remembered, slices, texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0     # fixed value: an unknown character scores this much below the lowest piece
HELD = 8192                # places behind the current one whose best paths are held, more for longer pieces


@dataclass(frozen=True)
class UnigramVocabulary:
    """Pieces with their scores, the unknown piece's place and whether unknown characters
    fall back to one token per UTF-8 byte."""

    pieces: tuple[tuple[str, float], ...]
    unknown: int
    byte_fallback: bool

    @staticmethod
    def from_model(path: str) -> "UnigramVocabulary":
        """Pieces and scores of a public model file, control pieces left out."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not model.is_control(i)]
        pieces = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in ids)
        return UnigramVocabulary(pieces, ids.index(model.unk_id()), all(
            f"<0x{b:02X}>" in dict(pieces) for b in range(256)))


class Counter:
    """Counts for one vocabulary; remembers the parts between spaces it has seen."""

    def __init__(self, vocabulary: UnigramVocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        # Parts between spaces are independent if no piece holds a space mark after another
        # character and scores are whole numbers, whose sums have no rounding.
        self.splits = (all(SPACE not in p.lstrip(SPACE) for p, _ in vocabulary.pieces)
                       and all(s == int(s) for _, s in vocabulary.pieces))
        self.known = Remembered()
        self.reach = max((len(p) for p, _ in vocabulary.pieces), default=1)

    def viterbi(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through ``text``.  Only the places that the longest
        piece can reach back to are held, so memory does not grow with the text."""
        score, count, unknown_end = [0.0], [0], False
        unknown, fallback, held = self.unknown, self.vocabulary.byte_fallback, HELD + 2 * self.reach
        place, best, pieces, longest, single = 0, None, 0, 0, False
        # Matches come by their end; the last entry closes the last place.
        for end, (length, value) in chain(self.automaton.iter(text), ((len(text), (1, 0.0)),)):
            while place < end:                     # all pieces that end at this place are known
                if not single and (best is None or score[-1] + unknown > best):
                    best = score[-1] + unknown
                    if fallback:
                        pieces = count[-1] + len(text[place].encode())
                    else:                          # neighbouring unknown characters are one token
                        pieces = count[-1] + (not unknown_end)
                    unknown_end = True
                else:
                    unknown_end = False
                score.append(best)
                count.append(pieces)
                place, best, longest, single = place + 1, None, 0, False
                if len(score) > held:
                    del score[:-self.reach], count[:-self.reach]
            total = score[-length] + value         # the last entry is the place before this character
            if best is None or total > best or (total == best and length > longest):
                best, pieces, longest = total, count[-length] + 1, length
            if length == 1:
                single = True
        return count[-1], score[-1]

    def count(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text; the empty text has none."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        text = text if text.startswith(SPACE) else SPACE + text
        if not self.splits or not self.vocabulary.byte_fallback:
            return self.viterbi(text)
        parts = (re.findall(f"{SPACE}+[^{SPACE}]*", text) if SPACE * 2 in text or text.endswith(SPACE)
                 else text[1:].split(SPACE))
        plain = not (SPACE * 2 in text or text.endswith(SPACE))
        tokens, total, known = 0, 0.0, self.known.held
        for part in parts:
            got = known.get(part) if plain else None
            if got is None:
                got = self.viterbi(SPACE + part if plain else part)
                if plain:
                    self.known.put(part, got, 100)
            tokens += got[0]
            total += got[1]
        return tokens, total


_COUNTERS: dict[UnigramVocabulary, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: UnigramVocabulary, *keep: Column | str,
                 text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, n_tokens and score (of the best path).  Spaces
    become space marks and one leads the text.  Null and empty texts: 0 tokens, score 0.
    Repeated rows count alike; other columns are ignored.  The vocabulary (as large as
    its file) is broadcast."""
    shared = SparkSession.active().sparkContext.broadcast(vocabulary)
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                       + ["n_tokens long", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(shared.value)
        if counter is None:
            counter = _COUNTERS.setdefault(shared.value, Counter(shared.value))
        for part in slices(batches, "__text", own=counter.known):
            found = [counter.count(t) for t in texts(part, "__text")]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(np.array([f[0] for f in found], np.int64)),
                 pa.array(np.array([f[1] for f in found], np.float64))],
                [*part.schema.names[:-1], "n_tokens", "score"])

    return rows.mapInArrow(run, schema)
