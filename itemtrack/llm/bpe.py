"""Operator 1: byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its encoding:
a token whose bytes end the prefix and that may follow the last token of the shorter
prefix before it (two tokens may be neighbours if their joined bytes encode to just
these two).  Storing that last token per prefix gives the encoding by walking back,
lets a piece grow by exact appends, and keeps the table before an edit valid.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from itemtrack.llm.common import Remembered, slices, texts

WORD_BYTES = 256
PAIR_ENTRIES = 300_000     # neighbour tests that a worker remembers, about 100 bytes each


def load_tokens(path: str) -> list[bytes]:
    """The token bytes by rank of a rank file (base64 token and rank in each line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class PrefixBpe:
    """Encoder and decoder for one rank list and split pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.longest = max(map(len, tokens))
        # Enumerates the tokens that end at each byte, the longest first; a byte is a character.
        self._ends = ahocorasick.Automaton()
        for token, i in self.rank.items():
            if self._merge(token) == [i]:            # a token that its own bytes do not give is never used
                self._ends.add_word(token.decode("latin-1"), (i, len(token)))
        self._ends.make_automaton()
        self.pieces = regex.compile(pattern).findall
        self._pairs: dict[int, bool] = {}
        self.chunks = Remembered()               # parts between spaces
        self._sizes = [len(t) for t in tokens]
        self.lengths = np.array(self._sizes, np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self._blob = np.frombuffer(b"".join(tokens), np.uint8)

    # -- which tokens may be neighbours -------------------------------------------------

    def _merge(self, data: bytes) -> list[int]:
        """Lowest-rank merges, used on at most two tokens' bytes."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.rank.get
        while len(parts) > 1:
            best = min((r, i) for i in range(len(parts) - 1)
                       if (r := rank(parts[i] + parts[i + 1], 1 << 60)) is not None)
            if best[0] == 1 << 60:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.rank[p] for p in parts]

    def _follows(self, left: int, right: int) -> bool:
        key = left << 24 | right
        ok = self._pairs.get(key)
        if ok is None:
            if len(self._pairs) >= PAIR_ENTRIES:
                self._pairs.clear()
            ok = self._pairs[key] = self._merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return ok

    # -- the prefix table ---------------------------------------------------------------

    def last_tokens(self, data: bytes, table: array | list | None = None) -> array | list:
        """``table[i]`` is the last token of the encoding of ``data[:i + 1]``.  A table of
        a shorter prefix is continued, so appending costs only the new bytes.  (Words take a
        list, which is quicker, longer pieces an array, which is smaller.)"""
        table = list(table or ()) if len(data) < WORD_BYTES else array("i", table or ())
        done, pairs, add = len(table), self._pairs, table.append
        for end, (token, size) in self._ends.iter(data.decode("latin-1"), max(0, done + 1 - self.longest)):
            if end != done:                          # this prefix has its token, exactly one fits
                if end > done:
                    break
                continue
            start = end + 1 - size
            if start:
                ok = pairs.get(table[start - 1] << 24 | token)
                if ok is None:
                    ok = self._follows(table[start - 1], token)
                if not ok:
                    continue
            add(token)
            done += 1
        if done != len(data):
            raise ValueError("the rank list cannot encode this text: a byte has no token")
        return table

    def walk_back(self, table: array | list) -> array:
        """The encoding that a table holds."""
        ids, end, sizes = array("i"), len(table), self._sizes
        while end:
            token = table[end - 1]
            ids.append(token)
            end -= sizes[token]
        ids.reverse()
        return ids

    def edit_table(self, data: bytes, table: array, start: int, end: int, new: bytes) -> tuple[bytes, array]:
        """A piece with bytes ``start`` to ``end`` replaced, and its table: entries before the edit
        stay, and once ``longest`` entries in a row behind it are as they were, all later ones are,
        since an entry depends on no more bytes and entries than these."""
        changed, shift, stop = data[:start] + new + data[end:], len(new) - (end - start), start + len(new)
        table = array("i", table)
        out = table[:start]
        while len(out) < len(changed):
            done = min(len(changed), max(len(out), stop) + 2 * self.longest)
            out = array("i", self.last_tokens(changed[:done], out))
            if done - self.longest >= stop and out[-self.longest:] == table[done - shift - self.longest:done - shift]:
                out.extend(table[done - shift:])
                break
        return changed, out

    def encode_piece(self, data: bytes) -> array:
        return self.walk_back(self.last_tokens(data))

    # -- whole texts --------------------------------------------------------------------

    def encode_plain(self, text: str) -> array:
        """Every match of the pattern encoded separately."""
        ids = array("i")
        for piece in self.pieces(text):
            ids += self.encode_piece(piece.encode())
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text.  No match of the pattern reaches from a non-blank character
        over a space, so the parts between spaces are encoded on their own (and remembered)
        unless blanks meet at such a cut."""
        parts = text.split(" ")                  # all but the first follow a space
        known = self.chunks.held.get
        found = list(map(known, parts))
        found[0] = None
        last = len(parts) - 1
        new: dict[str, bytes] = {}
        for i in [i for i, value in enumerate(found) if value is None]:
            part = parts[i]
            if i and part in new:
                found[i] = new[part]
                continue
            blank_end = part[-1:].isspace() or not part
            if blank_end and i != last and (i or part):
                return np.array(self.encode_plain(text), np.int32)
            ids = b"".join([(x[:1] == " " and known(x[1:])) or self.encode_piece(x.encode()).tobytes()
                            for x in self.pieces(" " + part if i else part)])
            found[i] = ids
            if i and not blank_end:
                new[part] = ids
                self.chunks.put(part, ids, len(ids))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from one table of all tokens."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        places = np.arange(ends[-1]) + np.repeat(self._starts[ids] - (ends - sizes), sizes)
        return self._blob[places].tobytes()

    def edit(self, text: str, ids: np.ndarray, start: int, end: int, new: str) -> tuple[str, np.ndarray]:
        """The text with ``text[start:end]`` replaced and its ids, of which only those near
        the edit are encoded again; ``start == end == len(text)`` appends."""
        left = start
        while left and not (text[left - 1:left] == " " and text[left - 2:left - 1].strip()):
            left -= 1
        left = max(left - 1, 0)                    # a space after a non-blank, at or before the edit
        right = end
        while right < len(text) and not (text[right] == " " and right > end and text[right - 1].strip()):
            right += 1
        sizes = np.cumsum(self.lengths[ids]) if len(ids) else np.zeros(0, np.int64)
        total = int(sizes[-1]) if len(sizes) else 0
        head = ids[:np.searchsorted(sizes, len(text[:left].encode()), "right")] if left else ids[:0]
        tail_bytes = len(text[right:].encode())
        tail = ids[np.searchsorted(sizes, total - tail_bytes, "right"):] if tail_bytes else ids[:0]
        middle = np.array(self.encode_plain(text[left:start] + new + text[end:right]), np.int32)
        return text[:start] + new + text[end:], np.concatenate([head, middle, tail]).astype(np.int32)


@lru_cache(4)
def _coder(name: str, pattern: str, blob: bytes, cuts: tuple[int, ...]) -> PrefixBpe:
    return PrefixBpe([blob[a:b] for a, b in zip((0, *cuts), cuts)], pattern)


class BpeTokenizer:
    """Spark operators over one rank file.  The tokens (at most the file's) are broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = load_tokens(path)
        self._shared = spark.sparkContext.broadcast(
            (path, pattern, b"".join(tokens), tuple(accumulate(map(len, tokens)))))

    def encode(self, docs: DataFrame, *keep: Column | str, text_col: str = "text") -> DataFrame:
        """The columns ``keep`` of every row and ``ids`` (array<int>): the encoding of the
        whole text, without special tokens.  Null and empty texts have no ids; repeated
        rows are encoded alike; other columns are ignored."""
        shared = self._shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(*shared.value)
            for part in slices(batches, "__text", own=coder.chunks):
                found = [coder.encode(t) for t in texts(part, "__text")]
                yield _with_lists(part, len(part.columns) - 1, found, "ids")

        rows = docs.select(*keep, F.col(text_col).alias("__text"))
        return rows.mapInArrow(run, _schema(rows, "ids array<int>"))

    def decode(self, rows: DataFrame, *keep: Column | str, ids_col: str = "ids") -> DataFrame:
        """The columns ``keep`` of every row and ``decoded`` (binary); null ids decode to no bytes."""
        shared = self._shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(*shared.value)
            for part in batches:
                lists = part.column(len(part.columns) - 1)
                decoded = [b"" if not x.is_valid else coder.decode(x.values.to_numpy(zero_copy_only=False))
                           for x in lists]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(decoded, pa.binary())],
                                                 [*part.schema.names[:-1], "decoded"])

        rows = rows.select(*keep, F.col(ids_col).alias("__ids"))
        return rows.mapInArrow(run, _schema(rows, "decoded binary"))

    def edit(self, rows: DataFrame, *keep: Column | str, text_col: str, ids_col: str, start_col: str,
             end_col: str, new_col: str) -> DataFrame:
        """Replaces characters ``start`` to ``end`` of every text by ``new`` and returns ``keep``,
        ``text`` and ``ids`` of the result, encoding only near the edit (``start = end =``
        length appends).  Null texts and replacements are empty."""
        shared = self._shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(*shared.value)
            for part in slices(batches, "__text", own=coder.chunks):
                n = len(part.columns) - 5
                done = [coder.edit(t or "", np.array(i or [], np.int32), s, e, r or "") for t, i, s, e, r in
                        zip(*(part.column(n + j).to_pylist() for j in range(5)))]
                lists = _with_lists(part, n, [d[1] for d in done], "ids")
                yield pa.RecordBatch.from_arrays(
                    [*lists.columns[:-1], pa.array([d[0] for d in done], pa.string()), lists.columns[-1]],
                    [*lists.schema.names[:-1], "text", "ids"])

        rows = rows.select(*keep, F.col(text_col).alias("__text"), F.col(ids_col).alias("__ids"),
                           F.col(start_col).alias("__start"), F.col(end_col).alias("__end"),
                           F.col(new_col).alias("__new"))
        return rows.mapInArrow(run, _schema(rows, "text string, ids array<int>", 5))


def _schema(rows: DataFrame, extra: str, drop: int = 1) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-drop]] + [extra])


def _with_lists(part: pa.RecordBatch, n: int, found: list[np.ndarray], name: str) -> pa.RecordBatch:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))
    return pa.RecordBatch.from_arrays([*part.columns[:n], lists], [*part.schema.names[:n], name])
