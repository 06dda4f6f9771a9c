"""Operator 12: repair of conversation structure by a generalised LR parse.

The role grammar is ``Talk -> empty | Turns | s Turns``, ``Turns -> Pair | Turns Pair``,
``Pair -> u a`` over role initials.  Its LR automaton drives a graph-structured stack: all
stacks that the rows so far can lead to are kept at once, sharing their lower nodes, under
the edits keep, rerole, delete and insert; equal stacks are merged by the least (cost,
audit).  Two audits of equal cost that end in a row never are a prefix of one another, so
the least one stays the least whatever follows.

Spark numbers the rows of every conversation by range partitions and marks repeated ones by
aggregation, so a conversation of any length is spread over many tasks.  The parse reads one
letter a row, in blocks; its frozen prefixes are kept as chunks, so its time is linear and
no task ever holds the texts of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.llm.common import materialize, shuffles_removed
from itemtrack.operators.common import rank_within

BLOCK = 4096               # rows of a conversation whose letters make one string
FREEZE = 512               # rows after which a stack's audit so far becomes a chunk
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1     # fixed values: costs
BLANK = r"[^\x20\x09-\x0D]"                                 # fixed values: what a text must hold, and how it ends
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

# -- the grammar and its automaton --------------------------------------------------------

RULES = (("Talk", ()), ("Talk", ("Turns",)), ("Talk", ("s", "Turns")), ("Turns", ("Pair",)),
         ("Turns", ("Turns", "Pair")), ("Pair", ("u", "a")))


def _closure(items: frozenset) -> frozenset:
    todo, done = list(items), set(items)
    while todo:
        rule, dot = todo.pop()
        body = RULES[rule][1]
        for i, (head, _) in enumerate(RULES):
            if dot < len(body) and head == body[dot] and (i, 0) not in done:
                done.add((i, 0))
                todo.append((i, 0))
    return frozenset(done)


START = _closure(frozenset((i, 0) for i, (head, _) in enumerate(RULES) if head == "Talk"))


@cache
def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure(frozenset((r, d + 1) for r, d in state if RULES[r][1][d:d + 1] == (symbol,)))


def _reduced(stack: tuple) -> tuple:
    """A stack (state, lower stack) with all complete parts but the whole talk reduced."""
    while True:
        done = [r for r, d in stack[0] if d and d == len(RULES[r][1]) and RULES[r][0] != "Talk"]
        if not done:
            return stack
        head, body = RULES[done[0]]
        for _ in body:
            stack = stack[1]
        stack = (_goto(stack[0], head), stack)


def _shift(stack: tuple, symbol: str) -> tuple | None:
    state = _goto(stack[0], symbol)
    return _reduced((state, stack)) if state else None


def _accepts(stack: tuple) -> bool:
    return any(RULES[r][0] == "Talk" and d == len(RULES[r][1]) for r, d in stack[0])


def _all_stacks() -> list[tuple]:
    """Every reduced stack that role initials can lead to: finitely many, as pairs and turns
    are reduced at once."""
    found = [(START, None)]
    for stack in found:
        found += [to for symbol in "sua" if (to := _shift(stack, symbol)) and to not in found]
    return found


STACKS = _all_stacks()                       # place 0 is the empty stack; a stack is known by its place
SHIFT = [{c: STACKS.index(to) if (to := _shift(s, c)) else None for c in "sua"} for s in STACKS]
ACCEPTS = [_accepts(s) for s in STACKS]

# -- edits --------------------------------------------------------------------------------

# A row's letter tells the place of its role initial in "sua" (3: another) and its fault
# (0 none, 1 blank, 2 duplicate, 3 truncated).
def letter(initial: int, fault: int) -> str:
    return chr(65 + 4 * fault + initial)


@cache
def inserted(stack: int) -> tuple:
    """All (stack, cost, edits) that inserts alone lead to."""
    best, todo = {stack: (0, "")}, [stack]
    while todo:
        at = todo.pop()
        for symbol in "ua":
            to, made = SHIFT[at][symbol], (best[at][0] + INSERT, best[at][1] + "I")
            if to is not None and (to not in best or made < best[to]):
                best[to] = made
                todo.append(to)
    return tuple((s, c, e) for s, (c, e) in best.items())


@cache
def moves(stack: int, row: str) -> tuple:
    """All (stack, cost, edits) over one row: inserts before it, then its own edit."""
    initial, fault = "sua?"[(ord(row) - 65) % 4], (ord(row) - 65) // 4
    best: dict = {}

    def offer(to, cost, edits):
        if to is not None and (to not in best or (cost, edits) < best[to]):
            best[to] = (cost, edits)

    for at, cost, edits in inserted(stack):
        offer(at, cost + DELETE, edits + "D")
        if fault not in (1, 2):
            late = cost + (TRUNCATED if fault == 3 else 0)
            if initial != "?":
                offer(SHIFT[at][initial], late + KEEP, edits + "K")
            for symbol in "ua":
                offer(SHIFT[at][symbol], late + REROLE, edits + "R")
    return tuple((s, c, e) for s, (c, e) in best.items())


class Parse:
    """The graph-structured stack over the rows read so far: per stack its least cost, the
    place of its frozen prefix in audit order, the audit since, and the prefix's chunks."""

    def __init__(self):
        self.tops = {0: (0, 0, "", None)}
        self.since = 0

    def read(self, rows: str) -> None:
        for row in rows:
            tops: dict = {}
            for stack, (cost, place, audit, chunks) in self.tops.items():
                for to, more, edits in moves(stack, row):
                    new, old = (cost + more, place, audit + edits), tops.get(to)
                    if old is None or new < old[:3]:
                        tops[to] = (*new, chunks)
            self.tops = tops
            self.since += 1
            if self.since == FREEZE:
                self._freeze()

    def _freeze(self) -> None:
        order = {a: i for i, a in enumerate(sorted({t[1:3] for t in self.tops.values()}))}
        self.tops = {s: (cost, order[place, audit], "", (audit, chunks))
                     for s, (cost, place, audit, chunks) in self.tops.items()}
        self.since = 0

    def finish(self) -> tuple[int, list[str]]:
        """Cost and audit (in chunks, in order) of the cheapest edit of all rows read."""
        ends = [((cost + more, place, audit + edits), chunks)
                for stack, (cost, place, audit, chunks) in self.tops.items()
                for to, more, edits in inserted(stack) if ACCEPTS[to]]
        (cost, _, audit), chunks = min(ends, key=lambda e: e[0])
        parts = [audit]
        while chunks:
            parts.append(chunks[0])
            chunks = chunks[1]
        return cost, parts[::-1]


@lru_cache(20_000)
def _short(rows: str) -> tuple[int, str]:
    parse = Parse()
    parse.read(rows)
    cost, parts = parse.finish()
    return cost, "".join(parts)


def repair_letters(blocks: list[str]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows given by their letters."""
    if len(blocks) == 1 and len(blocks[0]) <= 64:
        return _short(blocks[0])
    parse = Parse()
    for rows in blocks:
        parse.read(rows)
    cost, parts = parse.finish()
    return cost, "".join(parts)


# -- Spark --------------------------------------------------------------------------------

def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text of damaged rows: crc32 of ``conv_id:turn`` modulo 20 drops a row
    (0), empties its text (1), takes its ``[.!?]`` away (2), repeats it (3) or makes it the
    user's (4).  Null roles, texts, and ids within the checksum are one space."""
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                filled(role_col).alias("role"), filled(text_col).alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.where("kind != 0").withColumn("copy", F.explode(copies))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text")))


class Repair:
    """Structure repair of conversations given as rows (conv_id, turn, role, text).

    Rows are taken by turn (nulls first), then role and text.  A row's first fault counts:
    blank, duplicate (role and text of an earlier row), truncated.  Null roles and texts are
    one space; a null id is a conversation of its own; repeated rows are duplicates; an
    empty table gives empty results; other columns are ignored.

    ``ranked``: the rows with position (from 1); ``letters``: their letters.  ``summary``: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit.  ``edits``: conv_id, position, edits (of
    the row and the inserts before it, at the last row also those behind), made (roles made by
    the edits of earlier rows), system (whether the first role made is the system's).
    """

    def __init__(self, rows: DataFrame):
        text = F.coalesce("text", F.lit(" "))
        given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                            F.sha2(text, 256).alias("digest"), text.rlike(BLANK).alias("shown"),
                            text.rlike(ENDED).alias("ended"))
        with shuffles_removed(rows.sparkSession):
            ranked = rank_within(given, "conv_id", ["turn", "role", "text"], out="position")
        firsts = (ranked.groupBy("conv_id", "role", "digest").agg(F.min("position").alias("first"))
                  .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
        # Texts stay in the written table.  The hash leads the join, so that both sides are exchanged
        # for it and a hot key can be split.
        marks = ranked.drop("text").withColumn("_h", F.xxhash64("conv_id", "role", "digest"))
        firsts = firsts.withColumn("_g", F.xxhash64("_c", "_r", "_d"))
        same = ((marks["_h"] == firsts["_g"]) & marks["conv_id"].eqNullSafe(firsts["_c"])
                & (marks["role"] == firsts["_r"]) & (marks["digest"] == firsts["_d"]))
        initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"),
                         F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1).otherwise(3)
        fault = (F.when(~F.col("shown"), 1).when(F.col("position") > F.col("first"), 2)
                 .when(~F.col("ended"), 3).otherwise(0))
        self.ranked = ranked
        self.letters = materialize(marks.join(firsts, same).select(
            "conv_id", "turn", "position", F.char(65 + 4 * fault + initial).alias("letter")), "talk-letters")
        self._parsed = materialize(self._parse(), "talk-edits")

    def _parse(self) -> DataFrame:
        blocks = (self.letters.groupBy("conv_id", F.floor((F.col("position") - 1) / BLOCK).alias("block"))
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "letter"))),
                                                lambda x: x["letter"]), "").alias("letters")))
        id_type = blocks.schema["conv_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, talks in _talks(batches):
                rows = chain.from_iterable(_edit_rows(conv, "".join(parts), *repair_letters(parts))
                                           for conv, parts in zip(ids.to_pylist(), talks))
                while some := list(islice(rows, BATCH_ROWS)):
                    yield _edit_batch(some, ids.type)

        return (blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
                .mapInArrow(run, f"conv_id {id_type}, position long, edits string, made long, system boolean, "
                                 "audit string, cost long, illegal long, blank long, duplicate long, truncated long"))

    @property
    def edits(self) -> DataFrame:
        return self._parsed.select("conv_id", "position", "edits", "made", "system")

    @property
    def summary(self) -> DataFrame:
        """One row per conversation that has rows."""
        turns = self.letters.groupBy("conv_id").agg(
            F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
        gaps = turns.select("conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0))
                            .cast("long").alias("gaps"))
        # The audit is one cell by its statement: a letter per row and insert.
        audits = self._parsed.where("position = 1").select(
            F.col("conv_id").alias("_c"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        return gaps.join(audits, gaps["conv_id"].eqNullSafe(audits["_c"])).drop("_c")

    def repaired(self) -> DataFrame:
        """The repaired rows: conv_id, place (from 0), role, text, edit (K, R or I).  All rows of
        a conversation lie in one partition of the result, in order; a task reads them as a
        stream and holds none."""
        texts = self.ranked.select("conv_id", "position", F.lit(1).alias("kind"), "role", "text",
                                   *[F.lit(None).cast(t).alias(c) for c, t in _EDIT_COLUMNS])
        edits = self.edits.select("conv_id", "position", F.lit(0).alias("kind"),
                                  *[F.lit(None).cast("string").alias(c) for c in ("role", "text")],
                                  "edits", "made", "system")
        id_type = texts.schema["conv_id"].dataType.simpleString()
        return (texts.unionByName(edits).repartition("conv_id")
                .sortWithinPartitions("conv_id", "position", "kind")
                .mapInArrow(_apply_edits, f"conv_id {id_type}, place long, role string, text string, edit string"))


_EDIT_COLUMNS = (("edits", "string"), ("made", "long"), ("system", "boolean"))


def _talks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[str]]]]:
    """Whole conversations (ids and blocks of letters), those of a batch at a time."""
    held_id, held, any_held, kind = None, [], False, None
    for batch in batches:
        ids, letters = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        kind, done_ids, done = batch.column(0).type, [], []
        for conv, rows in zip(ids, letters):
            if any_held and conv != held_id:
                done_ids.append(held_id)
                done.append(held)
                held = []
            held_id, any_held = conv, True
            held.append(rows)
        if done:
            yield pa.array(done_ids, kind), done
    if any_held:
        yield pa.array([held_id], kind), [held]


_LEGAL = {"su", "ua", "au"}
_INITIALS = {65 + 4 * f + i: "sua?"[i] for f in range(4) for i in range(4)}
_FAULTS = {65 + 4 * f + i: str(f) for f in range(4) for i in range(4)}
BATCH_ROWS = 20_000


def _edit_rows(conv, letters: str, cost: int, audit: str) -> Iterator[tuple]:
    """The rows of the edits table for one conversation; the first carries its figures."""
    initials = letters.translate(_INITIALS)
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    faults = letters.translate(_FAULTS)
    figures = (audit, cost, illegal, faults.count("1"), faults.count("2"), faults.count("3"))
    system = (len(audit) - audit.count("D")) % 2 == 1
    made, start, place, last = 0, 0, 1, len(audit.rstrip("I"))
    for end in range(last):
        if audit[end] != "I":
            edits = audit[start:end + 1] + (audit[last:] if end == last - 1 else "")
            yield (conv, place, edits, made, system, *(figures if place == 1 else (None,) * 6))
            made += end - start + (audit[end] != "D")
            start, place = end + 1, place + 1


_EDIT_TYPES = {"position": pa.int64(), "edits": pa.string(), "made": pa.int64(), "system": pa.bool_(),
               "audit": pa.string(), "cost": pa.int64(), "illegal": pa.int64(), "blank": pa.int64(),
               "duplicate": pa.int64(), "truncated": pa.int64()}


def _edit_batch(rows: list[tuple], id_type) -> pa.RecordBatch:
    types = {"conv_id": id_type, **_EDIT_TYPES}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))


def _apply_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edits, made, system = "", 0, False
    for batch in batches:
        out: list[tuple] = []
        for conv, _, kind, role, text, *own in zip(*(batch.column(i).to_pylist() for i in range(8))):
            if kind == 0:
                edits, made, system = own
                continue
            place = made
            for edit in edits:
                if edit == "D":
                    continue
                new = "system" if system and not place else ("user", "assistant")[(place - system) % 2]
                out.append((conv, place, role if edit == "K" else new, "" if edit == "I" else text, edit))
                place += 1
        if out:
            types = [batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["conv_id", "place", "role", "text", "edit"])


def talk_digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 (lines ``role:text`` joined by newlines) of rows as
    :meth:`Repair.repaired` gives them: the digest of a conversation is read as a stream."""
    id_type = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_id, digest, kind = None, None, None

        def ready(done):
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind),
                                               pa.array([d[1] for d in done], pa.string())],
                                              ["conv_id", "repaired_sha256"])

        for batch in batches:
            done, kind = [], batch.column(0).type
            for conv, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if place == 0:
                    if digest is not None:
                        done.append((held_id, digest.hexdigest()))
                    held_id, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield ready(done)
        if digest is not None:
            yield ready([(held_id, digest.hexdigest())])

    return repaired.mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")
