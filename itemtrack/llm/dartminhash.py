"""Operator 7: near-duplicate classes by DartMinHash and banded joining.

Every element (a word shingle) owns a random, hash-made set of darts thrown at the
plane of weight and rank, one per unit of area on average.  A document's darts are
those below its elements' weights; each dart falls on one of ``k`` coordinates and a
coordinate keeps its earliest dart (lowest rank).  Two documents share a coordinate's
dart with a probability equal to their weighted Jaccard similarity.  About
k*ln(k) + 2k darts are thrown whatever the size of the document.

A shingle weighs as often as it occurs in the text (``weighted=False``: once).  Bands of
coordinates are joined; candidates are compared exactly by the same similarity, as sets of
numbered occurrences; classes are the connected components of the links found.  Texts with
equal weights are one node from the start, so copies never meet as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from itemtrack.llm.common import materialize, mix64, slices, text_bytes, word_hashes
from itemtrack.operators.common import join_split

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 64, 8        # a pair at 0.8 shares no band with probability 8e-6
PARITY = 16                # 64-bit words of parities that a node carries into the join of rarest shingles
_GOLD = np.uint64(0x9E3779B97F4A7C15)

# Cumulative probabilities of a Poisson number with mean 1, on the 32-bit scale.
_POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 16)])]) * 2.0 ** 32


def shingles(words: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles and how often each occurs; a text
    of fewer words than ``width`` has one shingle of them all, a text without words none."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, width = word_hashes(words), min(width, len(words))
    n = len(hashes) - width + 1
    keys = np.full(n, width, np.uint64)
    for i in range(width):
        keys = mix64(keys * _GOLD + hashes[i:i + n])
    return np.unique(keys, return_counts=True)


def occurrences(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit name per occurrence (the element's first, second, ...): the Jaccard
    similarity of such sets is the weighted one of the counts."""
    if len(elements) == counts.sum():
        return elements
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.where(turn == 0, np.uint64(0), mix64(turn.astype(np.uint64) * _GOLD)) + np.repeat(elements, counts)


def _weighted(data: bytes, width: int, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text and their weights."""
    elements, counts = shingles(data.split(), width)
    return elements, counts if weighted else np.ones_like(counts)


def dart_sketch(elements: np.ndarray, weights: np.ndarray | None, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates (its rank, which also names it).

    The plane over an element is cut into cells of unit width in weight and rank; a cell
    holds a Poisson number of darts.  The cost is the sum of the rounded-up weights plus
    about k*ln(k) + 2k; it is meant for weights of the order of one.
    """
    sketch = np.full(k, np.uint64(0xFFFFFFFFFFFFFFFF))
    if weights is None:
        cells, levels, total, limit = elements, np.zeros(len(elements), np.uint64), len(elements), None
    else:
        tall = np.ceil(weights).astype(np.int64)
        cells = np.repeat(elements, tall)
        levels = (np.arange(len(cells)) - np.repeat(np.cumsum(tall) - tall, tall)).astype(np.uint64)
        limit, total = np.repeat(weights, tall) - levels, weights.sum()
        if (limit >= 1).all():                       # whole weights: every dart of a cell is below
            limit = None
    if not total > 0:
        return sketch
    cells = mix64(cells + levels * _GOLD)
    first, n = 0, int(np.ceil(k * (np.log(k) + 2) / total))
    while True:
        ranks = np.arange(first, first + n, dtype=np.uint64)
        keys = mix64(cells[:, None] + (ranks + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)).ravel()
        count = np.searchsorted(_POISSON, (keys >> np.uint64(32)).astype(np.float64), "right")
        place = np.repeat(np.arange(len(keys)), count)
        turn = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        darts = mix64(keys[place] + (turn + 1).astype(np.uint64) * _GOLD)
        rank = (ranks[place % n] << np.uint64(40)) | (darts >> np.uint64(24))
        coordinate = ((darts & np.uint64(0xFFFFFF)) % np.uint64(k)).astype(np.int64)
        if limit is not None:
            height = (mix64(darts) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
            under = height < limit[place // n]
            rank, coordinate = rank[under], coordinate[under]
        np.minimum.at(sketch, coordinate, rank)
        if not (sketch == np.uint64(0xFFFFFFFFFFFFFFFF)).any():
            return sketch
        first, n = first + n, n                      # rarely: coordinates without a dart so far


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for part in sketch.reshape(bands, rows).T:
        keys = mix64(keys * _GOLD + part)
    return keys


def _set_key(elements: np.ndarray) -> int:
    """A 64-bit name of a set of occurrences."""
    total = mix64(elements * _GOLD).sum(dtype=np.uint64, keepdims=True)  # arrays wrap around silently
    return int(mix64(total + np.array([len(elements)], np.uint64) * _GOLD)[0].astype(np.int64))


def _parities(elements: np.ndarray) -> np.ndarray:
    """Bits of ``PARITY`` words: whether an odd number of the elements falls on each.  An
    element of only one of two sets turns one bit, so their bits differ in no more places than the
    sets do in elements."""
    n = 64 * PARITY
    odd = np.bincount((elements % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, width: int,
                     weighted: bool = True) -> DataFrame:
    """doc_id, key (names the weighted shingles; null without words), n (their weight) and bands."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, sizes, found = [], [], []
            for data in text_bytes(part):
                elements, weights = _weighted(data, width, weighted)
                sizes.append(int(weights.sum()))
                keys.append(_set_key(occurrences(elements, weights)) if len(elements) else None)
                found.append(band_keys(dart_sketch(elements, weights, bands * rows), bands, rows).astype(np.int64)
                             if len(elements) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "key", "n", "bands"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, key long, n long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int, weighted: bool) -> DataFrame:
    """key, shingles (all occurrences) and their parities of the nodes in ``wanted`` (key, doc_id: one document of the node)."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = plain.join(wanted, plain["doc_id"].eqNullSafe(wanted["doc_id"])).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, found, parities = [], [], []
            for key, data in zip(part.column(0).to_pylist(), text_bytes(part)):
                elements = occurrences(*_weighted(data, width, weighted))
                if len(elements) and _set_key(elements) == key:  # ids may repeat over different texts
                    keys.append(key)
                    found.append(elements.astype(np.int64))
                    parities.append(_parities(elements))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, kind),
                                              pa.array(parities, kind)], ["key", "shingles", "parities"])

    return rows.mapInArrow(run, "key long, shingles array<long>, parities array<long>").dropDuplicates(["key"])


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are at least that similar, compared exactly."""
    one = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(two, "b").join(one, "a")
            .filter(both >= F.lit(similarity) * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def _prefixes(sets: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The rarest shingles of every node (key, n, label, apart, shingle), so many that two
    nodes as similar as asked share one of them.

    ``small`` bounds the size of the nodes that a node may be linked to.  Such sets have at
    least t / (1 + t) * (n + small) shingles in common, so of a node's shingles, ordered by
    their frequency, all but so many less one must hold a common one.  Shingles of one
    node only are not returned.
    """
    least = F.greatest(F.col("small").cast("double"), F.lit(similarity) * F.col("n"))
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + least) - 1e-6)
    spread = (sets.join(nodes.select("key", (F.col("n") - need + 1).cast("int").alias("length")), "key")
              .select("key", "length", F.explode("shingles").alias("shingle")))
    often = spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"))
    ordered = join_split(spread, often, "shingle").groupBy("key", "length").agg(
        F.array_sort(F.collect_list(F.struct("c", "shingle"))).alias("all"))
    rare = ordered.select("key", F.explode(F.slice("all", F.lit(1), F.greatest("length", F.lit(0)))).alias("one"))
    return (rare.filter("one.c > 1").select("key", F.col("one.shingle").alias("shingle"))
            .join(nodes.select("key", "n", "label", "apart"), "key"))


def _candidates(prefixes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of an apart node and one of another component that share a rarest shingle, unless
    their sizes or parities rule out that they are as similar as asked.

    Sets of that similarity differ in at most (1 - t) / (1 + t) of their elements.  In a group of
    near copies nearly all pairs share a shingle; what is written and compared are those near the bound.
    """
    met = (prefixes.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                           F.max("apart").alias("apart"))
           .filter("apart = 1 AND lo <> hi").select("shingle"))
    open_ = materialize(join_split(prefixes, met, "shingle", "left_semi")
                        .join(sets.select("key", "parities"), "key"), "dart-open")
    one = open_.filter("apart = 1").select("shingle", F.col("key").alias("x"), F.col("n").alias("na"),
                                           F.col("label").alias("lx"), F.col("parities").alias("px"))
    two = open_.select("shingle", F.col("key").alias("y"), F.col("n").alias("nb"), F.col("label").alias("ly"),
                       F.col("parities").alias("py"))
    alike = F.least("na", "nb") >= F.lit(similarity) * F.greatest("na", "nb")
    differ = sum((F.bit_count(F.col("px")[i].bitwiseXOR(F.col("py")[i])) for i in range(PARITY)), F.lit(0))
    near = differ <= F.lit((1 - similarity) / (1 + similarity)) * (F.col("na") + F.col("nb")) + 1e-6
    return (one.join(two, "shingle").filter("lx <> ly").filter(alike).filter(near)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(key, label): every node of an edge with the least key of its connected component.

    Each round joins every node to its least neighbour, follows such pointers twice and
    contracts the edges; rounds grow with the logarithm of the longest path."""
    edges = materialize(edges.select("a", "b"), "dart-edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")), "dart-parents")
        for _ in range(2):
            over = up.select(F.col("a").alias("p"), F.col("p").alias("q"))
            up = materialize(up.join(over, "p").select("a", F.col("q").alias("p")), "dart-parents")
        if labels is None:
            labels = up.select(F.col("a").alias("key"), F.col("p").alias("label"))
        else:
            move = up.select(F.col("a").alias("label"), "p")
            labels = materialize(labels.join(move, "label", "left")
                                 .select("key", F.coalesce("p", "label").alias("label")), "dart-labels")
        ends = up.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        edges = materialize(edges.join(up, "a").join(ends, "b").filter("p <> pb")
                            .select(F.least("p", "pb").alias("a"), F.greatest("p", "pb").alias("b")).distinct(),
                            "dart-edges")
        if edges.isEmpty():
            return labels


def _classes(docs: DataFrame, similarity: float, id_col: str, text_col: str, width: int, bands: int,
             rows: int, weighted: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, label) of all rows, and (label, class_id) of all classes."""
    sketch = materialize(sketch_documents(docs, id_col, text_col, bands, rows, width, weighted), "dart-sketch")
    # One node per weighted shingle set: copies are reduced before anything is exploded or joined.
    nodes = materialize(sketch.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "dart-nodes")
    spread = nodes.select(F.explode("bands").alias("band"), "key", "n")
    shared = materialize(spread.groupBy("band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "dart-buckets")
    members = materialize(spread.join(shared, "band"), "dart-members")
    # The lead of a bucket is the node that meets most others in all its buckets: it tends to be
    # the middle of its group, so that most links are found with it.
    meets = members.groupBy("key").agg(F.sum("c").alias("meets"))
    leads = materialize(members.join(meets, "key").groupBy("band").agg(
        F.max_by("key", F.struct("meets", "key")).alias("lead")), "dart-leads")
    members = materialize(members.select("band", "key", "n").join(leads, "band"), "dart-members")
    sizes = materialize(members.select("key", "n").distinct(), "dart-found")
    sets = materialize(_sets(docs, nodes.join(sizes.select("key"), "key").select("key", "doc_id"),
                             id_col, text_col, width, weighted), "dart-sets")
    least, most = F.least("na", "nb"), F.greatest("na", "nb")  # sizes alone rule out many pairs
    alike = least >= F.lit(similarity) * most
    # Every node of a bucket with the bucket's lead.
    stars = materialize(
        members.filter("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b"), F.col("n").alias("nb"))
        .distinct().join(sizes.select(F.col("key").alias("a"), F.col("n").alias("na")), "a")
        .filter(alike).select("a", "b"), "dart-pairs")
    links = materialize(_links(stars, sets, similarity), "dart-links")
    labels = components(links)
    # Buckets that still hold several components: the members of all but the largest of them
    # against the members of the others.
    now = members.join(labels, "key", "left").select("band", "key", "n", F.coalesce("label", "key").alias("label"))
    now = materialize(now, "dart-open")
    parts = now.groupBy("band", "label").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("small"))
    largest = parts.groupBy("band").agg(F.max_by("label", F.struct("c", "label")).alias("main"),
                                        F.min("small").alias("small"), F.count(F.lit(1)).alias("parts"))
    largest = materialize(largest.filter("parts > 1").select("band", "main", "small"), "dart-largest")
    open_nodes = materialize(now.join(largest, "band").groupBy("key").agg(
        F.first("n").alias("n"), F.first("label").alias("label"), F.min("small").alias("small"),
        F.max((F.col("label") != F.col("main")).cast("int")).alias("apart")), "dart-nodes")
    prefixes = materialize(_prefixes(sets, open_nodes, similarity), "dart-prefixes")
    rest = materialize(_candidates(prefixes, sets, similarity).join(stars, ["a", "b"], "left_anti"), "dart-pairs")
    more = materialize(_links(rest, sets, similarity), "dart-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = materialize(sketch.select("doc_id", "key", "n").join(labels, "key", "left")
                        .select("doc_id", "key", "n", F.coalesce("label", "key").alias("label")), "dart-named")
    classes = named.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return named, materialize(classes, "dart-classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text", width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                    weighted: bool = True) -> DataFrame:
    """doc_id, class_id and n_shingles for every row of ``docs``.

    ``class_id`` is the smallest doc_id of the row's class: the connected component of
    links between texts that share a band and have a weighted Jaccard similarity of at
    least ``similarity``; a shingle weighs as often as it occurs (``weighted=False``: once).
    Rows with equal weights (copies, repeated rows) are in one class.  Null and empty texts and texts of blanks only have no shingles: each
    such row is alone, under its own id.  An empty table gives an empty result; other
    columns are ignored.

    Every node is first compared with the lead node of each of its buckets.  In buckets
    that then still hold several components, the members of all but the largest are
    compared with the members of the others that share one of their rarest shingles,
    which all that similar do: between two nodes of a bucket no link is lost.
    """
    named, classes = _classes(docs, similarity, id_col, text_col, width, bands, rows, weighted)
    return named.join(classes, "label", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.col("n").alias("n_shingles"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
             width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weighted: bool = True) -> DataFrame:
    """The rows of ``docs``, unchanged, of which one of each class stays: that of the
    smallest id (of repeated rows one).  Rows without words all stay.  All columns pass
    through whatever their names."""
    named, classes = _classes(docs, similarity, id_col, text_col, width, bands, rows, weighted)
    stays = (named.join(classes, "label").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
             .groupBy("label").agg(F.min("key").alias("__key"), F.first("class_id").alias("__id"))
             .select("__key", "__id"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, ident = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    plain = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            found = [occurrences(*_weighted(data, width, weighted)) for data in text_bytes(part, text)]
            keys = pa.array([_set_key(e) if len(e) else None for e in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, keys], [*part.schema.names, "__row"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields] + ["`__row` long"])
    rows_ = (plain.mapInArrow(run, schema).withColumn("__bare", F.col("__row").isNull())
             .withColumn("__row", F.coalesce("__row", F.xxhash64(ident))))
    hit = (F.col("__row") == F.col("__key")) & F.col(ident).eqNullSafe(F.col("__id"))
    turn = F.row_number().over(Window.partitionBy("__row", "__key").orderBy("__row"))
    return (rows_.join(stays, hit, "left").filter("`__bare` OR `__key` IS NOT NULL").withColumn("__turn", turn)
            .filter("`__bare` OR `__turn` = 1").select(*names).toDF(*docs.columns))
