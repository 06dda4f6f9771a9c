"""Operator 11: benchmark decontamination over a distributed positional inverted index (native).

Training texts become rows of words; a posting (term, row, position) is stored for every
occurrence of a term that the test phrases probe.  Of each phrase the two rarest terms are
probed: their posting lists, adjusted by the terms' offset in the phrase, are intersected
by one aggregation, and only the places that are left are compared with the whole phrase.
Phrases that share their two rarest terms at one distance share the intersection.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from itemtrack.llm.common import materialize
from itemtrack.operators.common import join_split

# Words are runs of other characters than these, after A-Z became lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_text(text: Column) -> Column:
    """The words of a text with one space between them (null: none)."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = (F.when(ascii_only, F.lower(text))
               .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))
    return F.trim(F.regexp_replace(lowered, SEPARATORS, " "))


def _exploded(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return df.where(F.col(text) != "").select(*keep, F.posexplode(F.split(text, " ")).alias("pos", "term"))


class PositionalIndex:
    """Rows of a training table and postings of their terms.

    ``rows``: row (a number fixed by the written table), doc_id, norm, n_words.  Null and
    empty texts have no words; repeated rows are rows of their own; other columns are
    ignored; an empty table gives an empty index.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        rows = docs.select(F.col(id_col).alias("doc_id"), normal_text(F.col(text_col)).alias("norm"))
        self.rows = materialize(rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "norm",
            F.when(F.col("norm") == "", F.lit(0)).otherwise(F.size(F.split("norm", " "))).cast("long")
            .alias("n_words")), "phrase-rows")

    def words(self) -> DataFrame:
        return _exploded(self.rows, "norm", "row")

    def frequencies(self, terms: DataFrame) -> DataFrame:
        """term, n: occurrences of those of ``terms`` that occur."""
        return (self.words().join(terms.select("term").distinct(), "term")
                .groupBy("term").agg(F.count(F.lit(1)).alias("n")))

    def postings(self, terms: DataFrame) -> DataFrame:
        """The stored postings (term, row, pos) of ``terms``, in term order within a file."""
        wanted = materialize(terms.select("term").distinct(), "phrase-terms")
        return materialize(self.words().join(wanted, "term").sortWithinPartitions("term", "row", "pos"),
                           "phrase-postings")


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct windows of ``size`` consecutive words over all items (of all its words, if
    an item has fewer): phrase_id, phrase, items (sorted ids as text; a null id is the empty text)."""
    words = F.split("norm", " ")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    each = (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                         normal_text(F.col(text_col)).alias("norm")).where("norm != ''")
            .select("item", words.alias("words"))
            .select("item", F.explode(F.transform(
                starts, lambda s: F.array_join(F.slice("words", s + 1, F.lit(size)), " "))).alias("phrase")))
    grouped = each.groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return materialize(grouped.select(F.monotonically_increasing_id().alias("phrase_id"), "phrase", "items"),
                       "phrase-windows")


def phrase_matches(index: PositionalIndex, phrases: DataFrame, longest: int) -> DataFrame:
    """Every occurrence of every phrase (phrase_id, phrase: words with one space between, at
    most ``longest`` of them, each phrase once): row, phrase_id, start, length.

    The term table of the phrases joins the words of the corpus; the planner broadcasts it
    if its written size allows and shuffles the words otherwise.
    """
    terms = materialize(_exploded(phrases, "phrase", "phrase_id"), "phrase-offsets")
    counted = materialize(index.frequencies(materialize(terms.select("term").distinct(), "phrase-vocabulary")),
                          "phrase-counts")
    # The two rarest places of a phrase; one with a term that occurs nowhere cannot match.
    order = Window.partitionBy("phrase_id").orderBy("n", "pos")
    rarest = (join_split(terms, counted, "term").withColumn("n", F.coalesce("n", F.lit(0)))
              .withColumn("place", F.row_number().over(order)).where("place <= 2"))
    pairs = (rarest.groupBy("phrase_id")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("two"), F.min("n").alias("n"))
             .where("n > 0")
             .select("phrase_id", F.col("two")[0]["pos"].alias("offset"), F.col("two")[0]["term"].alias("first"),
                     F.get("two", F.lit(1))["term"].alias("second"),
                     F.coalesce(F.get("two", F.lit(1))["pos"] - F.col("two")[0]["pos"], F.lit(0)).alias("gap")))
    pair = F.xxhash64("first", "second", "gap")      # equal marks only merge lists: all places are compared below
    pairs = materialize(pairs.withColumn("pair", pair), "phrase-pairs")

    one = pairs.select(F.col("first").alias("term"), "pair", F.lit(0).alias("gap"), F.lit(1).alias("side"),
                       F.when(F.col("second").isNull(), 1).otherwise(3).alias("need"))
    two = pairs.where("second IS NOT NULL").select(F.col("second").alias("term"), "pair", "gap",
                                                   F.lit(2).alias("side"), F.lit(3).alias("need"))
    probes = materialize(one.unionByName(two).distinct(), "phrase-probes")
    lists = index.postings(probes).join(probes, "term")
    places = (lists.groupBy("pair", "row", (F.col("pos") - F.col("gap")).alias("at"))
              .agg(F.bit_or("side").alias("sides"), F.max("need").alias("need")).where("sides = need"))
    # At most one place for each word of a document and pair: a document's share of the list is bounded by its size.
    asked = materialize(places.groupBy("row").agg(F.collect_list(F.struct("pair", "at")).alias("places")),
                        "phrase-places")

    reach = longest - 1
    # Texts and places meet by a sorted merge at every size: places grow with the corpus.
    texts = (index.rows.select("row", "norm").join(asked.hint("merge"), "row")
             .select("row", "places", F.split("norm", " ").alias("words")))

    def around(place: Column) -> Column:
        base = F.greatest(place["at"] - reach, F.lit(0))
        return F.struct(place["pair"].alias("pair"), place["at"].alias("at"), base.alias("base"),
                        F.slice("words", base + 1, F.least(F.size("words"), F.lit(2 * reach + 1))).alias("near"))

    shown = texts.select("row", F.explode(F.transform("places", around)).alias("p")).select("row", "p.*")
    own = materialize(pairs.join(phrases.select("phrase_id", "phrase"), "phrase_id")
                      .select("pair", "phrase_id", "offset", "phrase", F.size(F.split("phrase", " ")).alias("length")),
                      "phrase-owners")
    found = (shown.join(own, "pair").withColumn("start", F.col("at") - F.col("offset")).where("start >= base")
             .where(F.array_join(F.slice("near", F.col("start") - F.col("base") + 1, F.col("length")), " ")
                    == F.col("phrase")))
    return found.select("row", "phrase_id", "start", "length")


def proximity_matches(index: PositionalIndex, queries: DataFrame, within: int, id_col: str = "query_id",
                      text_col: str = "text") -> DataFrame:
    """Places where all distinct words of a query stand among ``within`` consecutive words, in
    any order: row, query_id, first, last (positions of the first and last query word among
    the ``within`` words that end at ``last``, itself a query word).  Queries without words match nothing."""
    terms = materialize(_exploded(queries.select(F.col(id_col).alias("query_id"), normal_text(F.col(text_col))
                                                 .alias("norm")), "norm", "query_id")
                        .select("query_id", "term").distinct(), "near-terms")
    counted = index.frequencies(terms)
    sizes = (join_split(terms, counted, "term").groupBy("query_id")
             .agg(F.count(F.lit(1)).alias("size"), F.min(F.coalesce("n", F.lit(0))).alias("n"),
                  F.min_by("term", F.coalesce("n", F.lit(0))).alias("rarest")).where("n > 0"))
    sizes = materialize(sizes, "near-sizes")
    lists = index.postings(terms).join(terms, "term").join(sizes.select("query_id", "size", "rarest"), "query_id")
    # Rows without the rarest word drop out before lists are put in order.
    rows = lists.where("term = rarest").select("query_id", "row").distinct()
    lists = join_split(lists, rows, ["query_id", "row"], "left_semi")
    ahead = Window.partitionBy("query_id", "row").orderBy("pos").rangeBetween(1 - within, 0)
    return (lists.withColumn("seen", F.size(F.collect_set("term").over(ahead)))
            .withColumn("first", F.min("pos").over(ahead)).where("seen = size")
            .select("row", "query_id", "first", F.col("pos").alias("last")))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted ids as text),
    contaminated.

    A word is hit if it lies inside an occurrence of a window of any item.  Null and empty
    texts have no words and no hits; items without words have no windows; items are told
    apart by their ids (a null id is the empty text); repeated documents are judged each; an
    empty table of items contaminates nothing; other columns are ignored.
    """
    index, phrases = PositionalIndex(docs, id_col, text_col), windows(items, size, item_id_col, item_text_col)
    matches = materialize(phrase_matches(index, phrases, size), "phrase-matches")
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    spans = matches.withColumn("done", F.coalesce(F.max(end).over(before), F.lit(0)))
    hits = spans.groupBy("row").agg(
        F.sum(F.greatest(end - F.greatest("start", "done"), F.lit(0))).cast("long").alias("n_hit"))
    named = (matches.select("row", "phrase_id").distinct().join(phrases.select("phrase_id", "items"), "phrase_id")
             .groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    judged = materialize(hits.join(named, "row"), "phrase-judged")
    out = index.rows.select("row", "doc_id", "n_words").join(judged, "row", "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                      F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))
