"""JON-06: classify free-text reasons with ordered keyword rules per market.

The rules are a config sheet: (market, rule_no, keyword list, blocker_type).  Reason
texts repeat a lot, so candidates are looked up once per distinct (market, text).  A
keyword can only be in a text that has all of its trigrams; the one that is rarest among the
market's keywords stands for it in an index, and the trigrams of a text meet the index by
equality.  Only these candidates are searched in the text.  Keywords of one or two letters
have no trigram and are searched in every text of their market.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.functions import fixed
from itemtrack.functions.scalars import _regex_literal
from itemtrack.operators.common import join_split

GRAM = 3


def _keywords(rules: DataFrame, sep: str) -> DataFrame:
    """One row per keyword: market, rule number, keyword, type."""
    return (rules.where(F.col("keyword").isNotNull())
            .select(F.col("market").alias("_rule_market"), "rule_no", F.col("blocker_type").alias("_type"),
                    F.explode(F.split(F.col("keyword"), _regex_literal(sep))).alias("_word")))


def grams(text: Column) -> Column:
    """The distinct trigrams of a text, read in one pass (overlapping matches by look-ahead)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def keyword_index(words: DataFrame) -> DataFrame:
    """The keywords of at least three letters with their trigram that the fewest keywords of the market have."""
    long = words.where(F.length("_word") >= GRAM)
    each = long.select("*", F.explode(grams(F.col("_word"))).alias("_gram"))
    shared = (each.select("_rule_market", "_word", "_gram").distinct()
              .groupBy("_rule_market", "_gram").agg(F.count(F.lit(1)).alias("_n")))
    rarest = (each.join(shared, ["_rule_market", "_gram"]).groupBy("_rule_market", "rule_no", "_type", "_word")
              .agg(F.min(F.struct("_n", "_gram")).alias("_key")))
    return rarest.select("_rule_market", F.col("_key._gram").alias("_gram"), "rule_no", "_type", "_word")


def candidates(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(``_id``, rule number, type, keyword): keywords that may be in the text of that id.

    ``texts``: _id, _market, _text.  Long texts are not carried along with their trigrams.
    """
    columns = ["_id", "rule_no", "_type", "_word"]
    probes = texts.select("_id", "_market", F.explode(grams(F.col("_text"))).alias("_gram"))
    index = keyword_index(words)
    long = probes.join(index, (F.col("_market") == F.col("_rule_market")) & (probes["_gram"] == index["_gram"]))
    short = texts.join(words.where(F.length("_word") < GRAM),
                       (F.col("_market") == F.col("_rule_market")) & F.col("_text").contains(F.col("_word")))
    return long.select(*columns).unionByName(short.select(*columns))


def first_matching_rule(df: DataFrame, rules: DataFrame, text_col: str = "reason_text",
                        market_col: str = "market", out: str = "matched_type",
                        sep: str = fixed.KEYWORD_SEPARATOR, only_when: Column | None = None,
                        matched: str | None = None) -> DataFrame:
    """Blocker type of the first rule (by rule_no, same market) with any keyword
    as a literal, case-sensitive substring of the text; NULL when none matches
    (or when ``only_when`` is false) and also when the rule that matches has no type.
    ``matched`` names a column that tells these cases apart."""
    asked = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn(
        "_text", F.col("_text") if only_when is None else F.when(only_when, F.col("_text")))
    asked = asked.withColumn("_market", F.col(market_col)).withColumn(
        "_id", F.when(F.col("_text").isNotNull(), F.xxhash64("_market", "_text")))
    texts = asked.where("_text IS NOT NULL").select("_id", "_market", "_text").distinct()
    # Texts of one id would share their candidates; all of them are searched in the text itself.
    # A text has at most its market's keywords as candidates.
    found = (candidates(texts, _keywords(rules, sep)).groupBy("_id")
             .agg(F.collect_set(F.struct("rule_no", "_type", "_word")).alias("_found")))
    joined = join_split(asked, found, "_id", "left")
    text = F.col("_text")
    hits = F.filter("_found", lambda k: text.contains(k["_word"]))
    hit = F.array_min(F.transform(hits, lambda k: F.struct(k["rule_no"], k["_type"])))
    joined = joined.withColumn("_hit", hit).withColumn(out, F.col("_hit._type"))
    if matched:
        joined = joined.withColumn(matched, F.col("_hit").isNotNull())
    return joined.select(*df.columns, out, *([matched] if matched else []))


def classify(df: DataFrame, rules: DataFrame, text_col: str = "reason_text",
             contribution_col: str = "contribution", market_col: str = "market",
             out: str = "new_reason", sep: str = fixed.KEYWORD_SEPARATOR) -> DataFrame:
    """JON-06 in full.

    contribution = 'OperationalRule' and text != '': type of the first matching rule of
    the market (NULL if that rule has none), without a match 'Others'; contribution =
    'OperationalRule' and text = '': 'No blocker'; any other contribution: 'Others'.
    Missing values count as ''.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    contrib = F.coalesce(F.col(contribution_col), F.lit(""))
    is_rule = contrib == fixed.OPERATIONAL_RULE
    found = first_matching_rule(df, rules, text_col, market_col, "_found", sep,
                                only_when=is_rule & (text != ""), matched="_matched")
    decision = (F.when(F.col("_matched"), F.col("_found"))
                .when(is_rule & (text == ""), F.lit(fixed.REASON_NONE))
                .otherwise(F.lit(fixed.REASON_OTHERS)))
    return found.withColumn(out, decision).drop("_found", "_matched")
