"""JON-05 code <-> market lookup, FLT-04 allow-list, FLT-05 region sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack.functions import fixed
from itemtrack.operators.common import literal_table


def _last(codes: DataFrame, key: str, value: str, order_col: str) -> DataFrame:
    """One row per ``key``; the last duplicate in sheet order wins."""
    if order_col not in codes.columns:
        raise ValueError(f"the code sheet needs its order in column {order_col!r}")
    agg = F.max_by(F.col(value), F.col(order_col))
    return codes.where(F.col(key).isNotNull()).groupBy(key).agg(agg.alias(value))


def code_to_market(codes: DataFrame, order_col: str = "seq") -> DataFrame:
    return _last(codes, "market_code", "market", order_col)


def market_to_code(codes: DataFrame, order_col: str = "seq") -> DataFrame:
    return _last(codes, "market", "market_code", order_col)


def _strict(col: str, what: str, key: str):
    return F.coalesce(F.col(col), F.raise_error(
        F.concat(F.lit(f"unknown {what}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))))


def attach_market(df: DataFrame, codes: DataFrame, code_col: str = "market_code",
                  out: str = "market", strict: bool = False, order_col: str = "seq") -> DataFrame:
    """JON-05, code -> market: left join (the planner broadcasts a small map).  Unknown codes keep a NULL market (see :func:`rejects`) or, in
    strict mode, fail the job like the reference's dictionary lookup."""
    cmap = code_to_market(codes, order_col).select(
        F.col("market_code").alias("_code"), F.col("market").alias("_market"))
    joined = df.join(cmap, F.col(code_col) == F.col("_code"), "left")
    value = _strict("_market", "market code", code_col) if strict else F.col("_market")
    return joined.withColumn(out, value).drop("_code", "_market")


def attach_code(df: DataFrame, codes: DataFrame, market_col: str = "market",
                out: str = "market_code", strict: bool = False,
                order_col: str = "seq") -> DataFrame:
    """JON-05, market -> code."""
    cmap = market_to_code(codes, order_col).select(
        F.col("market").alias("_mk"), F.col("market_code").alias("_mcode"))
    joined = df.join(cmap, F.col(market_col) == F.col("_mk"), "left")
    value = _strict("_mcode", "market", market_col) if strict else F.col("_mcode")
    return joined.withColumn(out, value).drop("_mk", "_mcode")


def rejects(df: DataFrame, out: str = "market") -> DataFrame:
    """Rows whose lookup failed (non-strict mode)."""
    return df.where(F.col(out).isNull())


def allowed(df: DataFrame, allow: DataFrame, market_col: str = "market") -> DataFrame:
    """FLT-04: keep rows of allowed markets (semi join on the allow-list)."""
    a = allow.select(F.col("market").alias("_allowed")).distinct()
    return df.join(a, F.col(market_col) == F.col("_allowed"), "left_semi")


def skipped(df: DataFrame, allow: DataFrame, market_col: str = "market") -> DataFrame:
    """FLT-04 report side: rows of markets outside the allow-list."""
    a = allow.select(F.col("market").alias("_allowed")).distinct()
    return df.join(a, F.col(market_col) == F.col("_allowed"), "left_anti")


def region_pairs(spark: SparkSession, mapping=None) -> DataFrame:
    """FLT-05 as a table of (market, region_id) pairs."""
    mapping = mapping or fixed.REGIONS_BY_MARKET
    rows = [(m, int(r)) for m, regions in mapping.items() for r in regions]
    return literal_table(spark, rows, "market string, region_id int")


def in_market_regions(df: DataFrame, pairs: DataFrame, market_col: str = "market",
                      region_col: str = "region_id") -> DataFrame:
    """FLT-05: keep rows whose region id is in the set of their market."""
    p = pairs.select(F.col("market").alias("_m"), F.col("region_id").alias("_r"))
    cond = (F.col(market_col) == F.col("_m")) & (F.col(region_col) == F.col("_r"))
    return df.join(p, cond, "left_semi")
