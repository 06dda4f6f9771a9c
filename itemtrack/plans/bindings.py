"""Bindings of the driver's test tables to this domain (FIXTURES.md §3).

Each view is one SQL text that both Spark and DuckDB run unchanged, so the Spark
queries and their DuckDB oracles start from identical inputs.  Table references
are written ``{table}``: Spark substitutes DataFrames (``spark.sql`` keyword
arguments), DuckDB the view names.  These are fixtures, not library code.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def pad(expr: str) -> str:
    """STR-01 in portable SQL (lpad alone would cut longer values)."""
    s = f"CAST({expr} AS STRING)"
    return f"CASE WHEN length({s}) < 10 THEN lpad({s}, 10, '0') ELSE {s} END"


def hundredths(expr: str) -> str:
    """A measure as text of whole hundredths (cheap and identical in both engines)."""
    return f"CAST(CAST(round({expr} * 100) AS BIGINT) AS STRING)"


def market_of(expr: str) -> str:
    return (f"CASE {expr} % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'DE' "
            f"WHEN 3 THEN 'JP' ELSE 'AE' END")


VIEWS: dict[str, str] = {}

VIEWS["v_tracker_raw"] = f"""
SELECT
  {pad('o_custkey')} AS item_id,
  {market_of('o_custkey')} AS market,
  o_orderpriority AS target,
  o_orderstatus AS offer_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'refresh' ELSE 'intake' END AS task,
  CASE WHEN o_orderkey % 8 < 4 THEN 'core export' ELSE 'dimension' END AS subtask_type,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'OddShape'
       WHEN 3 THEN 'TooLarge' ELSE 'Others' END AS reason,
  CASE o_orderkey % 4 WHEN 0 THEN 'TP' WHEN 1 THEN 'unblocked' WHEN 2 THEN 'WIP'
       ELSE NULL END AS status,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL
       ELSE concat('req', CAST(o_custkey % 7 AS STRING)) END AS requester,
  CAST(year(o_orderdate) AS INT) AS action_year,
  CAST(o_orderkey % 52 + 1 AS INT) AS action_wk,
  CAST(o_orderdate AS DATE) AS action_date,
  CAST(NULL AS STRING) AS take_action,
  CAST(NULL AS STRING) AS tracker,
  concat('order ', CAST(o_orderkey AS STRING)) AS comment,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '0000-00-00'
       ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS export_text,
  CAST(NULL AS DATE) AS double_check_date,
  CAST(NULL AS STRING) AS login,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'False' WHEN 3 THEN 'False'
       ELSE 'True' END AS has_dimensions,
  CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'True' WHEN 2 THEN 'True'
       ELSE 'False' END AS has_weight,
  o_orderkey AS seq
FROM {{orders}}
"""

# Market codes (sheet order = seq; 'UK' appears twice, the last one wins).
VIEWS["v_codes"] = """
SELECT * FROM (VALUES ('UK', 9, 0), ('US', 1, 1), ('UK', 2, 2), ('DE', 3, 3), ('JP', 4, 4),
                      ('AE', 5, 5)) AS t(market, market_code, seq)
"""

VIEWS["v_allow"] = """
SELECT * FROM (VALUES ('US'), ('UK'), ('DE'), ('JP')) AS t(market)
"""

VIEWS["v_core_export"] = f"""
SELECT
  {pad('o_custkey')} AS item_id,
  CAST(o_custkey % 5 + 1 AS INT) AS market_code,
  CASE WHEN o_orderstatus = 'P' THEN '0000-00-00'
       ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS exportable_date,
  o_orderkey AS seq
FROM {{orders}}
"""

VIEWS["v_inflow"] = f"""
SELECT
  {pad('c_custkey')} AS item_id,
  {market_of('c_custkey + c_nationkey')} AS market,
  CASE c_custkey % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' ELSE '3-MEDIUM' END AS target,
  'F' AS offer_type,
  'intake' AS task,
  'core export' AS subtask_type,
  concat('req', CAST(c_custkey % 7 AS STRING)) AS requester,
  '' AS reason,
  CAST(1998 AS INT) AS action_year,
  CAST('1998-08-02' AS DATE) AS action_date,
  CAST(31 AS INT) AS action_wk,
  c_custkey AS seq
FROM {{customer}}
"""

VIEWS["v_dimensions"] = f"""
SELECT
  {pad('l_partkey')} AS asin,
  CAST(l_orderkey % 5 + 1 AS INT) AS marketplace_id,
  CAST(l_suppkey % 4 AS INT) AS region_id,
  {hundredths('NULLIF(l_quantity, 1)')} AS pkg_length,
  {hundredths('NULLIF(l_discount, 0)')} AS pkg_width,
  {hundredths('NULLIF(l_tax, 0)')} AS pkg_height,
  {hundredths('NULLIF(l_tax, 0.01)')} AS pkg_weight,
  'cm' AS pkg_dimensional_uom,
  'kg' AS pkg_weight_uom,
  {hundredths('l_quantity')} AS item_length,
  {hundredths('l_discount')} AS item_width,
  {hundredths('l_tax')} AS item_height,
  {hundredths('l_extendedprice')} AS item_weight,
  l_orderkey * 8 + l_linenumber AS seq
FROM {{lineitem}}
"""

VIEWS["v_reasons"] = f"""
SELECT
  {pad('doc_id')} AS item_id,
  lang AS market,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS reason_text,
  CASE WHEN doc_id % 10 = 0 THEN 'Other' ELSE 'OperationalRule' END AS contribution,
  doc_id AS seq
FROM {{documents}}
"""

# Keyword rules per market in sheet order; 'es' has none on purpose, one rule has no type
# and the empty keyword is in every text.
VIEWS["v_keywords"] = """
SELECT * FROM (VALUES
  ('en', 1, '@;License', 'Policy'), ('en', 2, 'ein', 'German'), ('en', 3, 'ou', 'Common'),
  ('de', 1, '@;License', 'Policy'), ('de', 2, 'ein', 'German'), ('de', 3, 'ou', 'Common'),
  ('fr', 1, '@;License', 'Policy'), ('fr', 2, 'eau;que', NULL), ('fr', 3, 'ou', 'Common'),
  ('fr', 4, '', 'Any')
) AS t(market, rule_no, keyword, blocker_type)
"""

VIEWS["v_part_reasons"] = f"""
SELECT {pad('p_partkey')} AS item_id, 'US' AS market, p_name AS reason_text,
       'OperationalRule' AS contribution, p_partkey AS seq
FROM {{part}}
"""

VIEWS["v_part_keywords"] = """
SELECT * FROM (VALUES ('US', 1, 'hot', 'Heat'), ('US', 2, 'large;small', 'Size'))
  AS t(market, rule_no, keyword, blocker_type)
"""

# Every event is an observation.  Items group three consecutive events, except
# that every fifth event is an item of its own, so items have 1, 2 or 3 rows.
_OBS_ITEM = ("CASE WHEN event_id % 5 = 0 THEN 1000000000 + event_id "
             "ELSE CAST(floor(event_id / 3) AS BIGINT) END")

VIEWS["v_obs"] = f"""
SELECT
  {pad(_OBS_ITEM)} AS item_id,
  CASE WHEN event_id % 2 = 0 THEN 'US' ELSE 'UK' END AS market,
  CASE event_type
    WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'Others' ELSE 'TooLarge' END
    WHEN 'view' THEN 'No blocker' WHEN 'click' THEN 'TooLarge'
    WHEN 'purchase' THEN 'TooHeavy' WHEN 'signup' THEN 'Battery' ELSE 'Others' END AS new_reason,
  CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS reason_text,
  CASE {_OBS_ITEM} % 5 WHEN 0 THEN 'Others' WHEN 1 THEN 'TooLarge' WHEN 2 THEN 'TooHeavy'
       WHEN 3 THEN '' ELSE NULL END AS reason,
  event_id AS seq
FROM {{events}}
"""

# Raw observation rows as the result files hold them (ids without padding,
# market codes as text).
VIEWS["v_obs_raw"] = f"""
SELECT
  CAST({_OBS_ITEM} AS STRING) AS asin,
  CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2' END AS marketplace_id,
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'Other'
       ELSE 'OperationalRule' END AS contributions,
  CASE WHEN event_type = 'view' THEN NULL
       ELSE concat(event_type, ' limit ', CAST(event_id % 4 AS STRING)) END AS restriction_reasons,
  CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2' END AS country_code,
  event_id AS seq
FROM {{events}}
"""

VIEWS["v_obs_rules"] = """
SELECT * FROM (VALUES
  ('US', 1, 'click', 'TooLarge'), ('US', 2, 'purchase;signup', 'TooHeavy'),
  ('US', 3, 'error', 'TooLarge'), ('UK', 1, 'signup', 'Battery'),
  ('UK', 2, 'click;purchase', 'TooLarge')
) AS t(market, rule_no, keyword, blocker_type)
"""

VIEWS["v_queue"] = f"""
SELECT {pad('c_custkey')} AS item_id,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS market, c_custkey AS seq
FROM {{customer}}
"""

VIEWS["v_quota"] = """
SELECT CAST(s_nationkey AS STRING) AS market, CAST(s_suppkey AS INT) AS slot_no,
       CAST(5 + s_suppkey % 4 AS INT) AS capacity, s_name AS slot_ref
FROM {supplier}
"""

VIEWS["v_jobs"] = """
SELECT
  CAST(CAST(floor(event_id / 4) AS BIGINT) AS STRING) AS market,
  CAST(event_id % 4 AS INT) AS slot_no,
  CASE WHEN event_id % 4 < 2 THEN 'submit' ELSE 'result' END AS phase,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'click' THEN 'Success'
       WHEN 'view' THEN 'Executing' WHEN 'purchase' THEN 'Waiting for Resources'
       ELSE CASE WHEN event_id % 3 = 0 THEN 'Job Deleted' ELSE 'Publishing' END END AS status_text
FROM {events}
"""

# Status rows as they arrive: five daily runs, two jobs a market; the newest run is still before its deadline.
VIEWS["v_job_events"] = """
SELECT CAST(1704067200 + (event_id % 5) * 86400 AS BIGINT) AS run_s,
  CAST(CAST(floor(event_id / 30) AS BIGINT) AS STRING) AS market,
  CAST(CAST(floor(event_id / 5) AS BIGINT) % 2 AS INT) AS slot_no,
  CASE WHEN event_id % 3 = 0 THEN 'submit' ELSE 'result' END AS phase,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'Executing'
       WHEN 'purchase' THEN 'Waiting for Resources' ELSE 'Success' END AS status_text,
  CAST(1704067200 + (event_id % 5) * 86400
       + (event_id * 7919) % (CASE WHEN event_id % 5 = 4 THEN 10000 ELSE 30000 END) AS BIGINT) AS at_s
FROM {events}
"""

# Quota sheet and job table for the tracker markets (dimension refresh, PIP-02).
VIEWS["v_dim_quota"] = f"""
SELECT {market_of('s_suppkey')} AS market, CAST(s_suppkey AS INT) AS slot_no,
       CAST(20 + (s_suppkey % 7) * 10 AS INT) AS capacity, s_name AS slot_ref
FROM {{supplier}}
"""

VIEWS["v_dim_jobs"] = f"""
SELECT {market_of('s_suppkey')} AS market, CAST(s_suppkey AS INT) AS slot_no,
       'result' AS phase,
       CASE WHEN s_suppkey % 37 = 0 THEN 'Error' ELSE 'Success' END AS status_text
FROM {{supplier}}
"""

_TABLE_REF = re.compile(r"\{([a-z_]+)\}")


def referenced_tables(sql: str) -> list[str]:
    return sorted(set(_TABLE_REF.findall(sql)))


def duckdb_sql(name: str) -> str:
    """The view body with plain table names (DuckDB has them registered)."""
    return _TABLE_REF.sub(lambda m: m.group(1), VIEWS[name])


def cte(*names: str) -> str:
    """``WITH`` prefix defining the named binding views for a DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_sql(n)})" for n in names)


def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, with its own scan splits."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The binding view as a Spark DataFrame over the parquet files of ``sf_dir``."""
    sql = VIEWS[name]
    refs = {t: base_table(spark, sf_dir, t) for t in referenced_tables(sql)}
    return spark.sql(sql, **refs) if refs else spark.sql(sql)
