"""Registered queries: one per operator ID of SURVEY §2, each with a DuckDB oracle.

Every query reads the driver's tables through the bindings (or files that Spark
writes from them), over whole tables.  ``QUERIES[id](spark, sf_dir)`` returns a
DataFrame; ``ORACLE[id]`` is the equivalent SQL on the pre-registered views.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from itemtrack import schemas
from itemtrack.functions import scalars as S
from itemtrack.operators import changes, classify as cls, decide as dec, joins, lookups, queues
from itemtrack.operators import quota, report
from itemtrack.operators.jobs import job_gate, job_states
from itemtrack.plans import bindings as B
from itemtrack.plans import refresh as P
from itemtrack.session import scratch_path
from itemtrack.streaming import ingest
from itemtrack.streaming import gate as job_gates
from itemtrack.sources import sinks, tables, tsv
from itemtrack.sources.sinks import VersionedTable
from itemtrack.sources.warehouse import dimension_extract

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

REASON_NAME = "OddShape"          # the binding's name of the dimension-queue reason
REQUESTED = ["US", "UK", "DE", "JP", "AE", "FR"]
TRACKER_COLS = schemas.TRACKER_COLUMNS + ["seq"]


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ inputs --

_PLANS: dict = {}


def _memo(spark, key, build) -> DataFrame:
    """Input DataFrames are built once per session and table folder and then
    reused by every query (a DataFrame is a plan; no data is cached)."""
    k = (spark.sparkContext.applicationId, id(spark), key)
    if k not in _PLANS:
        _PLANS[k] = build()
    return _PLANS[k]


def v(spark, sf, name) -> DataFrame:
    return _memo(spark, (sf, name), lambda: B.view(spark, sf, name))


def tracker(spark, sf) -> DataFrame:
    """T1 over the bindings: zero dates normalised (FLT-06), seq kept."""
    return _memo(spark, (sf, "tracker"),
                 lambda: tables.normalize_tracker(v(spark, sf, "v_tracker_raw")))


def core_export(spark, sf) -> DataFrame:
    return _memo(spark, (sf, "core_export"),
                 lambda: tables.read_core_export(v(spark, sf, "v_core_export")))


def obs_dedup(spark, sf) -> DataFrame:
    return dec.dedup_observations(v(spark, sf, "v_obs"))


# Oracle building blocks (DuckDB).
T_CTE = """v_tracker AS (SELECT * EXCLUDE (export_text), TRY_CAST(export_text AS DATE) AS export_date
                         FROM v_tracker_raw)"""
CE_CTE = """ce AS (SELECT item_id, market_code, TRY_CAST(exportable_date AS DATE) AS exportable_date
                   FROM v_core_export)"""
CM1_CTE = """cm1 AS (SELECT market_code, market FROM (SELECT *, row_number() OVER
              (PARTITION BY market_code ORDER BY seq DESC) AS rn FROM v_codes) WHERE rn = 1)"""
CM2_CTE = """cm2 AS (SELECT market, market_code FROM (SELECT *, row_number() OVER
              (PARTITION BY market ORDER BY seq DESC) AS rn FROM v_codes) WHERE rn = 1)"""
DEDUP_CTE = """dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY item_id,
                market, new_reason, reason_text ORDER BY seq) AS rn FROM v_obs) WHERE rn = 1)"""
TCOLS = ", ".join(TRACKER_COLS)
KEY_NS = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in schemas.TRACKER_KEY)


def with_(*views, extra=()) -> str:
    """WITH clause: binding views, then extra CTE texts."""
    parts = [f"{n} AS ({B.duckdb_sql(n)})" for n in views] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def decide_sql(src: str, mode: str = "as_written") -> str:
    """DuckDB form of RUL-01..04 over relation ``src`` (item_id, market, new_reason,
    reason, seq, ...).  Returns CTE texts ending in relation ``decided``."""
    cleaned = "list_filter(m_reasons, lambda x: x <> 'No blocker')"
    one = ("CASE WHEN {nr} = 'Others' THEN {{o}} WHEN {nr} = 'No blocker' THEN {{u}} "
           "ELSE {{w}} END")

    def single(nr, what):
        vals = {"r": ("'Others'", "reason", nr), "s": ("'nonaction'", "'unblocked'", "'WIP'")}[what]
        return one.format(nr=nr).format(o=vals[0], u=vals[1], w=vals[2])

    def many(what):
        if what == "r":
            return (f"CASE WHEN list_contains(m_reasons, 'Others') THEN 'Others' "
                    f"WHEN len({cleaned}) > 0 THEN array_to_string({cleaned}, ',') ELSE reason END")
        return (f"CASE WHEN list_contains(m_reasons, 'Others') THEN 'nonaction' "
                f"WHEN len({cleaned}) > 0 THEN 'WIP' ELSE 'unblocked' END")

    def last(what):
        if what == "r":
            m = ("CASE WHEN list_contains(last_reasons, 'Others') THEN 'Others' "
                 "ELSE array_to_string(last_reasons, ',') END")
        else:
            m = "CASE WHEN list_contains(last_reasons, 'Others') THEN 'nonaction' ELSE 'WIP' END"
        return f"CASE WHEN last_rows = 1 THEN {single('last_reasons[1]', what)} ELSE {m} END"

    if mode == "as_written":
        pick = {w: (f"CASE WHEN i_rows = 1 THEN {single('new_reason', w)} "
                    f"WHEN i_markets = 1 THEN {many(w)} ELSE {last(w)} END") for w in "rs"}
        rule = ("CASE WHEN i_rows = 1 THEN 'RUL-01' WHEN i_markets = 1 THEN 'RUL-02' "
                "ELSE 'RUL-03' END")
    else:
        pick = {w: f"CASE WHEN m_rows = 1 THEN {single('new_reason', w)} ELSE {many(w)} END"
                for w in "rs"}
        rule = "'RUL-04'"
    return f""",
pr AS (SELECT item_id, market, new_reason, min(seq) AS fs, count(*) AS n FROM {src} GROUP BY ALL),
pm AS (SELECT item_id, market, sum(n) AS m_rows, min(fs) AS m_first,
              list(new_reason ORDER BY fs) AS m_reasons FROM pr GROUP BY ALL),
pi AS (SELECT item_id, sum(m_rows) AS i_rows, count(*) AS i_markets,
              arg_max(m_rows, m_first) AS last_rows, arg_max(m_reasons, m_first) AS last_reasons
       FROM pm GROUP BY ALL),
decided AS (SELECT s.*, {pick['r']} AS next_reason, {pick['s']} AS next_status, {rule} AS rule
            FROM {src} s JOIN pm USING (item_id, market) JOIN pi USING (item_id))
"""


# ============================================================ 2.1 sources ==

@query("SRC_01")
def src_01(spark, sf):
    return tables.scan_tracker(tracker(spark, sf), markets=["US", "DE"],
                               columns=["item_id", "market", "reason", "status", "export_date"],
                               where=F.col("status").isNotNull())


ORACLE["SRC_01"] = with_("v_tracker_raw", extra=[T_CTE]) + """
SELECT item_id, market, reason, status, export_date FROM v_tracker
WHERE market IN ('US', 'DE') AND status IS NOT NULL"""


@query("SRC_02")
def src_02(spark, sf):
    return core_export(spark, sf)


ORACLE["SRC_02"] = with_("v_core_export", extra=[CE_CTE]) + "SELECT * FROM ce"

# Result files written from v_obs_raw with malformed lines by rule:
# seq % 13 = 0 one field too many (dropped), seq % 17 = 0 only three fields
# (padded), seq % 19 = 0 an NA token as reason, seq % 11 = 0 a quoted reason over three
# lines, seq % 23 = 0 followed by an empty line.
def _obs_lines(df: DataFrame) -> DataFrame:
    seq = F.col("seq")
    raw = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in
                              schemas.OBSERVATION_FILE_COLUMNS])
    short = F.concat_ws("\t", "asin", "marketplace_id", "contributions")
    na = F.concat_ws("\t", "asin", "marketplace_id", "contributions", F.lit("N/A"),
                     F.coalesce("country_code", F.lit("")))
    says = F.concat(F.lit('"'), F.coalesce("restriction_reasons", F.lit("")), F.lit('\nsays ""'), "asin", F.lit('""\n"'))
    long = F.concat_ws("\t", "asin", "marketplace_id", "contributions", says, "country_code")
    line = (F.when(seq % 13 == 0, F.concat(raw, F.lit("\textra"))).when(seq % 17 == 0, short)
            .when(seq % 19 == 0, na).when(seq % 11 == 0, long).otherwise(raw))
    line = F.when(seq % 23 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
    return df.withColumn("_line", line)


def _write_obs_files(spark, sf, folder_col, file_expr):
    root = scratch_path(spark, "results")
    df = _obs_lines(v(spark, sf, "v_obs_raw")).withColumn("_folder", folder_col) \
        .withColumn("_fileno", file_expr)
    sinks.write_result_files(df, root, schemas.OBSERVATION_FILE_COLUMNS, folder_col="_folder",
                             file_col="_fileno", order_col="seq", line_col="_line")
    return root


_READ_BACK = ["asin", "marketplace_id", "contributions", "restriction_reasons", "country_code"]
_EXPECT_ROWS = """rows AS (SELECT asin, marketplace_id, contributions,
  CASE WHEN seq % 17 = 0 OR seq % 19 = 0 THEN NULL
       WHEN seq % 11 = 0 THEN concat(coalesce(restriction_reasons, ''), chr(10), 'says "', asin, '"', chr(10))
       ELSE restriction_reasons END AS restriction_reasons,
  CASE WHEN seq % 17 = 0 THEN NULL ELSE country_code END AS country_code, seq
  FROM v_obs_raw WHERE seq % 13 <> 0)"""


@query("SRC_03")
def src_03(spark, sf):
    root = _write_obs_files(spark, sf, F.col("marketplace_id"), F.col("seq") % 3)
    return tsv.read_tolerant_tsv(spark, root, schemas.OBSERVATION_FILE_COLUMNS,
                                 recursiveFileLookup="true") \
        .select(*_READ_BACK)


ORACLE["SRC_03"] = with_("v_obs_raw", extra=[_EXPECT_ROWS]) + \
    f"SELECT {', '.join(_READ_BACK)} FROM rows"


@query("SRC_04")
def src_04(spark, sf):
    root = _write_obs_files(spark, sf, F.col("marketplace_id"), F.col("seq") % 3)
    day = _dt.datetime.now(_dt.timezone.utc).date()
    found = tsv.discover_result_files(spark, root, schemas.OBSERVATION_FILE_COLUMNS,
                                      passed_markets=["1"], day=day)
    return found.select("market", *_READ_BACK)


ORACLE["SRC_04"] = with_("v_obs_raw", extra=[_EXPECT_ROWS]) + \
    f"SELECT '1' AS market, {', '.join(_READ_BACK)} FROM rows WHERE marketplace_id = '1'"


@query("SRC_05")
def src_05(spark, sf):
    root = _write_obs_files(spark, sf, F.lit("inbox"), F.col("seq") % 4)
    rows = tsv.read_tolerant_tsv(spark, root, schemas.OBSERVATION_FILE_COLUMNS,
                                 recursiveFileLookup="true")
    routed = tsv.route_by_first_row(rows, v(spark, sf, "v_codes"))
    return routed.select(*_READ_BACK, "routed_market")


ORACLE["SRC_05"] = with_("v_obs_raw", "v_codes", extra=[_EXPECT_ROWS, CM1_CTE, """
firsts AS (SELECT seq % 4 AS f, country_code AS code FROM (SELECT *, row_number() OVER
           (PARTITION BY seq % 4 ORDER BY seq) AS rn FROM rows) WHERE rn = 1)"""]) + f"""
SELECT {', '.join('r.' + c for c in _READ_BACK)}, cm1.market AS routed_market
FROM rows r JOIN firsts ON r.seq % 4 = firsts.f
LEFT JOIN cm1 ON CAST(cm1.market_code AS STRING) = firsts.code"""

_REGIONS_SQL = """regions AS (SELECT * FROM (VALUES ('US', 1), ('UK', 1), ('UK', 2), ('UK', 3),
  ('DE', 1), ('DE', 2), ('DE', 3), ('JP', 1), ('JP', 2), ('JP', 3), ('AE', 1), ('AE', 2),
  ('AE', 3)) AS t(market, region_id))"""
_DIM_COLS = ", ".join("d." + c for c in schemas.DIMENSION_FILE_COLUMNS)


@query("SRC_06")
def src_06(spark, sf):
    batch = queues.dimension_queue(tracker(spark, sf), REASON_NAME)
    return dimension_extract(v(spark, sf, "v_dimensions"), batch, v(spark, sf, "v_codes"),
                             lookups.region_pairs(spark)).drop("seq")


ORACLE["SRC_06"] = with_("v_tracker_raw", "v_dimensions", "v_codes",
                         extra=[T_CTE, CM2_CTE, _REGIONS_SQL, f"""
q AS (SELECT item_id, market FROM v_tracker WHERE (reason IS NULL OR reason IN ('{REASON_NAME}', ''))
      AND (status NOT IN ('TP', 'unblocked') OR status IS NULL)
      AND (has_dimensions <> 'True' OR has_dimensions IS NULL OR has_weight <> 'True'
           OR has_weight IS NULL))"""]) + f"""
SELECT {_DIM_COLS} FROM v_dimensions d
WHERE EXISTS (SELECT 1 FROM regions r JOIN cm2 USING (market)
              WHERE cm2.market_code = d.marketplace_id AND r.region_id = d.region_id)
  AND EXISTS (SELECT 1 FROM q JOIN cm2 USING (market)
              WHERE q.item_id = d.asin AND cm2.market_code = d.marketplace_id)"""


@query("SRC_07")
def src_07(spark, sf):
    path = scratch_path(spark, "quota-sheet")
    (v(spark, sf, "v_quota").orderBy("slot_no").select("market", "capacity", "slot_ref")
     .write.option("header", True).csv(path))
    schema = "market string, capacity int, slot_ref string"
    sheet = tables.read_lookup(spark, path, schema, order_col="sheet_pos")
    numbered = tables.number_rows(sheet, "slot_no", partition=["market"], order=["sheet_pos"])
    return numbered.select("market", "slot_no", "capacity", "slot_ref")


ORACLE["SRC_07"] = with_("v_quota") + """
SELECT market, CAST(row_number() OVER (PARTITION BY market ORDER BY slot_no) AS INT) AS slot_no,
       capacity, slot_ref FROM v_quota"""


@query("SNK_01")
def snk_01(spark, sf):
    q = lookups.attach_code(queues.status_queue(tracker(spark, sf)), v(spark, sf, "v_codes"))
    path = scratch_path(spark, "queue-snapshot")
    sinks.write_snapshot(q.select("item_id", "market_code"), path, partition_by="market_code")
    return spark.read.parquet(path).select("item_id", "market_code")


ORACLE["SNK_01"] = with_("v_tracker_raw", "v_codes", extra=[T_CTE, CM2_CTE]) + """
SELECT t.item_id, cm2.market_code FROM v_tracker t LEFT JOIN cm2 USING (market)
WHERE (status NOT IN ('TP', 'unblocked') OR status IS NULL) AND export_date IS NULL"""

# ========================================================== 2.2 filters ====


@query("FLT_01")
def flt_01(spark, sf):
    return queues.export_date_queue(tracker(spark, sf))


ORACLE["FLT_01"] = with_("v_tracker_raw", extra=[T_CTE]) + \
    "SELECT item_id, market FROM v_tracker WHERE export_date IS NULL"


@query("FLT_02")
def flt_02(spark, sf):
    return queues.status_queue(tracker(spark, sf))


ORACLE["FLT_02"] = with_("v_tracker_raw", extra=[T_CTE]) + """
SELECT item_id, market FROM v_tracker
WHERE (status NOT IN ('TP', 'unblocked') OR status IS NULL) AND export_date IS NULL"""


@query("FLT_03")
def flt_03(spark, sf):
    return queues.dimension_queue(tracker(spark, sf), REASON_NAME)


ORACLE["FLT_03"] = with_("v_tracker_raw", extra=[T_CTE]) + f"""
SELECT item_id, market FROM v_tracker
WHERE (reason IS NULL OR reason IN ('{REASON_NAME}', ''))
  AND (status NOT IN ('TP', 'unblocked') OR status IS NULL)
  AND (has_dimensions <> 'True' OR has_dimensions IS NULL OR has_weight <> 'True' OR has_weight IS NULL)"""


@query("FLT_04")
def flt_04(spark, sf):
    t = tracker(spark, sf).select("item_id", "market", "seq")
    allow = v(spark, sf, "v_allow")
    return changes.union_by_name(
        lookups.allowed(t, allow).withColumn("allowed", F.lit(True)),
        lookups.skipped(t, allow).withColumn("allowed", F.lit(False)))


ORACLE["FLT_04"] = with_("v_tracker_raw", "v_allow", extra=[T_CTE]) + """
SELECT item_id, market, seq, market IN (SELECT market FROM v_allow) AS allowed FROM v_tracker"""


@query("FLT_05")
def flt_05(spark, sf):
    d = v(spark, sf, "v_dimensions").select("asin", "marketplace_id", "region_id")
    d = lookups.attach_market(d, v(spark, sf, "v_codes"), "marketplace_id")
    return lookups.in_market_regions(d, lookups.region_pairs(spark))


ORACLE["FLT_05"] = with_("v_dimensions", "v_codes", extra=[CM1_CTE, _REGIONS_SQL]) + """
SELECT d.asin, d.marketplace_id, d.region_id, cm1.market FROM v_dimensions d
JOIN cm1 ON cm1.market_code = d.marketplace_id
WHERE EXISTS (SELECT 1 FROM regions r WHERE r.market = cm1.market AND r.region_id = d.region_id)"""


@query("FLT_06")
def flt_06(spark, sf):
    return v(spark, sf, "v_tracker_raw").select(
        "item_id", "market", "seq", "export_text",
        S.zero_date_to_null("export_text").alias("export_date"))


ORACLE["FLT_06"] = with_("v_tracker_raw") + """
SELECT item_id, market, seq, export_text, TRY_CAST(export_text AS DATE) AS export_date
FROM v_tracker_raw"""


@query("PRJ_01")
def prj_01(spark, sf):
    df = queues.rename(v(spark, sf, "v_obs_raw"), {
        "asin": "item_id", "marketplace_id": "market_code_text", "contributions": "contribution",
        "restriction_reasons": "reason_text"})
    return df.select("seq", "market_code_text", "item_id", "contribution", "reason_text")


ORACLE["PRJ_01"] = with_("v_obs_raw") + """
SELECT seq, marketplace_id AS market_code_text, asin AS item_id, contributions AS contribution,
       restriction_reasons AS reason_text FROM v_obs_raw"""


@query("PRJ_02")
def prj_02(spark, sf):
    return S.fill_empty(v(spark, sf, "v_obs_raw"))


ORACLE["PRJ_02"] = with_("v_obs_raw") + """
SELECT coalesce(asin, '') AS asin, coalesce(marketplace_id, '') AS marketplace_id,
       coalesce(contributions, '') AS contributions,
       coalesce(restriction_reasons, '') AS restriction_reasons,
       coalesce(country_code, '') AS country_code, seq FROM v_obs_raw"""


@query("PRJ_03")
def prj_03(spark, sf):
    d = v(spark, sf, "v_dimensions").select("asin", "marketplace_id", "seq")
    return queues.add_placeholders(d, {"has_weight": "", "has_dimensions": "", "new_reason": None})


ORACLE["PRJ_03"] = with_("v_dimensions") + """
SELECT asin, marketplace_id, seq, '' AS has_weight, '' AS has_dimensions,
       CAST(NULL AS VARCHAR) AS new_reason FROM v_dimensions"""

# ============================================================ 2.3 joins ====


@query("JON_01")
def jon_01(spark, sf):
    return joins.inflow_lookup(tracker(spark, sf), v(spark, sf, "v_inflow"))


ORACLE["JON_01"] = with_("v_tracker_raw", "v_inflow", extra=[T_CTE]) + """
SELECT t.item_id, t.market FROM v_tracker t
WHERE EXISTS (SELECT 1 FROM v_inflow i WHERE i.item_id = t.item_id AND i.market = t.market)"""


@query("JON_02")
def jon_02(spark, sf):
    return joins.status_lookup(tracker(spark, sf), v(spark, sf, "v_obs"))


ORACLE["JON_02"] = with_("v_tracker_raw", "v_obs", extra=[T_CTE]) + """
SELECT t.item_id, t.market, t.reason, t.status FROM v_tracker t
WHERE EXISTS (SELECT 1 FROM v_obs o WHERE o.item_id = t.item_id AND o.market = t.market)"""


def _export_queue(spark, sf):
    q = queues.export_date_queue(tracker(spark, sf))
    return lookups.attach_code(q, v(spark, sf, "v_codes"), strict=True)


_EXPORT_JOIN = [T_CTE, CE_CTE, CM2_CTE, """
q AS (SELECT t.item_id, t.market, cm2.market_code FROM v_tracker t JOIN cm2 USING (market)
      WHERE t.export_date IS NULL)""", """
r AS (SELECT * FROM (SELECT ce.*, row_number() OVER (PARTITION BY item_id, market_code
        ORDER BY exportable_date DESC, market_code) AS rn FROM ce
      WHERE exportable_date IS NOT NULL AND EXISTS (SELECT 1 FROM q WHERE q.item_id = ce.item_id
        AND q.market_code = ce.market_code)) WHERE rn = 1)"""]


@query("JON_03")
def jon_03(spark, sf):
    q = _export_queue(spark, sf)
    latest = joins.latest_export(core_export(spark, sf), keys=q, by=("item_id", "market_code"))
    return joins.queue_with_latest(q, latest)


ORACLE["JON_03"] = with_("v_tracker_raw", "v_core_export", "v_codes", extra=_EXPORT_JOIN) + """
SELECT q.item_id, q.market_code, q.market, r.exportable_date FROM q JOIN r USING (item_id, market_code)"""


@query("JON_04")
def jon_04(spark, sf):
    o = v(spark, sf, "v_obs").drop("reason")
    state = tracker(spark, sf).select("item_id", "market", "reason", "status")
    return joins.attach_state(o, state)


ORACLE["JON_04"] = with_("v_obs", "v_tracker_raw", extra=[T_CTE]) + """
SELECT o.item_id, o.market, o.new_reason, o.reason_text, o.seq, t.reason, t.status
FROM v_obs o LEFT JOIN v_tracker t USING (item_id, market)"""


@query("JON_05")
def jon_05(spark, sf):
    ce = core_export(spark, sf)
    codes = v(spark, sf, "v_codes")
    named = lookups.attach_market(ce, codes, "market_code")
    return lookups.attach_code(named.withColumnRenamed("market_code", "code_in"), codes)


ORACLE["JON_05"] = with_("v_core_export", "v_codes", extra=[CE_CTE, CM1_CTE, CM2_CTE]) + """
SELECT ce.item_id, ce.market_code AS code_in, ce.exportable_date, cm1.market, cm2.market_code
FROM ce LEFT JOIN cm1 USING (market_code) LEFT JOIN cm2 ON cm2.market = cm1.market"""


@query("JON_06")
def jon_06(spark, sf):
    out = cls.classify(v(spark, sf, "v_reasons"), v(spark, sf, "v_keywords"))
    return out.select("item_id", "market", "contribution", "seq", "new_reason")


_CLASSIFY_SQL = """
hit AS (SELECT r.seq, min(k.rule_no) AS rule_no FROM {src} r JOIN {rules} k ON k.market = r.market
        WHERE len(list_filter(string_split(k.keyword, ';'),
                              lambda x: contains(coalesce(r.reason_text, ''), x))) > 0
        GROUP BY r.seq),
typ AS (SELECT hit.seq, k.blocker_type FROM hit JOIN {src} r USING (seq)
        JOIN {rules} k ON k.market = r.market AND k.rule_no = hit.rule_no),
classified AS (SELECT r.*, CASE
   WHEN coalesce(r.contribution, '') = 'OperationalRule' AND coalesce(r.reason_text, '') <> ''
     THEN CASE WHEN typ.seq IS NULL THEN 'Others' ELSE typ.blocker_type END
   WHEN coalesce(r.contribution, '') = 'OperationalRule' THEN 'No blocker'
   ELSE 'Others' END AS new_reason
   FROM {src} r LEFT JOIN typ USING (seq))"""

ORACLE["JON_06"] = with_("v_reasons", "v_keywords",
                         extra=[_CLASSIFY_SQL.format(src="v_reasons", rules="v_keywords")]) + \
    "SELECT item_id, market, contribution, seq, new_reason FROM classified"


@query("JON_07")
def jon_07(spark, sf):
    items = queues.dimension_queue(tracker(spark, sf), REASON_NAME).select(
        F.col("item_id").alias("asin"))
    return joins.restrict_to_keys(v(spark, sf, "v_dimensions"), items, on=["asin"]) \
        .select("asin", "marketplace_id", "seq")


ORACLE["JON_07"] = with_("v_tracker_raw", "v_dimensions", extra=[T_CTE]) + f"""
SELECT d.asin, d.marketplace_id, d.seq FROM v_dimensions d WHERE EXISTS (
  SELECT 1 FROM v_tracker t WHERE t.item_id = d.asin
  AND (reason IS NULL OR reason IN ('{REASON_NAME}', ''))
  AND (status NOT IN ('TP', 'unblocked') OR status IS NULL)
  AND (has_dimensions <> 'True' OR has_dimensions IS NULL OR has_weight <> 'True'
       OR has_weight IS NULL))"""

# ====================================================== 2.4 aggregations ===


@query("AGG_01")
def agg_01(spark, sf):
    q = lookups.attach_code(queues.status_queue(tracker(spark, sf)), v(spark, sf, "v_codes"))
    return report.items_per_code(q)


ORACLE["AGG_01"] = with_("v_tracker_raw", "v_codes", extra=[T_CTE, CM2_CTE]) + """
SELECT cm2.market_code, count(t.item_id) AS counts FROM v_tracker t JOIN cm2 USING (market)
WHERE (status NOT IN ('TP', 'unblocked') OR status IS NULL) AND export_date IS NULL
GROUP BY cm2.market_code ORDER BY 1"""

_REQ_SQL = "req AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}')" for m in REQUESTED) + \
    ") AS t(market))"


@query("AGG_02")
def agg_02(spark, sf):
    q = queues.export_date_queue(tracker(spark, sf))
    return report.rows_per_requested_market(q, report.requested_markets(spark, REQUESTED))


ORACLE["AGG_02"] = with_("v_tracker_raw", extra=[T_CTE, _REQ_SQL]) + """
SELECT req.market, coalesce(c.n, 0) AS rows FROM req LEFT JOIN
  (SELECT market, count(*) AS n FROM v_tracker WHERE export_date IS NULL GROUP BY market) c
  USING (market)"""


@query("AGG_03")
def agg_03(spark, sf):
    return report.distinct_keys(queues.export_date_queue(tracker(spark, sf)))


ORACLE["AGG_03"] = with_("v_tracker_raw", extra=[T_CTE]) + \
    "SELECT DISTINCT item_id, market FROM v_tracker WHERE export_date IS NULL"


@query("AGG_04")
def agg_04(spark, sf):
    return obs_dedup(spark, sf)


ORACLE["AGG_04"] = with_("v_obs", extra=[DEDUP_CTE]) + "SELECT * FROM dd"


@query("AGG_05")
def agg_05(spark, sf):
    return dec.reason_lists(v(spark, sf, "v_obs"))


ORACLE["AGG_05"] = with_("v_obs") + """
SELECT item_id, market, string_agg(new_reason, ',' ORDER BY fs) AS reasons FROM
  (SELECT item_id, market, new_reason, min(seq) AS fs FROM v_obs GROUP BY ALL) GROUP BY ALL"""

_JOB_STATE = """CASE WHEN phase = 'submit' THEN (CASE
    WHEN coalesce(status_text, '') = 'Waiting for Resources' THEN 'ok'
    WHEN contains(coalesce(status_text, ''), 'Executing') THEN 'ok'
    WHEN contains(coalesce(status_text, ''), 'Deleted') THEN 'failed'
    WHEN contains(coalesce(status_text, ''), 'Success') THEN 'ok'
    WHEN contains(coalesce(status_text, ''), 'Error') THEN 'failed'
    WHEN contains(coalesce(status_text, ''), 'Publishing') THEN 'ok' ELSE 'waiting' END)
  ELSE (CASE WHEN contains(coalesce(status_text, ''), 'Success') THEN 'ok'
    WHEN contains(coalesce(status_text, ''), 'Error') THEN 'failed'
    WHEN contains(coalesce(status_text, ''), 'Deleted') THEN 'failed' ELSE 'pending' END) END"""


@query("AGG_06")
def agg_06(spark, sf):
    return job_gate(v(spark, sf, "v_jobs"))


ORACLE["AGG_06"] = with_("v_jobs", extra=[f"s AS (SELECT *, {_JOB_STATE} AS state FROM v_jobs)"]) + """
SELECT market, count(*) AS jobs, CASE WHEN bool_or(state = 'failed') THEN 'failed'
  WHEN bool_and(state = 'ok') THEN 'passed' ELSE 'pending' END AS gate FROM s GROUP BY market"""


def _pip01(spark, sf, markets=None):
    return P.refresh_export_dates(tracker(spark, sf), core_export(spark, sf),
                                  v(spark, sf, "v_codes"), v(spark, sf, "v_allow"),
                                  markets=markets)


_PIP01_SQL = [T_CTE, CE_CTE, CM2_CTE, """
q AS (SELECT t.item_id, t.market, cm2.market_code FROM v_tracker t JOIN cm2 USING (market)
      WHERE t.export_date IS NULL AND t.market IN (SELECT market FROM v_allow))""", """
r AS (SELECT * FROM (SELECT ce.*, row_number() OVER (PARTITION BY item_id, market_code
        ORDER BY exportable_date DESC, market_code) AS rn FROM ce
      WHERE exportable_date IS NOT NULL AND EXISTS (SELECT 1 FROM q WHERE q.item_id = ce.item_id
        AND q.market_code = ce.market_code)) WHERE rn = 1)""", """
upd AS (SELECT q.item_id, q.market, r.exportable_date AS export_date FROM q
        JOIN r USING (item_id, market_code))"""]


@query("AGG_07")
def agg_07(spark, sf):
    return _pip01(spark, sf, REQUESTED)["report"]


ORACLE["AGG_07"] = with_("v_tracker_raw", "v_core_export", "v_codes", "v_allow",
                         extra=_PIP01_SQL + [_REQ_SQL]) + """
SELECT req.market,
  (req.market IN (SELECT market FROM v_allow)
   AND coalesce((SELECT count(*) FROM q WHERE q.market = req.market), 0) > 0) AS updated,
  coalesce((SELECT count(*) FROM upd WHERE upd.market = req.market), 0) AS rows_updated
FROM req"""


@query("AGG_08")
def agg_08(spark, sf):
    return report.updated_items_per_market(_pip01(spark, sf)["updates"])


ORACLE["AGG_08"] = with_("v_tracker_raw", "v_core_export", "v_codes", "v_allow",
                         extra=_PIP01_SQL) + """
SELECT market, count(DISTINCT item_id) AS items_updated FROM upd GROUP BY market"""

# ========================================================== 2.5 windows ====


@query("WIN_01")
def win_01(spark, sf):
    return joins.latest_export(core_export(spark, sf))


ORACLE["WIN_01"] = with_("v_core_export", extra=[CE_CTE]) + """
SELECT item_id, market_code, exportable_date FROM (SELECT *, row_number() OVER
  (PARTITION BY item_id ORDER BY exportable_date DESC, market_code) AS rn FROM ce
  WHERE exportable_date IS NOT NULL) WHERE rn = 1"""


@query("WIN_02")
def win_02(spark, sf):
    return dec.rows_per_item(obs_dedup(spark, sf))


ORACLE["WIN_02"] = with_("v_obs", extra=[DEDUP_CTE]) + \
    "SELECT *, count(*) OVER (PARTITION BY item_id) AS item_rows FROM dd"


@query("WIN_03")
def win_03(spark, sf):
    return dec.markets_per_item(obs_dedup(spark, sf))


ORACLE["WIN_03"] = with_("v_obs", extra=[DEDUP_CTE]) + """
SELECT dd.*, m.item_markets FROM dd JOIN
  (SELECT item_id, count(DISTINCT market) AS item_markets FROM dd GROUP BY item_id) m
  USING (item_id)"""


@query("WIN_04")
def win_04(spark, sf):
    return dec.rows_per_item_market(obs_dedup(spark, sf))


ORACLE["WIN_04"] = with_("v_obs", extra=[DEDUP_CTE]) + \
    "SELECT *, count(*) OVER (PARTITION BY item_id, market) AS market_rows FROM dd"


@query("WIN_05")
def win_05(spark, sf):
    return dec.last_market(obs_dedup(spark, sf))


ORACLE["WIN_05"] = with_("v_obs", extra=[DEDUP_CTE]) + """
SELECT item_id, arg_max(market, fs) AS last_market FROM
  (SELECT item_id, market, min(seq) AS fs FROM dd GROUP BY ALL) GROUP BY item_id"""


@query("WIN_06")
def win_06(spark, sf):
    assigned, unassigned = quota.plan_batches(v(spark, sf, "v_queue"), v(spark, sf, "v_quota"))
    return changes.union_by_name(assigned, unassigned)


ORACLE["WIN_06"] = with_("v_queue", "v_quota") + """,
q AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY seq, item_id) AS position
      FROM v_queue),
s AS (SELECT market, slot_no, slot_ref, greatest(capacity, 0) AS cap,
        sum(greatest(capacity, 0)) OVER (PARTITION BY market ORDER BY slot_no
                                         ROWS UNBOUNDED PRECEDING) AS hi FROM v_quota)
SELECT q.item_id, q.market, q.seq, q.position, s.slot_no, s.slot_ref FROM q
LEFT JOIN s ON q.market = s.market AND q.position > s.hi - s.cap AND q.position <= s.hi"""



@query("TOP_02")
def top_02(spark, sf):
    return quota.first_n_per_market(v(spark, sf, "v_queue"), 20).select("item_id", "market", "seq", "position")


ORACLE["TOP_02"] = with_("v_queue") + """
SELECT * FROM (SELECT item_id, market, seq, row_number() OVER (PARTITION BY market ORDER BY seq, item_id)
               AS position FROM v_queue) WHERE position <= 20"""

# ========================================================== 2.7 sets =======


@query("SET_01")
def set_01(spark, sf):
    a = tracker(spark, sf).select("item_id", "market", "reason", "seq")
    b = v(spark, sf, "v_inflow").select("item_id", "market", "target", "seq")
    return changes.union_by_name(a, b)


ORACLE["SET_01"] = with_("v_tracker_raw", "v_inflow", extra=[T_CTE]) + """
SELECT item_id, market, reason, seq FROM v_tracker
UNION ALL BY NAME SELECT item_id, market, target, seq FROM v_inflow"""


@query("SET_02")
def set_02(spark, sf):
    return changes.keyed_difference(tracker(spark, sf), v(spark, sf, "v_inflow"))


ORACLE["SET_02"] = with_("v_tracker_raw", "v_inflow", extra=[T_CTE]) + f"""
SELECT {TCOLS} FROM v_tracker t WHERE NOT EXISTS (SELECT 1 FROM v_inflow i
  WHERE i.item_id = t.item_id AND i.market = t.market AND i.target = t.target)"""

# ========================================================== 2.8 scalars ====


@query("STR_01")
def str_01(spark, sf):
    return v(spark, sf, "v_obs_raw").select("seq", "asin", S.zfill("asin").alias("item_id"))


ORACLE["STR_01"] = with_("v_obs_raw") + """
SELECT seq, asin, CASE WHEN length(asin) >= 10 THEN asin ELSE lpad(asin, 10, '0') END AS item_id
FROM v_obs_raw"""


@query("STR_02")
def str_02(spark, sf):
    return tracker(spark, sf).select("seq", S.composite_key("item_id", "market").alias("key"))


ORACLE["STR_02"] = with_("v_tracker_raw") + \
    "SELECT seq, concat(item_id, market) AS key FROM v_tracker_raw"


@query("STR_03")
def str_03(spark, sf):
    return v(spark, sf, "v_part_reasons").select(
        "seq", S.contains_any("reason_text", F.lit("large;small")).alias("size_hit"),
        S.contains_any("reason_text", F.lit("hot")).alias("heat_hit"))


ORACLE["STR_03"] = with_("v_part_reasons") + """
SELECT seq, len(list_filter(string_split('large;small', ';'), lambda x: contains(reason_text, x))) > 0
         AS size_hit,
       len(list_filter(string_split('hot', ';'), lambda x: contains(reason_text, x))) > 0 AS heat_hit
FROM v_part_reasons"""


@query("STR_04")
def str_04(spark, sf):
    return dec.reason_lists(v(spark, sf, "v_obs"), keys=["item_id"])


ORACLE["STR_04"] = with_("v_obs") + """
SELECT item_id, string_agg(new_reason, ',' ORDER BY fs) AS reasons FROM
  (SELECT item_id, new_reason, min(seq) AS fs FROM v_obs GROUP BY ALL) GROUP BY ALL"""


@query("DAT_01")
def dat_01(spark, sf):
    d = tracker(spark, sf).select("action_date").distinct()
    return d.select("action_date",
                    S.run_date("two_days_ago", F.col("action_date")).alias("two_days_ago"),
                    S.run_date("tuesday", F.col("action_date")).alias("tuesday"),
                    S.run_date("sunday", F.col("action_date")).alias("sunday"),
                    S.run_date("manual", manual="20210312").alias("manual"))


ORACLE["DAT_01"] = with_("v_tracker_raw") + """
SELECT action_date, strftime(action_date - 2, '%Y/%m/%d') AS two_days_ago,
  strftime(action_date - CAST((dayofweek(action_date) + 5) % 7 AS INTEGER), '%Y/%m/%d') AS tuesday,
  strftime(action_date - CAST((dayofweek(action_date) + 5) % 7 AS INTEGER) - 2, '%Y/%m/%d') AS sunday,
  '2021/03/12' AS manual
FROM (SELECT DISTINCT action_date FROM v_tracker_raw)"""


@query("DAT_02")
def dat_02(spark, sf):
    t = tracker(spark, sf).where(F.col("export_date").isNotNull())
    return t.select("seq", S.iso_date_text("export_date").alias("export_date_text"))


ORACLE["DAT_02"] = with_("v_tracker_raw", extra=[T_CTE]) + """
SELECT seq, strftime(export_date, '%Y-%m-%d') AS export_date_text FROM v_tracker
WHERE export_date IS NOT NULL"""


@query("CST_01")
def cst_01(spark, sf):
    o = v(spark, sf, "v_obs_raw")
    code = S.text_to_code("marketplace_id")
    return o.select("seq", code.alias("market_code"), S.code_to_text(code).alias("code_text"))


ORACLE["CST_01"] = with_("v_obs_raw") + """
SELECT seq, CAST(marketplace_id AS INTEGER) AS market_code,
       CAST(CAST(marketplace_id AS INTEGER) AS VARCHAR) AS code_text FROM v_obs_raw"""


@query("CMP_01")
def cmp_01(spark, sf):
    d = S.fill_empty(v(spark, sf, "v_dimensions"))
    return S.completeness_flags(d).select("seq", "asin", "has_dimensions", "has_weight")


ORACLE["CMP_01"] = with_("v_dimensions") + """
SELECT seq, asin,
  CASE WHEN coalesce(pkg_height, '') <> '' AND coalesce(pkg_length, '') <> ''
            AND coalesce(pkg_width, '') <> '' THEN 'True' ELSE 'False' END AS has_dimensions,
  CASE WHEN coalesce(pkg_weight, '') <> '' THEN 'True' ELSE 'False' END AS has_weight
FROM v_dimensions"""


@query("JST_01")
def jst_01(spark, sf):
    return job_states(v(spark, sf, "v_jobs"))


ORACLE["JST_01"] = with_("v_jobs") + f"SELECT *, {_JOB_STATE} AS state FROM v_jobs"

# ===================================================== 2.9 decision rules ==

_RUL_COLS = ["item_id", "market", "new_reason", "reason_text", "reason", "seq",
             "next_reason", "next_status", "rule"]


def _decided(spark, sf, mode):
    return dec.decide(obs_dedup(spark, sf), mode=mode).select(*_RUL_COLS)


for _i, _rule in ((1, "RUL-01"), (2, "RUL-02"), (3, "RUL-03")):
    def _q(spark, sf, _rule=_rule):
        return _decided(spark, sf, dec.AS_WRITTEN).where(F.col("rule") == _rule)
    QUERIES[f"RUL_0{_i}"] = _q
    ORACLE[f"RUL_0{_i}"] = with_("v_obs", extra=[DEDUP_CTE]) + decide_sql("dd") + \
        f"SELECT {', '.join(_RUL_COLS)} FROM decided WHERE rule = '{_rule}'"


@query("RUL_04")
def rul_04(spark, sf):
    return _decided(spark, sf, dec.PER_MARKET)


ORACLE["RUL_04"] = with_("v_obs", extra=[DEDUP_CTE]) + decide_sql("dd", "per_market") + \
    f"SELECT {', '.join(_RUL_COLS)} FROM decided"

# ==================================================== 2.10 keyed changes ===


def _existing(spark, sf):
    return tracker(spark, sf)


def _incoming(spark, sf):
    """Every tracker row again, twice with different comments; odd rows moved one
    day later, so half of the keys exist and half are new."""
    t = tracker(spark, sf).withColumn(
        "action_date", F.date_add("action_date", (F.col("seq") % 2).cast("int")))
    first = t.withColumn("comment", F.lit("first")).withColumn("seq", F.col("seq") * 2)
    second = t.withColumn("comment", F.lit("second")).withColumn("seq", F.col("seq") * 2 + 1)
    return first.unionByName(second)


_NEW_ROWS_SQL = [T_CTE, "ex AS (SELECT * FROM v_tracker)", """
moved AS (SELECT * REPLACE (action_date + CAST(seq % 2 AS INTEGER) AS action_date) FROM v_tracker)""",
                 """
inc AS (SELECT * REPLACE ('first' AS comment, seq * 2 AS seq) FROM moved
        UNION ALL
        SELECT * REPLACE ('second' AS comment, seq * 2 + 1 AS seq) FROM moved)""", """
inc1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY
         """ + ", ".join(schemas.TRACKER_KEY) + """ ORDER BY seq) AS rn FROM inc) WHERE rn = 1)"""]


def _insert_sql(table: str, incoming: str, cols: str = TCOLS) -> str:
    return f"""SELECT {cols} FROM {table} UNION ALL
SELECT {cols} FROM {incoming} b WHERE NOT EXISTS (SELECT 1 FROM {table} a WHERE {KEY_NS})"""


@query("DML_01")
def dml_01(spark, sf):
    return changes.insert_if_absent(_existing(spark, sf), _incoming(spark, sf))


ORACLE["DML_01"] = with_("v_tracker_raw", extra=_NEW_ROWS_SQL) + _insert_sql("ex", "inc1")


@query("DML_02")
def dml_02(spark, sf):
    history = tracker(spark, sf).where(F.col("status") == "unblocked")
    return changes.insert_if_absent(history, _incoming(spark, sf))


ORACLE["DML_02"] = with_("v_tracker_raw", extra=_NEW_ROWS_SQL + [
    "hist AS (SELECT * FROM v_tracker WHERE status = 'unblocked')"]) + _insert_sql("hist", "inc1")


@query("DML_03")
def dml_03(spark, sf):
    return changes.insert_new_inflow(tracker(spark, sf), v(spark, sf, "v_inflow"))


def _partial_sql(cols):
    listed = ", ".join(cols + ["seq"])
    filled = ", ".join(c if c in cols + ["seq"] else f"NULL AS {c}" for c in TRACKER_COLS)
    return f"""
infl AS (SELECT {filled} FROM (SELECT {listed} FROM {{src}})),
infl1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY
          {", ".join(schemas.TRACKER_KEY)} ORDER BY seq) AS rn FROM infl) WHERE rn = 1)"""


ORACLE["DML_03"] = with_("v_tracker_raw", "v_inflow", extra=[
    T_CTE, _partial_sql(schemas.INFLOW_INSERT_COLUMNS).format(src="v_inflow")]) + \
    _insert_sql("v_tracker", "infl1")


@query("DML_04")
def dml_04(spark, sf):
    return changes.insert_partial(_existing(spark, sf), _incoming(spark, sf),
                                  schemas.PARTIAL_INSERT_COLUMNS)


ORACLE["DML_04"] = with_("v_tracker_raw", extra=_NEW_ROWS_SQL + [
    _partial_sql(schemas.PARTIAL_INSERT_COLUMNS).format(src="inc")]) + _insert_sql("ex", "infl1")


@query("DML_05")
def dml_05(spark, sf):
    upd = v(spark, sf, "v_obs").select("item_id", "market", F.col("new_reason").alias("reason"),
                                       F.lit("WIP").alias("status"), "seq")
    return changes.set_reason_status(tracker(spark, sf), upd)


ORACLE["DML_05"] = with_("v_tracker_raw", "v_obs", extra=[T_CTE, """
u AS (SELECT item_id, market, new_reason FROM (SELECT *, row_number() OVER
      (PARTITION BY item_id, market ORDER BY seq DESC) AS rn FROM v_obs) WHERE rn = 1)"""]) + \
    """SELECT t.* REPLACE (CASE WHEN u.item_id IS NULL THEN t.reason ELSE u.new_reason END AS reason,
  CASE WHEN u.item_id IS NULL THEN t.status ELSE 'WIP' END AS status)
FROM v_tracker t LEFT JOIN u USING (item_id, market)"""

# Keys that differ in case only: incoming markets are written small in two of three rows, tracker
# markets in one of two.
_SMALL = "CASE WHEN seq % 3 < 2 THEN lower(market) ELSE market END AS market"
_CASE_CTE = "tr AS (SELECT * REPLACE (CASE WHEN seq % 2 = 0 THEN lower(market) ELSE market END AS market) FROM v_tracker)"


def _case_tracker(spark, sf):
    t = tracker(spark, sf)
    return t.withColumn("market", F.when(F.col("seq") % 2 == 0, F.lower("market")).otherwise(F.col("market")))


def _case_incoming(spark, sf, name):
    df = v(spark, sf, name)
    return df.withColumn("market", F.when(F.col("seq") % 3 < 2, F.lower("market")).otherwise(F.col("market")))


@query("JON_01_CASE")
def jon_01_case(spark, sf):
    return joins.inflow_lookup(_case_tracker(spark, sf), _case_incoming(spark, sf, "v_inflow"), ignore_case=True)


ORACLE["JON_01_CASE"] = with_("v_tracker_raw", "v_inflow", extra=[T_CTE, _CASE_CTE]) + f"""
SELECT t.item_id, t.market FROM tr t WHERE EXISTS (SELECT 1 FROM (SELECT item_id, {_SMALL} FROM v_inflow) i
  WHERE lower(i.item_id) = lower(t.item_id) AND lower(i.market) = lower(t.market))"""


@query("JON_02_CASE")
def jon_02_case(spark, sf):
    return joins.status_lookup(_case_tracker(spark, sf), _case_incoming(spark, sf, "v_obs"), ignore_case=True)


ORACLE["JON_02_CASE"] = with_("v_tracker_raw", "v_obs", extra=[T_CTE, _CASE_CTE]) + f"""
SELECT t.item_id, t.market, t.reason, t.status FROM tr t WHERE EXISTS (SELECT 1 FROM
  (SELECT item_id, {_SMALL} FROM v_obs) o WHERE lower(o.item_id) = lower(t.item_id) AND lower(o.market) = lower(t.market))"""


@query("DML_05_CASE")
def dml_05_case(spark, sf):
    upd = _case_incoming(spark, sf, "v_obs").select("item_id", "market", F.col("new_reason").alias("reason"),
                                                    F.lit("WIP").alias("status"), "seq")
    return changes.set_reason_status(_case_tracker(spark, sf), upd, ignore_case=True)


ORACLE["DML_05_CASE"] = with_("v_tracker_raw", "v_obs", extra=[T_CTE, _CASE_CTE, f"""
u AS (SELECT lower(item_id) AS i, lower(market) AS m, new_reason FROM (SELECT *, row_number() OVER
      (PARTITION BY lower(item_id), lower(market) ORDER BY seq DESC) AS rn
      FROM (SELECT * REPLACE ({_SMALL}) FROM v_obs)) WHERE rn = 1)"""]) + \
    """SELECT t.* REPLACE (CASE WHEN u.i IS NULL THEN t.reason ELSE u.new_reason END AS reason,
  CASE WHEN u.i IS NULL THEN t.status ELSE 'WIP' END AS status)
FROM tr t LEFT JOIN u ON u.i = lower(t.item_id) AND u.m = lower(t.market)"""

_ARCHIVE_SQL = [T_CTE, """
cand AS (SELECT * FROM v_tracker t WHERE status = 'unblocked' AND EXISTS
         (SELECT 1 FROM v_inflow i WHERE i.item_id = t.item_id AND i.market = t.market))""",
                "hist AS (SELECT * FROM v_tracker WHERE status = 'TP')", """
cand1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY
          """ + ", ".join(schemas.TRACKER_KEY) + """ ORDER BY seq) AS rn FROM cand) WHERE rn = 1)"""]


def _archive(spark, sf, only_archived=False):
    t = tracker(spark, sf)
    hist = t.where(F.col("status") == "TP")
    return changes.archive_move(t, hist, v(spark, sf, "v_inflow"), only_archived=only_archived)


@query("DML_06")
def dml_06(spark, sf):
    return _archive(spark, sf)[1]


ORACLE["DML_06"] = with_("v_tracker_raw", "v_inflow", extra=_ARCHIVE_SQL) + \
    _insert_sql("hist", "cand1")


@query("DML_07")
def dml_07(spark, sf):
    return _archive(spark, sf)[0]


ORACLE["DML_07"] = with_("v_tracker_raw", "v_inflow", extra=_ARCHIVE_SQL) + f"""
SELECT {TCOLS} FROM v_tracker t WHERE NOT EXISTS (SELECT 1 FROM cand c
  WHERE c.item_id = t.item_id AND c.market = t.market AND c.target = t.target)"""


@query("DML_08")
def dml_08(spark, sf):
    return changes.bulk_delete_unblocked(tracker(spark, sf))


ORACLE["DML_08"] = with_("v_tracker_raw", extra=[T_CTE]) + f"""
SELECT {TCOLS} FROM v_tracker t WHERE NOT EXISTS (SELECT 1 FROM v_tracker u
  WHERE u.status = 'unblocked' AND u.item_id = t.item_id AND u.market = t.market
  AND u.target = t.target)"""


@query("DML_09")
def dml_09(spark, sf):
    path = scratch_path(spark, "tracker-table")
    empty = changes.create_table(spark, path)
    loaded = changes.insert_if_absent(empty, tracker(spark, sf))
    loaded.write.mode("append").partitionBy("market").parquet(path)
    return spark.read.schema(schemas.TRACKER_SCHEMA).parquet(path)


ORACLE["DML_09"] = with_("v_tracker_raw", extra=[T_CTE]) + f"""
SELECT {", ".join(schemas.TRACKER_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY
  {", ".join(schemas.TRACKER_KEY)} ORDER BY seq) AS rn FROM v_tracker) WHERE rn = 1"""


@query("DML_10")
def dml_10(spark, sf):
    return changes.one_update_per_item_market(_decided(spark, sf, dec.AS_WRITTEN))


ORACLE["DML_10"] = with_("v_obs", extra=[DEDUP_CTE]) + decide_sql("dd") + """
SELECT item_id, market, coalesce(next_reason, '') AS reason, coalesce(next_status, '') AS status,
       seq FROM (SELECT *, row_number() OVER (PARTITION BY market, item_id ORDER BY seq) AS rn
                 FROM decided) WHERE rn = 1"""

# ======================================================== 2.13 pipelines ===


@query("PIP_01")
def pip_01(spark, sf):
    return _pip01(spark, sf)["tracker"]


ORACLE["PIP_01"] = with_("v_tracker_raw", "v_core_export", "v_codes", "v_allow",
                         extra=_PIP01_SQL + ["u1 AS (SELECT DISTINCT item_id, market, export_date "
                                             "AS new_date FROM upd)"]) + """
SELECT t.* REPLACE (CASE WHEN u1.item_id IS NULL THEN t.export_date ELSE u1.new_date END
                    AS export_date)
FROM v_tracker t LEFT JOIN u1 USING (item_id, market)"""


@query("PIP_02")
def pip_02(spark, sf):
    out = P.refresh_dimensions(
        tracker(spark, sf), v(spark, sf, "v_dim_quota"), v(spark, sf, "v_dimensions"),
        v(spark, sf, "v_dim_jobs"), v(spark, sf, "v_codes"), lookups.region_pairs(spark),
        reason_name=REASON_NAME)
    return out["tracker"]


ORACLE["PIP_02"] = with_("v_tracker_raw", "v_dim_quota", "v_dim_jobs", "v_dimensions", "v_codes",
                         extra=[T_CTE, CM1_CTE, CM2_CTE, _REGIONS_SQL, f"""
q AS (SELECT item_id, market, seq FROM v_tracker
      WHERE (reason IS NULL OR reason IN ('{REASON_NAME}', ''))
      AND (status NOT IN ('TP', 'unblocked') OR status IS NULL)
      AND (has_dimensions <> 'True' OR has_dimensions IS NULL OR has_weight <> 'True'
           OR has_weight IS NULL))""", """
qr AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY seq, item_id) AS position FROM q)""",
    """
s AS (SELECT market, slot_no, greatest(capacity, 0) AS cap,
        sum(greatest(capacity, 0)) OVER (PARTITION BY market ORDER BY slot_no
                                         ROWS UNBOUNDED PRECEDING) AS hi FROM v_dim_quota)""", f"""
js AS (SELECT *, {_JOB_STATE} AS state FROM v_dim_jobs)""", """
gate AS (SELECT market FROM js GROUP BY market
         HAVING bool_and(state = 'ok') AND NOT bool_or(state = 'failed'))""", """
batch AS (SELECT qr.item_id, qr.market FROM qr JOIN s ON qr.market = s.market
          AND qr.position > s.hi - s.cap AND qr.position <= s.hi
          WHERE qr.market IN (SELECT market FROM gate))""", """
rws AS (SELECT d.* FROM v_dimensions d
  WHERE EXISTS (SELECT 1 FROM regions r JOIN cm2 USING (market)
                WHERE cm2.market_code = d.marketplace_id AND r.region_id = d.region_id)
    AND EXISTS (SELECT 1 FROM batch b JOIN cm2 USING (market)
                WHERE b.item_id = d.asin AND cm2.market_code = d.marketplace_id))""", """
flg AS (SELECT CASE WHEN length(asin) >= 10 THEN asin ELSE lpad(asin, 10, '0') END AS item_id,
          cm1.market, seq,
          CASE WHEN coalesce(pkg_height, '') <> '' AND coalesce(pkg_length, '') <> ''
                    AND coalesce(pkg_width, '') <> '' THEN 'True' ELSE 'False' END AS dims,
          CASE WHEN coalesce(pkg_weight, '') <> '' THEN 'True' ELSE 'False' END AS wt
        FROM rws JOIN cm1 ON cm1.market_code = rws.marketplace_id)""", """
u AS (SELECT item_id, market, dims, wt FROM (SELECT *, row_number() OVER (PARTITION BY item_id,
        market ORDER BY seq DESC, dims DESC, wt DESC) AS rn FROM flg) WHERE rn = 1)"""]) + """
SELECT t.* REPLACE (CASE WHEN u.item_id IS NULL THEN t.has_dimensions ELSE u.dims END AS has_dimensions,
                    CASE WHEN u.item_id IS NULL THEN t.has_weight ELSE u.wt END AS has_weight)
FROM v_tracker t LEFT JOIN u USING (item_id, market)"""


@query("PIP_03")
def pip_03(spark, sf):
    out = P.refresh_status(tracker(spark, sf), v(spark, sf, "v_obs_raw"),
                           v(spark, sf, "v_obs_rules"), v(spark, sf, "v_codes"))
    return out["decisions"].select("item_id", "market", "contribution", "new_reason", "reason",
                                   "status", "seq", "next_reason", "next_status", "rule")


ORACLE["PIP_03"] = with_("v_obs_raw", "v_obs_rules", "v_codes", "v_tracker_raw", extra=[
    T_CTE, CM1_CTE, """
obs AS (SELECT CASE WHEN length(coalesce(asin, '')) >= 10 THEN coalesce(asin, '')
                    ELSE lpad(coalesce(asin, ''), 10, '0') END AS item_id,
               cm1.market, coalesce(contributions, '') AS contribution,
               coalesce(restriction_reasons, '') AS reason_text, seq
        FROM v_obs_raw o LEFT JOIN cm1 ON cm1.market_code = CAST(o.marketplace_id AS INTEGER))""",
    _CLASSIFY_SQL.format(src="obs", rules="v_obs_rules").strip(), """
dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY item_id, market,
       new_reason, reason_text ORDER BY seq) AS rn FROM classified) WHERE rn = 1)""", """
st AS (SELECT item_id, market, reason, status FROM (SELECT *, row_number() OVER
       (PARTITION BY item_id, market ORDER BY seq) AS rn FROM v_tracker) WHERE rn = 1)""", """
rows AS (SELECT dd.*, st.reason, st.status FROM dd LEFT JOIN st USING (item_id, market))"""]) + \
    decide_sql("rows") + """
SELECT item_id, market, contribution, new_reason, reason, status, seq, next_reason, next_status, rule
FROM decided"""


def _status_rows(spark, sf):
    return P.refresh_status(tracker(spark, sf), v(spark, sf, "v_obs_raw"), v(spark, sf, "v_obs_rules"),
                            v(spark, sf, "v_codes"))


@query("PIP_03_TRACKER")
def pip_03_tracker(spark, sf):
    return _status_rows(spark, sf)["tracker"]


_PIP03_UPDATES = """
, upd AS (SELECT item_id, market, coalesce(next_reason, '') AS reason, coalesce(next_status, '') AS status, seq
    FROM (SELECT *, row_number() OVER (PARTITION BY market, item_id ORDER BY seq) AS rn FROM decided)
    WHERE rn = 1)"""
_PIP03_DECIDED = ORACLE["PIP_03"][:ORACLE["PIP_03"].rindex("SELECT item_id, market, contribution")]

ORACLE["PIP_03_TRACKER"] = _PIP03_DECIDED + _PIP03_UPDATES + """
SELECT t.* REPLACE (CASE WHEN u.item_id IS NULL THEN t.reason ELSE u.reason END AS reason,
                    CASE WHEN u.item_id IS NULL THEN t.status ELSE u.status END AS status)
FROM v_tracker t LEFT JOIN upd u USING (item_id, market)"""


@query("PIP_03_UPDATES")
def pip_03_updates(spark, sf):
    return _status_rows(spark, sf)["updates"]


ORACLE["PIP_03_UPDATES"] = _PIP03_DECIDED + _PIP03_UPDATES + "SELECT * FROM upd"


@query("PIP_03_BATCHES")
def pip_03_batches(spark, sf):
    out = P.status_batches(tracker(spark, sf), v(spark, sf, "v_dim_quota"))
    return changes.union_by_name(out["assigned"], out["unassigned"])


ORACLE["PIP_03_BATCHES"] = with_("v_tracker_raw", "v_dim_quota", extra=[T_CTE]) + """,
q AS (SELECT item_id, market, seq, row_number() OVER (PARTITION BY market ORDER BY seq, item_id) AS position
      FROM v_tracker WHERE (status NOT IN ('TP', 'unblocked') OR status IS NULL) AND export_date IS NULL),
s AS (SELECT market, slot_no, slot_ref, greatest(capacity, 0) AS cap,
        sum(greatest(capacity, 0)) OVER (PARTITION BY market ORDER BY slot_no
                                         ROWS UNBOUNDED PRECEDING) AS hi FROM v_dim_quota)
SELECT q.item_id, q.market, q.seq, q.position, s.slot_no, s.slot_ref FROM q
LEFT JOIN s ON q.market = s.market AND q.position > s.hi - s.cap AND q.position <= s.hi"""


def _streamed(spark, sf, log: bool):
    """The status stream over result files written from the events, one file a trigger, into a
    tracker table that other jobs have already given later versions."""
    root = _write_obs_files(spark, sf, F.lit("inbox"), F.col("seq") % 4)
    base = scratch_path(spark, "stream")
    store = VersionedTable(spark, f"{base}/tracker")
    for _ in range(2):
        store.commit(tracker(spark, sf).drop("seq"))
    args = (v(spark, sf, "v_obs_rules"), v(spark, sf, "v_codes"), f"{base}/checkpoint")
    slow = {"max_files_per_trigger": 1, "state_files_per_trigger": 8}
    if log:
        ingest.start_status_log_stream(spark, root, store, f"{base}/log", *args, **slow).awaitTermination()
        return ingest.current_tracker(spark, store, f"{base}/log")
    # The bound tracker repeats its primary key.
    ingest.start_status_stream(spark, root, store, *args, check_keys=False, **slow).awaitTermination()
    return store.read(schema=schemas.TRACKER_SCHEMA)


@query("STM_01")
def stm_01(spark, sf):
    root = _write_obs_files(spark, sf, F.lit("inbox"), F.col("seq") % 4)
    out = scratch_path(spark, "stream-rows")

    def apply(batch, batch_id):
        (ingest.observation_batch(batch).select(*_READ_BACK)
         .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))

    (ingest.observation_stream(spark, root, max_files_per_trigger=2).writeStream.foreachBatch(apply)
     .option("checkpointLocation", scratch_path(spark, "stream-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).select(*_READ_BACK)


ORACLE["STM_01"] = ORACLE["SRC_03"]


@query("STM_02")
def stm_02(spark, sf):
    return _streamed(spark, sf, log=False)


@query("STM_02_LOG")
def stm_02_log(spark, sf):
    return _streamed(spark, sf, log=True)


_STREAM_SQL = with_("v_obs_raw", "v_obs_rules", "v_codes", "v_tracker_raw", extra=[
    T_CTE, CM1_CTE, _EXPECT_ROWS, """
obs AS (SELECT CASE WHEN length(coalesce(asin, '')) >= 10 THEN coalesce(asin, '')
                    ELSE lpad(coalesce(asin, ''), 10, '0') END AS item_id,
               cm1.market, coalesce(contributions, '') AS contribution,
               coalesce(restriction_reasons, '') AS reason_text, (o.seq % 4) * 1000000000 + o.seq AS seq
        FROM rows o LEFT JOIN cm1 ON cm1.market_code = CAST(o.marketplace_id AS INTEGER))""",
    _CLASSIFY_SQL.format(src="obs", rules="v_obs_rules").strip(), """
dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY item_id, market,
       new_reason, reason_text ORDER BY seq) AS rn FROM classified) WHERE rn = 1)""", f"""
st AS (SELECT item_id, market, reason, status FROM (SELECT *, row_number() OVER
       (PARTITION BY item_id, market ORDER BY {", ".join(c + " NULLS FIRST" for c in schemas.TRACKER_KEY)}) AS rn
       FROM v_tracker) WHERE rn = 1)""", """
joined AS (SELECT dd.*, st.reason, st.status FROM dd LEFT JOIN st USING (item_id, market))"""]) + \
    decide_sql("joined") + _PIP03_UPDATES + f"""
SELECT {", ".join("t." + c for c in schemas.TRACKER_COLUMNS if c not in ("reason", "status"))},
  CASE WHEN u.item_id IS NULL THEN t.reason ELSE u.reason END AS reason,
  CASE WHEN u.item_id IS NULL THEN t.status ELSE u.status END AS status
FROM v_tracker t LEFT JOIN upd u USING (item_id, market)"""
ORACLE["STM_02"] = ORACLE["STM_02_LOG"] = _STREAM_SQL


@query("AGG_06_STREAM")
def agg_06_stream(spark, sf):
    """Gates over status rows that arrive in files, one file a trigger."""
    base = scratch_path(spark, "gate")
    rows = v(spark, sf, "v_job_events").select(
        F.timestamp_seconds("run_s").alias("run_at"), "market", "slot_no", "phase", "status_text",
        F.timestamp_seconds("at_s").alias("at"))
    rows.repartition(4, "at").write.parquet(f"{base}/in")
    log = job_gates.JobLog(spark, f"{base}/log")
    job_gates.start_gate_stream(spark, f"{base}/in", log, f"{base}/checkpoint",
                                max_files_per_trigger=1).awaitTermination()
    return log.gates().select(F.unix_seconds("run_at").alias("run_s"), "market", "jobs", "late", "gate",
                              F.unix_seconds("decided_at").alias("decided_s"))


ORACLE["AGG_06_STREAM"] = with_("v_job_events", extra=[
    f"s AS (SELECT *, {_JOB_STATE} AS state FROM v_job_events)", """
e AS (SELECT run_s, market, slot_no,
        min(CASE WHEN (state = 'failed' OR (phase = 'result' AND state = 'ok')) AND at_s <= run_s + 14400
                 THEN at_s * 2 + (CASE WHEN state = 'ok' THEN 1 ELSE 0 END) END) AS ending
      FROM s GROUP BY run_s, market, slot_no)""", """
o AS (SELECT run_s, market, coalesce(ending // 2, run_s + 14400) AS ended,
        CASE WHEN ending % 2 = 0 THEN 'failed' WHEN ending % 2 = 1 THEN 'ok'
             WHEN (SELECT max(at_s) FROM v_job_events) > run_s + 14400 THEN 'late' ELSE 'pending' END AS outcome
      FROM e)""", """
g AS (SELECT run_s, market, count(*) AS jobs, count(*) FILTER (WHERE outcome = 'late') AS late,
        bool_or(outcome IN ('failed', 'late')) AS bad, bool_and(outcome = 'ok') AS good,
        min(ended) FILTER (WHERE outcome IN ('failed', 'late')) AS first_bad, max(ended) AS last
      FROM o GROUP BY run_s, market)"""]) + """
SELECT run_s, market, jobs, late, CASE WHEN bad THEN 'failed' WHEN good THEN 'passed' ELSE 'pending' END AS gate,
  CASE WHEN bad THEN first_bad WHEN good THEN last END AS decided_s FROM g"""


def _intake(spark, sf):
    t = tracker(spark, sf)
    return P.intake_inflow(t, t.where(F.col("status") == "TP"), v(spark, sf, "v_inflow"))


@query("PIP_04_HISTORY")
def pip_04_history(spark, sf):
    return _intake(spark, sf)["history"]


ORACLE["PIP_04_HISTORY"] = ORACLE["DML_06"]


@query("PIP_04_FOUND")
def pip_04_found(spark, sf):
    return _intake(spark, sf)["found"]


ORACLE["PIP_04_FOUND"] = with_("v_tracker_raw", "v_inflow") + """
SELECT t.item_id, t.market FROM v_tracker_raw t
WHERE EXISTS (SELECT 1 FROM v_inflow i WHERE i.item_id = t.item_id AND i.market = t.market)"""


@query("PIP_04")
def pip_04(spark, sf):
    return _intake(spark, sf)["tracker"]


ORACLE["PIP_04"] = with_("v_tracker_raw", "v_inflow", extra=_ARCHIVE_SQL + [f"""
kept AS (SELECT {TCOLS} FROM v_tracker t WHERE NOT EXISTS (SELECT 1 FROM cand c
  WHERE c.item_id = t.item_id AND c.market = t.market AND c.target = t.target))""",
    _partial_sql(schemas.INFLOW_INSERT_COLUMNS).format(src="v_inflow")]) + \
    _insert_sql("kept", "infl1")
