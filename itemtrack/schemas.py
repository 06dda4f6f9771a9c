"""Schemas of the tracker (T1/T2) and of the inputs T3-T10 (names per SURVEY §1.2)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, L = T.StringType(), T.IntegerType(), T.DateType(), T.LongType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# T1 tracker and T2 history share one body.  Column order is the DDL order.
TRACKER_FIELDS = [
    ("item_id", S, False),
    ("market", S, False),
    ("target", S, False),
    ("offer_type", S, False),
    ("task", S, True),
    ("subtask_type", S, True),
    ("reason", S, True),
    ("status", S, True),
    ("requester", S, True),
    ("action_year", I, True),
    ("action_wk", I, True),
    ("action_date", D, False),
    ("take_action", S, True),
    ("tracker", S, True),
    ("comment", S, True),
    ("export_date", D, True),
    ("double_check_date", D, True),
    ("login", S, True),
    ("has_dimensions", S, True),
    ("has_weight", S, True),
]
TRACKER_SCHEMA = _struct(TRACKER_FIELDS)
TRACKER_COLUMNS = [f[0] for f in TRACKER_FIELDS]

# Full primary key of T1/T2.  Zero dates and missing strings may leave NULLs in
# it after normalisation, so every key comparison is null-safe.
TRACKER_KEY = [
    "item_id", "market", "target", "action_date", "reason", "export_date",
    "subtask_type", "has_dimensions", "has_weight", "offer_type",
]
# Key of keyed updates and lookups.
ITEM_MARKET = ["item_id", "market"]
# Key of deletes.
DELETE_KEY = ["item_id", "market", "target"]

# Column lists of the partial inserts.
INFLOW_INSERT_COLUMNS = [
    "item_id", "market", "target", "offer_type", "task", "subtask_type", "requester",
    "reason", "action_year", "action_date", "action_wk",
]
PARTIAL_INSERT_COLUMNS = [
    "item_id", "market", "target", "offer_type", "action_year", "action_wk", "action_date",
    "login", "reason", "take_action", "subtask_type", "status",
]
TRIAL_INSERT_COLUMNS = [
    "item_id", "market", "target", "offer_type", "action_date", "take_action", "status",
]

# T3 core export.
CORE_EXPORT_SCHEMA = _struct([
    ("item_id", S, True), ("market_code", I, True), ("exportable_date", D, True),
])

# T4 dimension result files: every column is text on disk.
DIMENSION_FILE_COLUMNS = [
    "asin", "marketplace_id", "pkg_length", "pkg_width", "pkg_height", "pkg_weight",
    "pkg_dimensional_uom", "pkg_weight_uom", "item_length", "item_width", "item_height",
    "item_weight",
]
# T5 observation result files.
OBSERVATION_FILE_COLUMNS = [
    "asin", "marketplace_id", "contributions", "restriction_reasons", "country_code",
]


def all_string_schema(columns) -> T.StructType:
    return _struct([(c, S, True) for c in columns])


# T6-T10 lookup tables.
CODE_MAP_SCHEMA = _struct([("market", S, True), ("market_code", I, True)])
KEYWORD_RULE_SCHEMA = _struct([
    ("market", S, True), ("rule_no", I, True), ("keyword", S, True), ("blocker_type", S, True),
])
QUOTA_SCHEMA = _struct([
    ("market", S, True), ("slot_no", I, True), ("capacity", I, True), ("slot_ref", S, True),
])
ALLOWED_MARKET_SCHEMA = _struct([("market", S, True)])
JOB_STATUS_SCHEMA = _struct([
    ("market", S, True), ("slot_no", I, True), ("phase", S, True), ("status_text", S, True),
])
