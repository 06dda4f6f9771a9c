"""Fixed values that must equal the reference behaviour for right results.

FIXED VALUES — keep in this natural order and spelling.
"""

# Zero date that the tracker database uses for "no date".
ZERO_DATE = "0000-00-00"

# Width to which item ids are left-padded with zeros.
ITEM_ID_WIDTH = 10

# Statuses that take an item out of the status and dimension queues.
DONE_STATUSES = ("TP", "unblocked")

# Reason name of the dimension queue (a parameter; this is the live value).

# Completeness flag texts.
FLAG_TRUE = "True"
FLAG_FALSE = "False"

# Classification outcomes and the contribution that carries reasons.
OPERATIONAL_RULE = "OperationalRule"
REASON_OTHERS = "Others"
REASON_NONE = "No blocker"

# Decision outcomes.
STATUS_NONACTION = "nonaction"
STATUS_UNBLOCKED = "unblocked"
STATUS_WIP = "WIP"

# Region ids allowed per market in the warehouse dimension extract.
REGIONS_BY_MARKET = {
    "US": (1,),
    "UK": (1, 2, 3),
    "DE": (1, 2, 3),
    "JP": (1, 2, 3),
    "AE": (1, 2, 3),
}

# Job console status texts.
JOB_WAITING = "Waiting for Resources"
JOB_EXECUTING = "Executing"
JOB_SUCCESS = "Success"
JOB_PUBLISHING = "Publishing"
JOB_ERROR = "Error"
JOB_DELETED = "Deleted"

# Default NA token set of the pandas 1.x CSV reader (the reference reads result
# files with an option that only exists before pandas 2.0, whose list lacks 'None').
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Separator of keyword lists in the rule table and of joined reason lists.
KEYWORD_SEPARATOR = ";"
REASON_LIST_SEPARATOR = ","
