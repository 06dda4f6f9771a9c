"""Scalar column functions (STR, DAT, CST, CMP, JST, FLT-06, PRJ-02).

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from itemtrack.functions import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- STR ----

def zfill(c, width: int = fixed.ITEM_ID_WIDTH) -> Column:
    """STR-01: left-pad with zeros to ``width``; longer values stay whole.

    As with Python's ``str.zfill`` a leading sign stays in front of the zeros.
    ``lpad`` alone would cut longer values, hence the length guard.
    """
    c = _col(c).cast("string")
    signed = c.startswith("-") | c.startswith("+")
    body = F.substring(c, 2, 1 << 30)
    return (F.when(F.length(c) >= width, c)
            .when(signed, F.concat(F.substring(c, 1, 1), F.lpad(body, width - 1, "0")))
            .otherwise(F.lpad(c, width, "0")))


def composite_key(*cols) -> Column:
    """STR-02: key text made by plain concatenation (for output only; joins use columns)."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def contains_any(text, keywords, sep: str = fixed.KEYWORD_SEPARATOR) -> Column:
    """STR-03: true when any ``sep``-separated keyword is a case-sensitive substring.

    ``split`` keeps trailing empty parts and ``contains(x, '')`` is true, so an
    empty keyword matches everything, as in Python.
    """
    text = _col(text)
    return F.exists(F.split(_col(keywords), _regex_literal(sep)), lambda k: text.contains(k))


def join_list(arr, sep: str = fixed.REASON_LIST_SEPARATOR) -> Column:
    """STR-04: join an array of strings with ``sep``."""
    return F.array_join(_col(arr), sep)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in sep)


# ---------------------------------------------------------------- DAT ----

def run_date(kind: str, today=None, manual: str | None = None) -> Column:
    """DAT-01: dataset date text ``yyyy/MM/dd``.

    kind: ``two_days_ago`` | ``tuesday`` (latest Tuesday, today counts) |
    ``sunday`` (that Tuesday minus two days) | ``manual`` (``yyyyMMdd`` text).
    ``today`` is a date, a ``yyyy-MM-dd`` text or a column; default current_date.
    """
    if today is None:
        d = F.current_date()
    elif isinstance(today, Column):
        d = today.cast("date")
    else:
        d = F.lit(today if isinstance(today, _dt.date) else str(today)).cast("date")
    last_tuesday = F.date_sub(F.next_day(d, "TU"), 7)
    if kind == "two_days_ago":
        out = F.date_sub(d, 2)
    elif kind == "tuesday":
        out = last_tuesday
    elif kind == "sunday":
        out = F.date_sub(last_tuesday, 2)
    elif kind == "manual":
        if manual is None:
            raise ValueError("manual run date needs a yyyyMMdd text")
        out = F.to_date(F.lit(manual), "yyyyMMdd")
    else:
        raise ValueError(f"unknown run date kind {kind!r}")
    return F.date_format(out, "yyyy/MM/dd")


def iso_date_text(c) -> Column:
    """DAT-02: date as ``yyyy-MM-dd`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


# ---------------------------------------------------------------- CST ----

def code_to_text(c) -> Column:
    """CST-01: market code as text (for text keys)."""
    return _col(c).cast("string")


def text_to_code(c, strict: bool = True) -> Column:
    """CST-01: market code from text; strict raises on bad text like ``int(x)``."""
    c = _col(c)
    return c.cast("int") if strict else c.try_cast("int")


# ---------------------------------------------------------- FLT-06 -------

def zero_date_to_null(c) -> Column:
    """FLT-06: text or date to date; the zero date (or any bad text) becomes NULL."""
    c = _col(c)
    return c.cast("string").try_cast(T.DateType())


# ---------------------------------------------------------------- NA -----

def na_to_null(c, tokens=fixed.PANDAS_NA_TOKENS) -> Column:
    """Map the reader's NA token set to NULL (text columns)."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def fill_empty(df: DataFrame, columns=None) -> DataFrame:
    """PRJ-02: every NULL in the (string) columns becomes ``''``."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=list(columns))


# ---------------------------------------------------------------- CMP ----

def _present(c) -> Column:
    c = _col(c)
    return c.isNotNull() & (c.cast("string") != "")


def completeness_flags(df: DataFrame, height="pkg_height", length="pkg_length",
                       width="pkg_width", weight="pkg_weight") -> DataFrame:
    """CMP-01: ``has_dimensions`` / ``has_weight`` flags as 'True' / 'False' text.

    Dimensions are complete iff package height, length and width are all
    non-empty; weight iff package weight is non-empty.
    """
    dims = _present(height) & _present(length) & _present(width)
    return df.withColumns({
        "has_dimensions": F.when(dims, fixed.FLAG_TRUE).otherwise(fixed.FLAG_FALSE),
        "has_weight": F.when(_present(weight), fixed.FLAG_TRUE).otherwise(fixed.FLAG_FALSE),
    })


def flag_is_true(c) -> Column:
    """Boolean view of a 'True' / 'False' text flag (NULL counts as not true)."""
    return F.coalesce(_col(c) == fixed.FLAG_TRUE, F.lit(False))


# ---------------------------------------------------------------- JST ----

def submission_state(text) -> Column:
    """JST-01, submission phase: 'ok' | 'failed' | 'waiting'; first match wins.

    'Deleted' is spelt right here (a deliberate difference: a deleted job fails).
    """
    t = F.coalesce(_col(text), F.lit(""))
    return (F.when(t == fixed.JOB_WAITING, "ok")
            .when(t.contains(fixed.JOB_EXECUTING), "ok")
            .when(t.contains(fixed.JOB_DELETED), "failed")
            .when(t.contains(fixed.JOB_SUCCESS), "ok")
            .when(t.contains(fixed.JOB_ERROR), "failed")
            .when(t.contains(fixed.JOB_PUBLISHING), "ok")
            .otherwise("waiting"))


def result_state(text) -> Column:
    """JST-01, result phase: 'ok' (finished) | 'failed' | 'pending'; first match wins."""
    t = F.coalesce(_col(text), F.lit(""))
    return (F.when(t.contains(fixed.JOB_SUCCESS), "ok")
            .when(t.contains(fixed.JOB_ERROR), "failed")
            .when(t.contains(fixed.JOB_DELETED), "failed")
            .otherwise("pending"))


def job_state(phase, text) -> Column:
    """JST-01 for a status table holding both phases."""
    return F.when(_col(phase) == "submit", submission_state(text)).otherwise(result_state(text))
