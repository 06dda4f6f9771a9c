"""Result files: SRC-03 tolerant TSV scan, SRC-04 discovery by day, SRC-05 routing.

Files are scanned as lines.  A quoted field may hold line breaks, so whether a line starts a
record depends on all lines before it.  What a line does to that state is one of four
functions (leave it, open, close, toggle); a first scan sends one small row per file split
(its header line and the lines that hold quotes), the functions are composed over lines and
splits, and the places of the records of several lines come out.  The second scan then reads
lines, joined to the headers and, where there are any, to those places; lines themselves
are never exchanged as long as these two tables are small enough to be sent to them.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from itemtrack import schemas
from itemtrack.functions import fixed
from itemtrack.functions.scalars import na_to_null
from itemtrack.operators.common import materialize
from itemtrack.operators.lookups import code_to_market

# A field is quoted ('""' inside is a quote) or runs to the next tab.
_FIELD = r'(?:^|\t)("[^"]*+(?:""[^"]*+)*+"[^\t]*|[^\t]*)'


def fields(line: Column) -> Column:
    """The fields of a tab-separated record as an array of text."""
    plain = F.split(line, "\t")
    quoted = F.transform(F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1)), lambda x: F.when(
        x.startswith('"'), F.replace(F.regexp_replace(x, r'^"([^"]*+(?:""[^"]*+)*+)"', "$1"), F.lit('""'), F.lit('"')))
        .otherwise(x))
    return F.when(F.instr(line, '"') > 0, quoted).otherwise(plain)


def scan_lines(reader, paths, seq_col: str | None = "seq") -> DataFrame:
    """Lines of result files with ``_file``, ``_file_mtime``, ``_block`` and, on static
    frames, the order (file, block, position) taken right after the scan."""
    meta = [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_file_mtime"),
            F.col("_metadata.file_block_start").alias("_block")]
    lines = reader.text(paths).select(F.col("value").alias("_line"), *meta)
    return lines if seq_col is None else number_lines(lines, seq_col)


def number_lines(lines: DataFrame, seq_col: str = "seq") -> DataFrame:
    """The order of the lines of result files: file, split, position.  It does not depend on how
    files are dealt to batches."""
    return lines.withColumn(seq_col, F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                                              F.monotonically_increasing_id().alias("pos")))


# ------------------------------------------------------- records of several lines --

def _leaves_open(line: Column, inside: bool) -> Column:
    """1 if a line that starts inside a quoted field (or at the start of a field) ends inside one."""
    def step(state: Column, part: Column) -> Column:
        # Between tabs: a quoted field is closed by the first quote that is not one of a pair.
        rest = F.when(state == 1, part).otherwise(F.substring(part, F.lit(2), F.length(part)))
        closed = F.instr(F.replace(rest, F.lit('""'), F.lit("")), '"') > 0
        return F.when((state == 1) | part.startswith('"'), F.when(closed, 0).otherwise(1)).otherwise(0)

    return F.aggregate(F.split(line, "\t"), F.lit(int(inside)), step)


def _splits(lines: DataFrame, seq_col: str) -> DataFrame:
    """One row per file split: its first and last position, its first line that is not empty
    and the effect of its lines with quotes.  A split is read by one task, so this is reduced
    before the exchange; the list is bounded by the split's size."""
    pos, shown = F.col(f"{seq_col}.pos"), F.length("_line") > 0
    effect = F.when(F.instr("_line", '"') > 0, F.struct(
        pos.alias("pos"), _leaves_open(F.col("_line"), False).alias("out"), _leaves_open(F.col("_line"), True).alias("in")))
    return lines.groupBy("_file", "_block").agg(
        F.min(pos).alias("first"), F.max(pos).alias("last"), F.min(F.when(shown, pos)).alias("head_pos"),
        F.min_by(F.when(shown, F.col("_line")), F.when(shown, pos)).alias("head"),
        F.collect_list(effect).alias("quotes"))


def _running_state(df: DataFrame, group, order: str) -> DataFrame:
    """Adds ``state`` (after each row's function, if its group starts with 0) and ``sure``
    (whether it is the same if the group starts with 1).  A function that ignores its input fixes
    the state; those that turn it (out, in: what it makes of 0 and 1) are counted since."""
    rows = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    fixes, turns = F.col("out") == F.col("in"), (F.col("out") == 1) & (F.col("in") == 0)
    df = df.withColumn("_fixed", F.max(F.when(fixes, F.col(order))).over(rows))
    since = Window.partitionBy(*group, "_fixed").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    start = F.coalesce(F.max(F.when(fixes, F.col("out"))).over(since), F.lit(0))
    turned = F.sum(F.when(turns, 1).otherwise(0)).over(since)
    return df.withColumns({"state": (start + turned) % 2, "sure": F.col("_fixed").isNotNull()}).drop("_fixed")


def long_records(splits: DataFrame) -> DataFrame:
    """Places of records of several lines: _file, block, pos (of the first line), end_block,
    end_pos.  A quote that its file never closes opens nothing."""
    lines = splits.select("_file", "_block", F.explode("quotes").alias("q")).select("_file", "_block", "q.*")
    group, place = ["_file", "_block"], F.struct(F.col("_block").alias("b"), F.col("pos").alias("p"))
    own = Window.partitionBy(*group).orderBy("pos")

    def state(entry: Column | int, behind: bool) -> Column:
        name = "state" if behind else "p.state"
        sure = F.col("sure" if behind else "p.sure")
        inner = F.when(sure, F.col(name)).otherwise((F.col(name) + entry) % 2)
        return inner if behind else F.when(F.col("p").isNull(), entry).otherwise(inner)

    def marks(entry: Column | int) -> Column:          # the line opens or closes a record
        return state(entry, False) != state(entry, True)

    lines = _running_state(lines, group, "pos").withColumn("p", F.lag(F.struct("state", "sure")).over(own))
    # One row per split and start: where it ends and its first mark.  Then the splits of a file
    # in order give every split its true start and the first mark behind it.
    ends = lines.groupBy(*group).agg(
        F.max_by(state(F.lit(0), True), "pos").alias("out"), F.max_by(state(F.lit(1), True), "pos").alias("in"),
        F.min(F.when(marks(F.lit(0)), place)).alias("first0"), F.min(F.when(marks(F.lit(1)), place)).alias("first1"))
    file = Window.partitionBy("_file").orderBy("_block")
    starts = (_running_state(ends, ["_file"], "_block").withColumn("entry", F.lag("state", 1, 0).over(file))
              .withColumn("first", F.when(F.col("entry") == 1, F.col("first1")).otherwise(F.col("first0")))
              .withColumn("later", F.first("first", ignorenulls=True).over(file.rowsBetween(1, Window.unboundedFollowing)))
              .select(*group, "entry", "later"))
    # Lines that open a record and lines that close it, in turn.
    entry = F.col("entry")
    turns = (lines.join(starts, group).where(marks(entry))
             .select(*group, "pos", (state(entry, True) == 1).alias("opens"), "later", F.lead(place).over(own).alias("next")))
    return (turns.where("opens").withColumn("end", F.coalesce("next", "later")).where("end IS NOT NULL")
            .select("_file", F.col("_block").alias("block"), "pos", F.col("end.b").alias("end_block"),
                    F.col("end.p").alias("end_pos")))


def _lines_of(records: DataFrame, splits: DataFrame) -> DataFrame:
    """_file, _block, _pos of every line of the long records, with the record's first line."""
    parts = splits.select("_file", F.col("_block").alias("part"), "first", "last")
    # At most one record reaches from one split into the next.
    covered = (records.where("block <> end_block").join(parts, "_file")
               .where("part >= block AND part <= end_block")
               .withColumn("from", F.when(F.col("part") == F.col("block"), F.col("pos")).otherwise(F.col("first")))
               .withColumn("to", F.when(F.col("part") == F.col("end_block"), F.col("end_pos")).otherwise(F.col("last"))))
    short = records.where("block = end_block").select("*", F.col("block").alias("part"), F.col("pos").alias("from"),
                                                      F.col("end_pos").alias("to"))
    return short.unionByName(covered.select(*short.columns)).select(
        "_file", F.col("part").alias("_block"), F.explode(F.sequence("from", "to")).alias("_pos"),
        F.struct("block", "pos").alias("_record"))


def _joined(lines: DataFrame, places: DataFrame, seq_col: str) -> DataFrame:
    """Long records as one line each, at the place of their first line."""
    kept = [c for c in lines.columns if c != "_line"]
    inside = lines.withColumn("_pos", F.col(f"{seq_col}.pos")).join(places, ["_file", "_block", "_pos"])
    first = (F.col("_record.block") == F.col("_block")) & (F.col("_record.pos") == F.col("_pos"))
    return (inside.groupBy("_file", "_record")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_pos", "_line"))),
                                          lambda x: x["_line"]), "\n").alias("_line"),
                 F.first(F.when(first, F.struct(*[F.col(c).alias(f"k_{c}") for c in kept])), ignorenulls=True).alias("k"))
            .select("_line", *[F.col(f"k.k_{c}").alias(c) for c in kept]).select(*lines.columns))


# --------------------------------------------------------------------------- rows --

def parse_lines(lines: DataFrame, columns, na_tokens=fixed.PANDAS_NA_TOKENS, seq_col: str = "seq") -> DataFrame:
    """SRC-03 rules on numbered lines.

    The first record of a file is its header; ``columns`` are taken by name, a column that
    the header lacks is NULL.  Records with more fields than the header are dropped, short
    ones end in NULLs, empty lines outside quotes never appear, NA tokens become NULL.  Line
    breaks inside a quoted field come back as one line feed.

    The first scan (headers and quotes, like a reader's look at a schema) runs when this is
    called; its results are small written tables.
    """
    splits = materialize(_splits(lines, seq_col), "file-splits")
    heads = splits.where("_block = 0 AND head_pos IS NOT NULL").select("_file", "head_pos", "head")
    kept = lines
    if not splits.where(F.exists("quotes", lambda q: q["out"] == 1)).isEmpty():     # some line may open a record
        records = materialize(long_records(splits), "long-records")
        places = _lines_of(records, splits)
        kept = (lines.withColumn("_pos", F.col(f"{seq_col}.pos"))
                .join(places, ["_file", "_block", "_pos"], "left_anti").drop("_pos")
                .unionByName(_joined(lines, places, seq_col)))
        over = records.join(heads.select("_file", F.col("head_pos").alias("pos")), ["_file", "pos"]).where("block = 0")
        if not over.isEmpty():                         # headers of several lines
            whole = _joined(lines, _lines_of(over.select(*records.columns), splits), seq_col)
            heads = heads.join(whole.select("_file", F.col("_line").alias("_whole")), "_file", "left").withColumn(
                "head", F.coalesce("_whole", "head"))
    heads = materialize(heads.select("_file", F.col("head_pos").alias("_first"), fields(F.col("head")).alias("_names")),
                        "file-heads")
    rows = kept.where(F.length("_line") > 0).join(heads, "_file").where(
        (F.col("_block") > 0) | (F.col(f"{seq_col}.pos") > F.col("_first")))
    rows = rows.withColumn("_fields", fields(F.col("_line"))).where(F.size("_fields") <= F.size("_names"))
    named = [F.get("_fields", (F.array_position("_names", c) - 1).cast("int")) for c in columns]
    out = rows.select(*[F.when(F.array_contains("_names", c), f).alias(c) for c, f in zip(columns, named)],
                      "_file", "_file_mtime", seq_col)
    return out.select(*[na_to_null(c, na_tokens).alias(c) for c in columns], "_file", "_file_mtime", seq_col)


def read_tolerant_tsv(spark: SparkSession, paths, columns, na_tokens=fixed.PANDAS_NA_TOKENS,
                      seq_col: str = "seq", **options) -> DataFrame:
    """SRC-03: header row, tab separated, all columns text."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return parse_lines(scan_lines(spark.read.options(**options), paths, seq_col), columns, na_tokens, seq_col)


def market_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Market to folder of the folders under ``root`` ("US" or "market=US")."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for entry in fs.listStatus(where) if fs.exists(where) else ():
        if entry.isDirectory():
            name = entry.getPath().getName()
            out[unquote(name.split("=", 1)[1]) if "=" in name else name] = entry.getPath().toString()
    return out


def discover_result_files(spark: SparkSession, root: str, columns, passed_markets=None,
                          day=None, na_tokens=fixed.PANDAS_NA_TOKENS) -> DataFrame:
    """SRC-04: rows of the files under ``root/<market>/`` modified on ``day`` (UTC).

    Only the folders of markets that passed the job gate (a DataFrame with ``market`` or
    a list; markets are as many as the config sheets name) are listed and read.  The day
    window is handed to the file listing (``modifiedAfter`` / ``modifiedBefore``) so old
    files are pruned before any read; the exact day test on
    ``_metadata.file_modification_time`` stays as the rule.  Adds ``market``.
    """
    if day is None:
        day = _dt.datetime.now(_dt.timezone.utc).date()
    elif not isinstance(day, _dt.date):
        day = _dt.date.fromisoformat(str(day))
    start = _dt.datetime.combine(day, _dt.time(), tzinfo=_dt.timezone.utc)
    end = start + _dt.timedelta(days=1)
    window = {"modifiedAfter": (start - _dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S"),
              "modifiedBefore": end.strftime("%Y-%m-%dT%H:%M:%S"), "recursiveFileLookup": "true"}
    folders = market_folders(spark, root)
    if passed_markets is not None:
        if isinstance(passed_markets, DataFrame):
            passed_markets = [r["market"] for r in passed_markets.select("market").distinct().collect()]
        folders = {m: path for m, path in folders.items() if m in set(passed_markets)}
    found = [scan_lines(spark.read.options(**window), [path]).withColumn("_market", F.lit(m))
             for m, path in sorted(folders.items())]
    if not found:
        names = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([], f"{names}, _file string, _file_mtime timestamp, seq struct<file:string,"
                                         "block:bigint,pos:bigint>, market string")
    lines = reduce(DataFrame.unionByName, found)
    lines = lines.where((F.col("_file_mtime") >= F.lit(start)) & (F.col("_file_mtime") < F.lit(end)))
    # The folder goes through parsing as part of the arrival order.
    lines = lines.withColumn("seq", F.struct("seq.file", "seq.block", "seq.pos", F.col("_market").alias("market")))
    rows = parse_lines(lines, columns, na_tokens)
    return rows.withColumn("market", F.col("seq.market")).withColumn(
        "seq", F.struct("seq.file", "seq.block", "seq.pos"))


def route_by_first_row(df: DataFrame, codes: DataFrame, code_col: str = "country_code",
                       seq_col: str = "seq", strict: bool = False) -> DataFrame:
    """SRC-05: each file goes to the market named by the code on its first row.

    One row per file (``min_by`` on arrival order, a partial aggregate) and the code looked
    up in the code map are written as a table of its own size, then joined back on the file
    path; the rows are only exchanged if that table is too large to be sent to them.
    Unknown codes give a NULL market, or an error in strict mode.
    """
    firsts = df.groupBy("_file").agg(F.min_by(F.col(code_col), F.col(seq_col)).alias("_code"))
    cmap = code_to_market(codes).select(F.col("market_code").cast("string").alias("_code"),
                                        F.col("market").alias("routed_market"))
    routed = firsts.join(cmap, "_code", "left")
    if strict:
        routed = routed.withColumn("routed_market", F.coalesce(
            "routed_market", F.raise_error(F.concat(F.lit("unknown country code: "),
                                                    F.coalesce("_code", F.lit("NULL"))))))
    routed = materialize(routed.select("_file", "routed_market"), "file-markets")
    return df.join(routed, "_file", "left")
