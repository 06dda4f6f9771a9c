"""SRC-01 tracker scan, SRC-02 core-export scan, SRC-07 lookup tables.

Tables live as Parquet partitioned by ``market`` (one folder per market replaces
one database per market), so a market predicate prunes partitions and the other
predicates and the projection reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from itemtrack import schemas
from itemtrack.functions.scalars import zero_date_to_null


def normalize_tracker(df: DataFrame) -> DataFrame:
    """Bring raw tracker rows to T1: zero dates -> NULL (FLT-06), DDL types and order.

    Raw rows may hold the export / double-check dates as text (``0000-00-00``).
    Extra columns such as ``seq`` are kept at the end.
    """
    fixes = {}
    for name in ("export_date", "double_check_date", "action_date"):
        if name in df.columns:
            fixes[name] = zero_date_to_null(name)
    if "export_text" in df.columns and "export_date" not in df.columns:
        fixes["export_date"] = zero_date_to_null("export_text")
    out = df.withColumns(fixes)
    missing = [f for f in schemas.TRACKER_SCHEMA.fields if f.name not in out.columns]
    out = out.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TRACKER_SCHEMA.fields]
    extra = [c for c in out.columns if c not in schemas.TRACKER_COLUMNS and c != "export_text"]
    return out.select(*typed, *extra)


def scan_tracker(source, markets=None, columns=None, where=None,
                 spark: SparkSession | None = None) -> DataFrame:
    """SRC-01: tracker rows of the given markets with projection and predicate.

    ``source`` is a path of a market-partitioned Parquet table or a DataFrame.
    """
    df = spark.read.parquet(source) if isinstance(source, str) else source
    if markets is not None:
        df = df.where(F.col("market").isin(list(markets)))
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_core_export(source, spark: SparkSession | None = None,
                     date_col: str = "exportable_date") -> DataFrame:
    """SRC-02: (item_id, market_code, exportable_date) with the zero date as NULL."""
    df = spark.read.parquet(source) if isinstance(source, str) else source
    return df.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.col("market_code").cast("int").alias("market_code"),
        zero_date_to_null(date_col).alias("exportable_date"),
    )


def read_jdbc_by_market(spark: SparkSession, url: str, table: str, markets,
                        properties: dict | None = None) -> DataFrame:
    """SRC-01 over a database: one JDBC partition per market predicate."""
    return spark.read.jdbc(url, table, predicates=market_predicates(markets), properties=properties or {})


def market_predicates(markets) -> list[str]:
    """One SQL predicate per market; quotes and backslashes in a name stay part of the name."""
    return ["market = '" + m.replace("\\", "\\\\").replace("'", "''") + "'" for m in markets]


def read_lookup(spark: SparkSession, path: str, schema, fmt: str = "csv",
                order_col: str | None = None, header: bool = True) -> DataFrame:
    """SRC-07: a small config sheet exported as CSV / Parquet.

    Sheet order matters (rule order, slot order, last duplicate wins), so an
    explicit ``order_col`` is numbered when the sheet lacks one: file path then
    row position, computed right after the scan.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        df = reader.option("header", header).csv(path)
    else:
        df = reader.format(fmt).load(path)
    if order_col and order_col not in schema.fieldNames():
        df = (df.withColumn("_file", F.col("_metadata.file_path"))
                .withColumn("_pos", F.monotonically_increasing_id()))
        df = df.withColumn(order_col, F.struct("_file", "_pos")).drop("_file", "_pos")
    return df


def number_rows(df: DataFrame, out: str, partition=None, order=None) -> DataFrame:
    """Number a config sheet's rows 1.. per ``partition`` (rule_no, slot_no).

    Config sheets are small and bounded, so a window is the plain way here.
    """
    from pyspark.sql import Window
    w = Window.orderBy(*order) if partition is None else Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w).cast("int"))
