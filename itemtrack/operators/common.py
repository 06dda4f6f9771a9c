"""Building blocks shared by the operators: joins whose hot keys can be split, keep-first,
ordered distinct lists and a scalable rank within a few large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from itemtrack.session import scratch_path


IGNORING_CASE = "UTF8_LCASE"


def any_case(c) -> Column:
    """A text column that is compared, grouped and joined whatever its case."""
    return F.collate(F.col(c) if isinstance(c, str) else c, IGNORING_CASE)


def key_mark(df: DataFrame, cols, ignore_case: bool = False) -> Column:
    """64-bit hash of the key.  Hashes of collated texts differ with the case, so texts that are
    compared whatever their case are folded first: in lower case, and a final sigma (which
    ``lower`` sets by its place in the word) like any other, as the collation does."""
    if not ignore_case:
        return F.xxhash64(*cols)
    texts = text_columns(df, cols)
    return F.xxhash64(*[F.translate(F.lower(c), "ς", "σ") if c in texts else F.col(c) for c in cols])


def text_columns(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, StringType)]


def join_split(left: DataFrame, right: DataFrame, on, how: str = "left", ignore_case: bool = False) -> DataFrame:
    """Join on ``on`` so that adaptive execution can split a hot key.

    A side that was just aggregated (or ranked) by the join key is joined without an
    exchange of its own, and the skew rule only splits joins whose both sides were
    exchanged for them.  A further equality on the hash of the key gives both sides
    such an exchange; the key columns themselves still decide.  With ``ignore_case`` texts
    match whatever their case and the key columns are those of ``left``.
    """
    on = [on] if isinstance(on, str) else list(on)
    if ignore_case:
        def keyed(df):
            texts = text_columns(df, on)
            return df.withColumns({"_key_hash": key_mark(df, on, True), **{
                f"_match_{c}": any_case(c) if c in texts else F.col(c) for c in on}})

        names = ["_key_hash", *[f"_match_{c}" for c in on]]
        rest = [c for c in left.columns if c not in on]
        joined = keyed(left).join(keyed(right).drop(*on), names, how).drop(*names)
        return joined.select(*on, *rest, *[c for c in joined.columns if c not in left.columns])
    mark = F.xxhash64(*on)
    return (left.withColumn("_key_hash", mark)
            .join(right.withColumn("_key_hash", mark), ["_key_hash", *on], how).drop("_key_hash"))


def literal_table(spark, rows, schema: str) -> DataFrame:
    """A small fixed table built from literals on the JVM side (it plans as a
    local relation; no Python worker is started to scan it)."""
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under the cluster's checkpoint folder
    (``spark.checkpoint.dir``) and read it from there.

    Used where one intermediate feeds several branches of a plan (a diamond) or
    must keep its values when recomputed (positions, partition ids).  The plan
    is computed once, the read-back scan gets column pruning and filter
    pushdown, and the lineage is cut, so lost executors do not recompute it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe_on(left: DataFrame, right: DataFrame, cols) -> Column:
    """Null-safe equality on several columns (``<=>``); still an equi-join key."""
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def _by_key(df: DataFrame, keys, order_col: str, pick, name: str, ignore_case: bool = False) -> DataFrame:
    keys = list(keys)
    if ignore_case:                                  # the key is written as in the row that is kept
        texts = text_columns(df, keys)
        match = {f"_match_{c}": any_case(c) if c in texts else F.col(c) for c in keys}
        whole = df.withColumns(match)
        kept = pick(F.struct(*df.columns), F.col(order_col)).alias(name)
        return whole.groupBy(*match).agg(kept).select(f"{name}.*")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    # Wide keys (several columns, long texts) are led by their 64-bit hash, so the
    # sort-based aggregation mostly compares one long; the key columns still
    # decide the groups, so a collision cannot merge two keys.
    lead = [F.xxhash64(*keys).alias("_h")] if len(keys) >= 3 else []
    packed = pick(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias(name)
    return (df.groupBy(*lead, *keys).agg(packed)
            .select(*keys, f"{name}.*").select(*df.columns))


def keep_first(df: DataFrame, keys, order_col: str = "seq", ignore_case: bool = False) -> DataFrame:
    """First row per key by ``order_col`` (pandas ``drop_duplicates(keep='first')``).

    Written as ``min_by`` over a struct so the aggregate is partial: a hot key
    is reduced map-side before the shuffle instead of landing whole in one task.
    """
    return _by_key(df, keys, order_col, F.min_by, "_first", ignore_case)


def keep_last(df: DataFrame, keys, order_col: str = "seq", ignore_case: bool = False) -> DataFrame:
    """Last row per key by ``order_col`` (repeated keyed updates: last one wins)."""
    return _by_key(df, keys, order_col, F.max_by, "_last", ignore_case)


def ordered_distinct_list(df: DataFrame, keys, value: str, order_col: str = "seq",
                          out: str = "values") -> DataFrame:
    """AGG-05 core: distinct ``value`` per key in order of first appearance.

    Two stages: (key, value) -> min(order) first, so lists hold distinct values
    only and the pre-aggregation is partial; then one sorted array per key.
    """
    keys = list(keys)
    firsts = df.groupBy(*keys, value).agg(F.min(order_col).alias("_first"))
    return (firsts.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_first"), F.col(value)))).alias("_l"))
            .select(*keys, F.transform("_l", lambda x: x[value]).alias(out)))


def rank_within(df: DataFrame, group: str, order_cols, out: str = "rank",
                num_partitions: int | None = None, store: str | None = None) -> DataFrame:
    """Dense 1-based position of each row inside ``group`` by ``order_cols``.

    A window partitioned by ``group`` puts a whole group in one task, which does
    not scale when there are only a handful of groups (markets).  Instead:

    1. range-partition by (group, order) and sort inside partitions, so every
       partition holds one contiguous run of keys; a hot group spans many;
    2. number rows inside each partition (``monotonically_increasing_id`` right
       after the sort) and materialize them in the checkpoint folder, so partition
       ids and positions keep their values even if executors are lost later;
    3. count rows per (partition, group): at most partitions + groups rows; prefix
       sums give each run's offset.  Rows of a null group are ranked like any other.

    The written table is at ``store`` (default: a fresh scratch folder); the caller owns
    it and may remove it (:func:`itemtrack.session.remove_path`) once the result is used.
    """
    order_cols = list(order_cols)
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(num_partitions, group, *order_cols)
              .sortWithinPartitions(group, *order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "rank", store)
    runs = (ranged.groupBy("_pid", group)
            .agg(F.min("_pos").alias("_p0"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = runs.select(F.col("_pid").alias("_run"), F.col(group).alias("_group"), "_p0", "_before")
    same = (ranged["_pid"] == runs["_run"]) & ranged[group].eqNullSafe(runs["_group"])
    return (ranged.join(runs, same)
            .withColumn(out, F.col("_pos") - F.col("_p0") + F.col("_before") + 1)
            .drop("_pid", "_pos", "_run", "_group", "_p0", "_before"))
