"""SNK-01 snapshots, result-file writer and a versioned table folder.

Keyed changes never overwrite the folder being read: each run writes a new
version folder and the readers pick the newest published one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack.schemas import OBSERVATION_FILE_COLUMNS


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by="market", mode: str = "overwrite") -> str:
    """SNK-01: write a full result (flags, updates, decisions, work queue)."""
    writer = df.write.mode(mode)
    if partition_by and (isinstance(partition_by, str) and partition_by in df.columns
                         or not isinstance(partition_by, str)):
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str)
                                      else partition_by))
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_result_files(df: DataFrame, root: str, columns=OBSERVATION_FILE_COLUMNS,
                       folder_col: str = "market", file_col: str = "file_no",
                       order_col: str = "seq", line_col: str | None = None,
                       files_per_group: int = 1) -> str:
    """Write rows as tab-separated result files under ``root/<folder>/``, each file
    with its header line first and its rows in ``order_col`` order.

    ``line_col`` may carry a pre-built raw line (for files with malformed lines);
    otherwise the columns are joined with tabs.  Rows of one (folder, file) group
    are hash-partitioned together so one task writes each file; a hot group is
    spread over ``files_per_group`` files (its own sub-folders), each with a header.
    """
    line = F.col(line_col) if line_col else F.concat_ws("\t", *[
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    part = (F.pmod(F.xxhash64(F.col(order_col)), F.lit(files_per_group)) if files_per_group > 1
            else F.lit(0)).cast("string")
    body = df.select(F.col(folder_col).cast("string").alias("_folder"),
                     F.col(file_col).cast("string").alias("_fileno"), part.alias("_split"),
                     F.lit(1).alias("_part"), F.col(order_col).alias("_ord"), line.alias("value"))
    heads = (body.select("_folder", "_fileno", "_split").distinct()
             .select("_folder", "_fileno", "_split", F.lit(0).alias("_part"),
                     F.lit(None).cast(body.schema["_ord"].dataType).alias("_ord"),
                     F.lit("\t".join(columns)).alias("value")))
    keys = ["_folder", "_fileno", "_split"]
    (body.unionByName(heads)
     .repartition(*keys)
     .sortWithinPartitions(*keys, "_part", "_ord")
     .select(*keys, "value")
     .write.mode("overwrite").partitionBy(*keys)
     .option("compression", "none").text(root))
    return root


_NO_MARKER = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


class VersionedTable:
    """A table folder holding ``v=<n>`` versions; the newest published one is current.

    A version is written in full, checked if the caller asks for it, and only then published:
    by its own ``_SUCCESS`` marker or, if it is ``_linked`` to a record, by that record, which
    publishes the versions of several tables at once (:func:`commit_together`).  A version may
    carry a tag in its folder name (``v=<n>.<tag>``): what was applied and that it was applied
    are published by the same act.  A version that replaces some partitions only holds their
    files and names in ``_kept`` the folders of the others.  Uses the Hadoop file system of the
    session, so it works on any shared store the cluster can reach; one writer at a time is
    assumed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(self._conf)

    # -- small files ------------------------------------------------------------------

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._Path(path))

    def _read_text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._Path(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _partitions(self, folder: str) -> list[str]:
        """Partition folder names that a version holds itself."""
        return sorted(st.getPath().getName() for st in self._fs.listStatus(self._Path(f"{self.root}/{folder}"))
                      if st.isDirectory() and "=" in st.getPath().getName())

    # -- versions ---------------------------------------------------------------------

    def _published(self, folder: str) -> bool:
        path = f"{self.root}/{folder}"
        if self._exists(f"{path}/_SUCCESS"):
            return True
        return self._exists(f"{path}/_linked") and self._exists(self._read_text(f"{path}/_linked"))

    def folders(self) -> dict[int, str]:
        """Folder names of the published versions."""
        root = self._Path(self.root)
        if not self._fs.exists(root):
            return {}
        names = [st.getPath().getName() for st in self._fs.listStatus(root)]
        return {int(name[2:10]): name for name in sorted(names) if name.startswith("v=") and self._published(name)}

    def versions(self) -> list[int]:
        return sorted(self.folders())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def has_tag(self, tag: str) -> bool:
        return any(name[10:] == f".{tag}" for name in self.folders().values())

    def path(self, version: int) -> str:
        return f"{self.root}/{self.folders().get(version, f'v={version:08d}')}"

    def layout(self, version: int) -> dict[str, str]:
        """Partition name to the folder of the version that holds it."""
        own = self.path(version).rsplit("/", 1)[1]
        kept = {}
        if self._exists(f"{self.root}/{own}/_kept"):
            kept = dict(line.split("\t") for line in self._read_text(f"{self.root}/{own}/_kept").splitlines())
        return {**kept, **{name: own for name in self._partitions(own)}}

    def read(self, schema=None, version: int | None = None) -> DataFrame:
        """The current version, or the one asked for."""
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self._frame(self.path(v).rsplit("/", 1)[1], schema)

    def _frame(self, own: str, schema) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if not self._exists(f"{self.root}/{own}/_kept"):
            return reader.parquet(f"{self.root}/{own}")
        kept = dict(line.split("\t") for line in self._read_text(f"{self.root}/{own}/_kept").splitlines())
        held = {**kept, **{name: own for name in self._partitions(own)}}
        if not held:
            return self.spark.createDataFrame([], schema) if schema is not None else reader.parquet(f"{self.root}/{own}")
        frame = reader.option("basePath", self.root).parquet(*[f"{self.root}/{f}/{name}" for name, f in held.items()])
        return frame.drop("v")                      # the version's folder is no column of the table

    # -- writing ----------------------------------------------------------------------

    def prepare(self, df: DataFrame, partition_by="market", tag: str | None = None, check=None,
                replaces=None) -> tuple[int, str]:
        """Write the next version without publishing it; returns its number and folder.

        ``check`` is called with the written version as read back; what it raises leaves the
        version unpublished.  ``replaces``: names of the ``partition_by`` values that ``df`` holds
        in full; all other partitions are kept from the current version and not touched.
        """
        current = self.current_version()
        version = 0 if current is None else current + 1
        own = f"v={version:08d}" + (f".{tag}" if tag else "")
        writer = df.write.mode("overwrite").option(*_NO_MARKER)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.root}/{own}")
        if replaces is not None and current is not None:
            escape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
            gone = {escape(partition_by, m) for m in replaces}
            kept = {name: folder for name, folder in self.layout(current).items()
                    if name not in gone and name not in self._partitions(own)}
            self._write_text(f"{self.root}/{own}/_kept", "".join(f"{n}\t{f}\n" for n, f in kept.items()))
        if check is not None:
            check(self._frame(own, df.schema))
        return version, own

    def commit(self, df: DataFrame, partition_by="market", tag: str | None = None, check=None,
               replaces=None) -> int:
        """Write ``df`` as the next version, check it, publish it and return its number."""
        version, own = self.prepare(df, partition_by, tag, check, replaces)
        self._write_text(f"{self.root}/{own}/_SUCCESS", "")
        return version

    def vacuum(self, keep) -> list[str]:
        """Remove the folders of versions that are neither in ``keep`` nor current nor named by
        such a version; returns their names."""
        folders = self.folders()
        if not folders:
            return []
        wanted = {v for v in (*keep, max(folders)) if v in folders}
        needed = {folders[v] for v in wanted}.union(*[self.layout(v).values() for v in wanted])
        gone = [name for name in folders.values() if name not in needed]
        for name in gone:
            self._fs.delete(self._Path(f"{self.root}/{name}"), True)
        return gone


def commit_together(parts, record_root: str) -> dict[str, int]:
    """Publish the next versions of several tables by one act.

    ``parts``: {name: (table, df)} or {name: (table, df, options of prepare)}.  All versions are
    written and checked first; each is linked to one record file, and creating that file
    publishes them all.  A job that dies before leaves every table at its old version.
    Returns the versions by name.
    """
    record = f"{record_root.rstrip('/')}/commit-{uuid.uuid4().hex}"
    made = {}
    for name, (table, df, *options) in parts.items():
        version, own = table.prepare(df, **(options[0] if options else {}))
        table._write_text(f"{table.root}/{own}/_linked", record)
        made[name] = version
    tables = [part[0] for part in parts.values()]
    tables[0]._write_text(record, "".join(f"{n}={v}\n" for n, v in made.items()))
    return made


def read_together(tables: dict, schema=None) -> dict[str, DataFrame]:
    """The current versions of several tables, all from before or all from after any commit
    that publishes them together."""
    while True:
        versions = {name: table.current_version() for name, table in tables.items()}
        if versions == {name: table.current_version() for name, table in tables.items()}:
            return {name: table.read(schema, versions[name]) for name, table in tables.items()}
