"""Result files: tolerant TSV reads, discovery by day, routing, streaming ingest."""
import datetime as dt
import os
import time

from pyspark.sql import functions as F

from itemtrack import schemas
from itemtrack.sources import sinks, tsv
from itemtrack.sources.sinks import VersionedTable

HEADER = "\t".join(schemas.OBSERVATION_FILE_COLUMNS)


def write(path, lines, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER] + lines) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_tolerant_rules(spark, tmp_dir):
    write(f"{tmp_dir}/US/a.txt", [
        "0012\t1\tOperationalRule\ttoo large\t1",        # ok
        "13\t1\tOperationalRule",                          # short: padded
        "",                                                # empty: skipped
        "14\t1\tOperationalRule\tx\t1\textra",             # long: dropped
        "15\t1\tOperationalRule\tNA\tnull",                # NA tokens
    ])
    rows = tsv.read_tolerant_tsv(spark, f"{tmp_dir}/US", schemas.OBSERVATION_FILE_COLUMNS) \
        .orderBy("seq").collect()
    assert [r.asin for r in rows] == ["0012", "13", "15"]
    assert rows[1].restriction_reasons is None and rows[1].country_code is None
    assert rows[2].restriction_reasons is None and rows[2].country_code is None


def test_discovery_by_day_and_gate(spark, tmp_dir):
    write(f"{tmp_dir}/US/new.txt", ["1\t1\tOperationalRule\tx\t1"])
    write(f"{tmp_dir}/US/old.txt", ["2\t1\tOperationalRule\tx\t1"], mtime=time.time() - 3 * 86400)
    write(f"{tmp_dir}/DE/new.txt", ["3\t3\tOperationalRule\tx\t3"])
    os.makedirs(f"{tmp_dir}/JP", exist_ok=True)                        # empty folder
    today = dt.datetime.now(dt.timezone.utc).date()
    got = tsv.discover_result_files(spark, tmp_dir, schemas.OBSERVATION_FILE_COLUMNS,
                                    passed_markets=["US", "JP"], day=today)
    assert [(r.market, r.asin) for r in got.collect()] == [("US", "1")]


def test_route_by_first_row(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.txt", ["1\t2\tOperationalRule\tx\t2", "2\t1\tOperationalRule\tx\t1"])
    write(f"{tmp_dir}/in/b.txt", ["3\t1\tOperationalRule\tx\t1"])
    write(f"{tmp_dir}/in/c.txt", ["4\t7\tOperationalRule\tx\t7"])
    codes = spark.createDataFrame([("US", 1, 1), ("UK", 2, 2)], "market string, market_code int, seq int")
    rows = tsv.read_tolerant_tsv(spark, f"{tmp_dir}/in", schemas.OBSERVATION_FILE_COLUMNS)
    got = {r.asin: r.routed_market for r in tsv.route_by_first_row(rows, codes).collect()}
    assert got == {"1": "UK", "2": "UK", "3": "US", "4": None}


def test_result_file_writer_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "1", "OperationalRule", "x", "1", 1, "US", 0),
                                ("2", "1", "OperationalRule", None, "1", 2, "US", 0),
                                ("3", "3", "Other", "y", "3", 3, "DE", 1)],
                               "asin string, marketplace_id string, contributions string, "
                               "restriction_reasons string, country_code string, seq long, "
                               "market string, file_no int")
    root = sinks.write_result_files(df, tmp_dir + "/out")
    back = tsv.read_tolerant_tsv(spark, root, schemas.OBSERVATION_FILE_COLUMNS,
                                 recursiveFileLookup="true")
    assert sorted((r.asin, r.restriction_reasons) for r in back.collect()) == \
        [("1", "x"), ("2", None), ("3", "y")]


def test_header_names_and_widths(spark, tmp_dir):
    """Fields go by each file's own header; its width says which lines are too long."""
    root = f"{tmp_dir}/in put/x=1"
    write(f"{root}/a.txt", ["7\t1\tC\tR\t2", "8\t1\tC\tR\t2\tmore"])
    with open(f"{root}/b.txt", "w") as fh:
        fh.write("marketplace_id\tasin\textra\tcontributions\n3\t9\te\tK\n3\t10\te\tK\ttoo much\n\n4\t11\n")
    rows = tsv.read_tolerant_tsv(spark, root, schemas.OBSERVATION_FILE_COLUMNS).collect()
    got = sorted((r.asin, r.marketplace_id, r.contributions, r.restriction_reasons, r.country_code) for r in rows)
    assert got == [("11", "4", None, None, None), ("7", "1", "C", "R", "2"), ("9", "3", "K", None, None)]


def test_only_passed_folders_are_read(spark, tmp_dir):
    import datetime
    root = f"{tmp_dir}/in put"
    write(f"{root}/US/a.txt", ["1\t1\tC\tR\t1"])
    write(f"{root}/market=U%20K/a.txt", ["2\t2\tC\tR\t2"])
    write(f"{root}/DE/a.txt", ["3\t3\tC\tR\t3"])
    day = datetime.datetime.now(datetime.timezone.utc).date()
    gate = spark.createDataFrame([("US",), ("U K",), ("JP",)], "market string")
    found = tsv.discover_result_files(spark, root, schemas.OBSERVATION_FILE_COLUMNS, gate, day)
    assert sorted((r.market, r.asin) for r in found.collect()) == [("U K", "2"), ("US", "1")]
    assert not [f for f in found.inputFiles() if "/DE/" in f]
    assert tsv.discover_result_files(spark, root, schemas.OBSERVATION_FILE_COLUMNS, [], day).count() == 0


def test_quoting_like_the_reference_reader(spark, tmp_dir):
    write(f"{tmp_dir}/q/a.txt", ['1\t1\tOperationalRule\t"says ""too large"", \\\\ ok"\t1'])
    row = tsv.read_tolerant_tsv(spark, f"{tmp_dir}/q", schemas.OBSERVATION_FILE_COLUMNS).first()
    assert row.restriction_reasons == 'says "too large", \\\\ ok'


def test_versioned_table_ignores_unfinished_versions(spark, tmp_dir):
    store = VersionedTable(spark, f"{tmp_dir}/t")
    df = spark.createDataFrame([("a", "US")], "item_id string, market string")
    assert store.commit(df) == 0
    # a commit that died half-way leaves a folder without _SUCCESS
    os.makedirs(f"{tmp_dir}/t/v=00000001/market=US")
    with open(f"{tmp_dir}/t/v=00000001/market=US/part-0.parquet", "w") as fh:
        fh.write("partial")
    assert store.current_version() == 0 and store.read().count() == 1
    assert store.commit(df.union(df)) == 1                 # the retry overwrites it
    assert store.current_version() == 1 and store.read().count() == 2
