"""The job runner end to end on folders built from the driver tables."""
import os

import pytest
from pyspark.sql import functions as F

from itemtrack.plans import bindings as B, run
from itemtrack.plans.catalog import REASON_NAME, tracker as bound_tracker
from itemtrack.sources import sinks
from itemtrack.sources.sinks import VersionedTable

from conftest import SF_SMALL


def write_sheet(df, path):
    df.toPandas().to_csv(path, index=False)


def test_status_and_export_and_intake_jobs(spark, tmp_dir):
    cfg = os.path.join(tmp_dir, "config")
    os.makedirs(cfg)
    write_sheet(B.view(spark, SF_SMALL, "v_codes").orderBy("seq").select("market", "market_code"),
                f"{cfg}/codes.csv")
    write_sheet(B.view(spark, SF_SMALL, "v_obs_rules").orderBy("market", "rule_no")
                .select("market", "keyword", "blocker_type"), f"{cfg}/rules.csv")
    write_sheet(B.view(spark, SF_SMALL, "v_allow"), f"{cfg}/allow.csv")
    tracker = bound_tracker(spark, SF_SMALL).drop("seq")
    store = VersionedTable(spark, f"{tmp_dir}/tracker")
    store.commit(tracker)
    results = f"{tmp_dir}/results"
    obs = B.view(spark, SF_SMALL, "v_obs_raw").withColumn("file_no", F.col("seq") % 2)
    sinks.write_result_files(obs, results, folder_col="marketplace_id")

    with pytest.raises(FileNotFoundError):                  # no gate sheet: no run
        run.status(spark, f"{tmp_dir}/tracker", results, cfg, f"{tmp_dir}/out")
    with open(f"{cfg}/jobs.csv", "w") as fh:                # folders are market codes here
        fh.write("market,slot_no,phase,status_text\n1,1,result,Success\n2,1,result,Success\n")
    v = run.status(spark, f"{tmp_dir}/tracker", results, cfg, f"{tmp_dir}/out")
    assert v == 1 and store.read().count() == tracker.count()
    decisions = spark.read.parquet(f"{tmp_dir}/out/status/decisions")
    assert decisions.count() > 0
    assert {r.next_status for r in decisions.select("next_status").distinct().collect()} <= \
        {"WIP", "nonaction", "unblocked"}

    core = f"{tmp_dir}/core"
    B.view(spark, SF_SMALL, "v_core_export").drop("seq").write.parquet(core)
    v = run.export_dates(spark, f"{tmp_dir}/tracker", core, cfg, f"{tmp_dir}/out")
    assert v == 2
    report = spark.read.parquet(f"{tmp_dir}/out/export_dates/report")
    assert report.where("updated").count() >= 1

    hist = VersionedTable(spark, f"{tmp_dir}/history")
    hist.commit(tracker.limit(0))
    inflow = f"{tmp_dir}/inflow"
    B.view(spark, SF_SMALL, "v_inflow").drop("seq").write.parquet(inflow)
    tv, hv = run.intake(spark, f"{tmp_dir}/tracker", f"{tmp_dir}/history", inflow, f"{tmp_dir}/out")
    assert (tv, hv) == (3, 1)
    assert hist.read().where("status = 'unblocked'").count() == hist.read().count() > 0


def test_dimensions_job(spark, tmp_dir):
    cfg = os.path.join(tmp_dir, "config")
    os.makedirs(cfg)
    write_sheet(B.view(spark, SF_SMALL, "v_codes").orderBy("seq").select("market", "market_code"),
                f"{cfg}/codes.csv")
    write_sheet(B.view(spark, SF_SMALL, "v_dim_quota").orderBy("slot_no")
                .select("market", "capacity", "slot_ref"), f"{cfg}/quotas.csv")
    write_sheet(B.view(spark, SF_SMALL, "v_dim_jobs").orderBy("slot_no")
                .select("market", "slot_no", "phase", "status_text"), f"{cfg}/jobs.csv")
    tracker = bound_tracker(spark, SF_SMALL).drop("seq")
    store = VersionedTable(spark, f"{tmp_dir}/tracker")
    store.commit(tracker)
    warehouse = f"{tmp_dir}/warehouse"
    B.view(spark, SF_SMALL, "v_dimensions").write.parquet(warehouse)
    v = run.dimensions(spark, f"{tmp_dir}/tracker", warehouse, cfg, f"{tmp_dir}/out", REASON_NAME)
    assert v == 1 and store.read().count() == tracker.count()
    from pyspark.errors import AnalysisException
    from itemtrack.operators import queues

    def rows(name):
        try:   # an empty partitioned snapshot has no data files
            return spark.read.parquet(f"{tmp_dir}/out/dimensions/{name}").count()
        except AnalysisException:
            return 0

    assert rows("assigned") > 0
    assert rows("assigned") + rows("unassigned") == queues.dimension_queue(tracker, REASON_NAME).count()
