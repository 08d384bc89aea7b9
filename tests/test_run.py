"""The whole job: stages, counts, metrics table."""

from pyspark.sql import functions as F

from ledgerlake.plans.run import JobConfig, run_job
from ledgerlake.session import scratch_path
from ledgerlake.sinks import versions as V


def test_run_job_stages_and_metrics(spark):
    cfg = JobConfig(base=scratch_path(spark, "job"), n_rows=3000, n_shards=3, seed=5)
    m = {r.stage: r for r in run_job(spark, cfg).collect()}
    assert [m[s].n_rows for s in ("land_raw", "parse_typed", "quarantined", "publish")] == [3000, 3000, 0, 3000]
    assert m["contract_report"].n_rows == 9
    assert m["land_raw"].rows_per_sec > 0
    report = spark.read.parquet(cfg.paths.metrics).filter(F.col("run_id") == cfg.run_id)
    assert report.filter(F.col("n_breaches") > 0).count() == 0
    published = V.read_months(spark, cfg.paths.tables)
    assert published.select("pays").distinct().count() == 5 and published.count() == 3000


def test_a_finished_run_is_not_done_again_and_a_changed_one_is(spark):
    base, calls = scratch_path(spark, "job"), []
    run = lambda **kw: run_job(spark, JobConfig(base=base, run_id="one", n_shards=2, **kw), hook=lambda *x: calls.append(x)).collect()
    run(n_rows=200)
    assert len(calls) == 8
    assert {r.attempt for r in run(n_rows=200)} == {1} and len(calls) == 8
    assert {r.attempt for r in run(n_rows=100)} == {2} and len(calls) == 16
    assert V.read_months(spark, f"{base}/delta/mouvements").count() == 100
    assert spark.read.parquet(f"{base}/quality_metrics").count() == 9
