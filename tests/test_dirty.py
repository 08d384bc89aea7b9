"""Inputs that once lost rows, changed values or ended the job."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions.columns import parse_id, repair_mojibake
from ledgerlake.operators import ingest as I
from ledgerlake.operators import quality as Q
from ledgerlake.operators.dedupe import keep_first
from ledgerlake.operators.incremental import new_files, read_manifest, record_manifest
from ledgerlake.plans.run import JobConfig, run_job
from ledgerlake.sinks import versions as V
from ledgerlake.sources.generate import index_range, movements
from ledgerlake.session import scratch_path
from ledgerlake.sinks import layout as L
from ledgerlake.sources.raw import CSV_FILES, inventory
from ledgerlake.streaming.landing import good_rows, ingest_available

#: Amount bounds in euros per operation type.
BOUNDS = {
    "cotisation": (50, 2500), "prime_exceptionnelle": (50, 2500), "remboursement": (-5000, -100), "commission": (25, 500),
    "frais_gestion": (25, 500), "retrocession": (100, 1000), "ajustement_cotisation": (-200, 200), "ajustement_remboursement": (-200, 200),
    "regularisation": (-200, 200), "reajustement_prime": (-200, 200), "penalite_retard": (15, 300), "penalite_resiliation": (15, 300),
    "correction_comptable": (-500, 500), "annulation_operation": (-500, 500), "virement_interne": (100, 10000),
    "provision_sinistre": (500, 15000), "liberation_provision": (-15000, -500), "taxe_assurance": (5, 100), "bonus_malus": (-150, 150),
}


def test_amount_bounds_are_the_written_ones():
    assert {t: (lo / 100, hi / 100) for t, (lo, hi) in zip(model.OPERATION_TYPES, model.AMOUNT_BOUNDS_CENTS, strict=True)} == BOUNDS


def test_equal_rows_without_id_all_stay(spark):
    df = spark.createDataFrame([(None, "a")] * 3 + [(1, "b"), (1, "c")], "mouvement_no long, v string")
    assert sorted(r.v for r in keep_first(df, "mouvement_no", []).collect()) == ["a", "a", "a", "b"]


def test_ids_labels_and_amounts_do_not_change(spark):
    df = spark.createDataFrame([("M" + "0" * 60 + "123456789", "SÃO"), ("M-5", "santÃ©"), ("M 7", "Ã\ufffd"), ("M0000012", "Ãx"), ("M9\n", None)], "id string, label string")
    got = df.select(parse_id("id").alias("n"), repair_mojibake("label").alias("l")).collect()
    assert [r.n for r in got] == [123456789, None, None, 12, None]
    assert [r.l for r in got] == ["SÃO", "santé", "Ã\ufffd", "Ãx", None]
    raw = spark.createDataFrame([("M1", "2025-06-01", "auto", "cotisation", m, "AG_001", "FR") for m in ("60.129", "60.10", "60", "60.1200", "9999999999.99", "x")], model.RAW_SCHEMA)
    t = I.type_movements(raw).collect()
    assert [r.montant for r in t] == [None, Decimal("60.10"), Decimal("60.00"), Decimal("60.12"), Decimal("9999999999.99"), None]
    assert t[0].reason == "bad_number" and t[0].raw_line == "M1,2025-06-01,auto,cotisation,60.129,AG_001,FR" and t[1].raw_line is None


def test_large_and_missing_amounts(spark):
    df = spark.createDataFrame([("cotisation", 999_999_999_999, "a")] * 2 + [("cotisation", 5, "b"), ("cotisation", None, "b")], "type_op string, cents long, agence_id string")
    assert Q.stats_by_type(df).first().max_cents == 999_999_999_999
    assert Q.anomalies_zscore(df).count() == 0
    assert Q.anomalies_bounds(df).count() == 4


def test_compressed_and_nested_landings_reach_inventory_and_stream(spark):
    raw = scratch_path(spark, "raw")
    L.land_movements(spark, raw, 100, 2, compression="gzip")
    L.land_movements(spark, f"{raw}/mouvements", 50, 1, start=100)
    assert inventory(spark, raw, glob=CSV_FILES).count() == 3
    staging, checkpoint = scratch_path(spark, "staging"), scratch_path(spark, "ckpt")
    ingest_available(spark, raw, staging, checkpoint)
    assert good_rows(spark, staging).count() == 150


def test_manifest_loop_from_the_first_run(spark):
    raw, manifest = scratch_path(spark, "raw"), scratch_path(spark, "manifest")
    L.land_movements(spark, raw, 10, 2)
    counts = []
    for k in range(3):
        fresh = new_files(spark, raw, read_manifest(spark, manifest))
        counts.append(fresh.count())
        record_manifest(spark, fresh, manifest)
        if k == 0:
            L.land_movements(spark, raw, 10, 1, start=10, mode="append")
    assert counts == [2, 1, 0]


def test_job_runs_month_after_month_and_again(spark):
    base = scratch_path(spark, "lake")
    june = JobConfig(base=base, n_rows=400, n_shards=2, run_id="june")
    months = lambda: {r.mois: r.n for r in V.read_months(spark, june.paths.tables).groupBy("mois").agg(F.count("*").alias("n")).collect()}
    run_job(spark, june)
    run_job(spark, JobConfig(base=base, n_rows=300, n_shards=2, start_date="2025-07-01", days=31, run_id="july"))
    run_job(spark, june)
    assert months() == {"2025-06": 400, "2025-07": 300}
    run_job(spark, JobConfig(base=base, n_rows=3, n_shards=2, seed=1, run_id="small-june"))
    assert months() == {"2025-06": 3, "2025-07": 300}
    run_job(spark, JobConfig(base=base, n_rows=500, n_shards=2, seed=1, start_date="2025-06-20", run_id="half-june"))
    table = V.read_months(spark, june.paths.tables)
    assert table.filter("date_op >= '2025-06-20' and date_op <= '2025-07-19'").count() == 500
    assert table.filter("date_op < '2025-06-20'").count() == movements(index_range(spark, 3), seed=1).filter("date_op < '2025-06-20'").count()
    assert table.filter("date_op > '2025-07-19'").count() == movements(index_range(spark, 300), start_date="2025-07-01", days=31).filter("date_op > '2025-07-19'").count()
