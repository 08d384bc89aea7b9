"""Incremental landing: the file stream reads only files it has not seen."""

import os
import random
import subprocess
import sys
from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake import model

from ledgerlake.operators.incremental import ingest_new, new_files, read_manifest, record_manifest
from ledgerlake.plans import files as _files  # noqa: F401  (registers file-based queries)
from ledgerlake.plans.catalogue import QUERIES, dealt_index
from ledgerlake.session import scratch_path
from ledgerlake.sinks.layout import land_movements
from ledgerlake.sources.generate import index_range, movements
from ledgerlake.sources.raw import inventory
from ledgerlake.streaming import dedupe
from ledgerlake.streaming.dedupe import PROVIDER, KeepBest, best_rows, current_rows, dedupe_available
from ledgerlake.streaming.landing import good_rows, ingest_available, quarantined
from tests.conftest import plan_text


def test_stream_picks_only_new_files(spark):
    raw, staging, ckpt = (scratch_path(spark, n) for n in ("s_raw", "s_stg", "s_ckpt"))
    land_movements(spark, raw, 1000, 4)
    ingest_available(spark, raw, staging, ckpt)
    first = good_rows(spark, staging)
    assert first.count() == 1000
    land_movements(spark, raw, 500, 2, start=1000, mode="append")
    ingest_available(spark, raw, staging, ckpt)
    back = good_rows(spark, staging)
    assert back.count() == 1500
    assert back.select("mouvement_no").distinct().count() == 1500
    assert back.select("epoch").distinct().count() == 2
    # nothing new: a third run adds nothing
    ingest_available(spark, raw, staging, ckpt)
    assert good_rows(spark, staging).count() == 1500


def test_stream_quarantines_bad_rows(spark, tmp_path):
    raw, staging, ckpt = (scratch_path(spark, n) for n in ("q_raw", "q_stg", "q_ckpt"))
    land_movements(spark, raw, 100, 1)
    d = tmp_path / "bad"
    d.mkdir()
    (d / "x.csv").write_text("id_mouvement,date_op,produit,type_op,montant,agence_id,pays\n"
                             "M0000999,2025-06-31,auto,cotisation,1.0,AG_001,FR\n")
    spark.read.text(str(d)).write.mode("append").text(raw + "_tmp")  # not under raw: ignored
    import shutil
    shutil.copy(d / "x.csv", raw.replace("file:", "") + "/x.csv")
    ingest_available(spark, raw, staging, ckpt)
    assert good_rows(spark, staging).count() == 100
    assert quarantined(spark, staging).filter(F.col("reason") == "bad_date").count() == 1


def test_manifest_anti_join(spark):
    raw, man = scratch_path(spark, "m_raw"), scratch_path(spark, "m_man")
    land_movements(spark, raw, 100, 3)
    record_manifest(spark, inventory(spark, raw, glob="*.csv"), man)
    land_movements(spark, raw, 100, 2, start=100, mode="append")
    assert new_files(spark, raw, read_manifest(spark, man)).count() == 2


def test_stream_dedupe_within_watermark(spark):
    raw, staging, ckpt = (scratch_path(spark, n) for n in ("d_raw", "d_stg", "d_ckpt"))
    land_movements(spark, raw, 300, 2, seed=1)
    land_movements(spark, raw, 300, 2, seed=2, start=150, mode="append")  # ids 151..300 landed twice
    ingest_available(spark, raw, staging, ckpt, dedupe_watermark="31 days")
    back = good_rows(spark, staging)
    assert back.count() == 450
    assert back.select("mouvement_no").distinct().count() == 450


def test_incremental_loop_reads_each_file_once(spark, tmp_path):
    raw, man = str(tmp_path / "raw"), str(tmp_path / "manifest")
    counts = []
    land_movements(spark, f"{raw}/a b", 300, 3)
    for k in range(4):
        if k == 2:  # into a folder that holds known files, and a new one
            land_movements(spark, f"{raw}/a b", 50, 1, start=300, mode="append")
            land_movements(spark, f"{raw}/c", 70, 2, start=350, compression="gzip")
        out = str(tmp_path / f"run{k}")
        counts.append(spark.read.parquet(f"{out}/rows").count() if ingest_new(spark, raw, man, out) else 0)
    assert counts == [300, 0, 120, 0] and read_manifest(spark, man).count() == 6


def test_backlog_in_batches_of_bytes(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    land_movements(spark, raw, 400, 4)
    ingest_available(spark, raw, out, str(tmp_path / "ckpt"), max_bytes_per_trigger=1)
    t = good_rows(spark, out)
    assert t.count() == 400 and t.select("epoch").distinct().count() == 4


def test_a_batch_is_one_scan_and_good_rows_read_their_folders(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    land_movements(spark, raw, 100, 2)
    (tmp_path / "raw" / "x.csv").write_text(",".join(model.COLUMNS) + "\nM1,2025-06-31,auto,cotisation,1,AG_001,FR\nM2,2025-06-01,auto,cotisation,1,AG_001," + "long" * 100 + "/..\n")
    ingest_available(spark, raw, out, str(tmp_path / "ckpt"))
    assert good_rows(spark, out).count() == 101 and [r.raw_line for r in quarantined(spark, out).collect()] == ["M1,2025-06-31,auto,cotisation,1,AG_001,FR"]
    plan = plan_text(good_rows(spark, out, "FR"))
    assert "PartitionFilters: [isnotnull(reason" in plan and "pays_folder" in plan.split("PartitionFilters")[1]
    assert sum(good_rows(spark, out, c).count() for c in (*model.COUNTRIES, "long" * 100 + "/..")) == 101


def _movements(*rows):
    return pd.DataFrame(rows, columns=["priority", "mouvement_no", "produit"])


class _State:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_best_rows_in_any_order_of_arrival():
    """The processor alone: after any split of the rows into batches, the last change of every id is the batch answer."""
    r = random.Random(8)
    schema = T.StructType().add("priority", T.IntegerType()).add("mouvement_no", T.LongType()).add("produit", T.StringType())
    rows = [(r.choice([1, 2, 3]), r.randrange(40), r.choice("abc")) for _ in range(300)]
    for seed in range(5):
        r.shuffle(rows)
        keep = KeepBest(schema, None)
        keep.arrow, keep.best = to_arrow_schema(schema), _State()
        last, emitted = {}, 0
        for at in range(0, 300, 37):
            frames = [_movements(*rows[k:k + 10]) for k in range(at, min(at + 37, 300), 10)]
            for out in keep.handleInputRows((0,), iter(frames), None):
                for p, no, x, change in out.itertuples(index=False):
                    assert (change == "corrected") == (no in last) and (no not in last or (p, no, x) < last[no])
                    last[no], emitted = (p, no, x), emitted + 1
        assert last == {no: min(x for x in rows if x[1] == no) for no in {x[1] for x in rows}} and emitted < 300


def test_packed_rows_keep_the_best_of_every_id(spark, monkeypatch):
    """Ids scattered over ranges, below zero, null; ties that later columns decide; missing values last; values split by size."""
    monkeypatch.setattr(dedupe, "PACK_ROWS", 50)
    monkeypatch.setattr(dedupe, "PACK_BYTES", 2000)
    monkeypatch.setattr(dedupe, "PART_ROWS", 40)
    monkeypatch.setattr(dedupe, "RANGE", 16)
    r = random.Random(3)
    pick = lambda *of: r.choice([*of, None])
    rows = [(pick(1, 2), pick(*range(-30, 60), 10**12), pick("M1", "M2"), pick(date(2025, 6, 1), date(1890, 1, 2)), pick("auto", "é", "日本", "🙂"), "t", pick(Decimal("-1.10"), Decimal("9999999999.99"), Decimal("0.05")), "a", "FR")
            for _ in range(600)]
    df = spark.createDataFrame(rows, "priority int, mouvement_no long, id_mouvement string, date_op date, produit string, type_op string, montant decimal(12,2), agence_id string, pays string")
    assert spark.streams.active == []  # sets up what the state of a batch needs too
    got = [tuple(x) for x in best_rows(df.repartition(3)).collect()]
    order = lambda row: [(v is None, v) if v is not None else (True,) for v in row]
    want = [min((x for x in rows if x[1] == no), key=order) for no in {x[1] for x in rows} - {None}] + [x for x in rows if x[1] is None]
    assert sorted(got, key=order) == sorted([(*x, "new") for x in want], key=order)


def test_the_stream_splits_a_line_once(spark, tmp_path, monkeypatch):
    """One scan of the files; a filter on what was typed stays above the parse, instead of parsing anew for every field."""
    plans, explain = [], spark.sparkContext._jvm.PythonSQLUtils.explainString
    monkeypatch.setattr(dedupe, "bounded", lambda writer, checkpoint: plans.extend(explain(writer._df._jdf.queryExecution(), "extended").split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")))
    land_movements(spark, str(tmp_path / "raw"), 10, 1)
    dedupe_available(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt"), F.lit(1))
    query, optimized = plans
    assert query.split("== Analyzed Logical Plan ==")[1].count("StreamingRelation") == 2  # as checkpoints have it
    assert optimized.count("StreamingRelation") == 1 and "from_csv" in optimized
    assert not any("Filter" in line and "from_csv" in line for line in optimized.splitlines())


def test_a_task_lands_several_files_of_the_dedupe(spark, tmp_path, monkeypatch):
    class Landed(Exception):
        pass

    def stop(spark, raw, *_):
        raise Landed(raw)

    monkeypatch.setattr(dedupe, "dedupe_available", stop)
    spark.range(39_999).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    with pytest.raises(Landed) as landed:
        QUERIES["stream_dedupe"](spark, str(tmp_path))
    files = [r.path.rsplit("/", 1)[1] for r in inventory(spark, str(landed.value), glob="*.csv").collect()]
    assert len(files) == 20 and len({name[:10] for name in files}) == 2
    assert spark.read.option("header", True).csv(f"{landed.value}/beam").select("id_mouvement").distinct().count() == 39_999


def test_stream_dedupe_corrects_late_priorities_and_replays(spark, tmp_path):
    raw, out, ckpt = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    prio = F.when(F.col("source_file").contains("/a/"), 1).otherwise(2)
    land_movements(spark, f"{raw}/b", 300, 3, seed=2, start=150)
    dedupe_available(spark, raw, out, ckpt, prio, max_files_per_trigger=1)
    assert current_rows(spark, out).count() == 300
    land_movements(spark, f"{raw}/a", 300, 2, seed=1)
    land_movements(spark, f"{raw}/c", 300, 2, seed=2, start=150)  # the same rows again change nothing
    dedupe_available(spark, raw, out, ckpt, prio, max_files_per_trigger=2)
    got = current_rows(spark, out)
    assert got.count() == 450 and got.filter("priority = 1").count() == 300
    want = movements(index_range(spark, 300), seed=1).select("mouvement_no", "cents")
    assert got.filter("priority = 1").join(want, "mouvement_no").filter("montant * 100 = cents").count() == 300
    assert spark.read.parquet(out).groupBy("change").count().collect() and spark.read.parquet(out).filter("change = 'corrected'").count() == 150


def test_stream_dedupe_in_a_session_of_spark_defaults(spark, tmp_path):
    raw, out, old = str(tmp_path / "raw"), str(tmp_path / "out"), spark.conf.get(PROVIDER)
    land_movements(spark, f"{raw}/b", 100, 1, seed=2)
    spark.conf.unset(PROVIDER)
    default = spark.conf.get(PROVIDER)
    try:
        dedupe_available(spark, raw, out, str(tmp_path / "ckpt"), F.lit(1))
        assert current_rows(spark, out).count() == 100 and spark.conf.get(PROVIDER) == default
    finally:
        spark.conf.set(PROVIDER, old)


def test_the_state_processor_needs_no_module_of_ours(tmp_path):
    schema = T.StructType().add("priority", T.IntegerType()).add("mouvement_no", T.LongType())
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle, sys; k = pickle.load(sys.stdin.buffer); assert 'ledgerlake' not in sys.modules and k.ttl_ms == 5"
    subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(KeepBest(schema, 5)), cwd=tmp_path, env=env, check=True)


def test_sparse_keys_are_all_landed(spark, tmp_path):
    spark.range(0, 200, 2).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    index = dealt_index(spark, str(tmp_path), 100, 4)
    assert index.count() == 100 and index.agg(F.max("i")).first()[0] == 198
    halves = dealt_index(spark, str(tmp_path), 50, 2, hi=50).union(dealt_index(spark, str(tmp_path), 50, 2, lo=50))
    assert sorted(r.i for r in halves.collect()) == list(range(0, 200, 2))
