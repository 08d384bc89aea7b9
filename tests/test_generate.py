"""Generator: determinism, partition invariance, boundaries, distribution, bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions.rowfn import movements_batch
from ledgerlake.sources.generate import index_range, movements, raw_columns

COLS = ["mouvement_no", "id_mouvement", "date_op", "produit", "type_op", "cents", "agence_id", "pays"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_first_rows_documented(spark):
    r = movements(index_range(spark, 2, 1)).orderBy("mouvement_no").collect()
    assert [r[0].id_mouvement, str(r[0].date_op), r[0].produit, r[0].type_op, r[0].montant, r[0].agence_id, r[0].pays] == \
        ["M0000001", "2025-06-06", "habitation", "prime_exceptionnelle", 1043.3, "AG_011", "FR"]
    assert [r[1].id_mouvement, str(r[1].date_op), r[1].produit, r[1].type_op, r[1].montant, r[1].agence_id, r[1].pays] == \
        ["M0000002", "2025-06-25", "sante", "penalite_retard", 229.09, "AG_006", "ES"]


@pytest.mark.parametrize("parts", [1, 2, 7, 8])
def test_partition_invariance(spark, parts):
    base = rows(movements(index_range(spark, 3000, 3)))
    assert rows(movements(index_range(spark, 3000, parts))) == base


def test_rerun_identical(spark):
    df = movements(index_range(spark, 2000, 4), seed=7)
    assert rows(df) == rows(df)


def test_numpy_kernel_equals_spark(spark):
    pdf = movements_batch(np.arange(5000), 42)
    sp = movements(index_range(spark, 5000, 4)).orderBy("mouvement_no").toPandas()
    assert (pdf["id_mouvement"].to_numpy() == sp["id_mouvement"].to_numpy()).all()
    assert (pdf["montant"].to_numpy() == sp["montant"].to_numpy()).all()
    assert (pdf["date_op"].to_numpy() == sp["date_op"].astype(str).to_numpy()).all()
    for c in ["produit", "type_op", "agence_id", "pays"]:
        assert (pdf[c].to_numpy() == sp[c].to_numpy()).all(), c


@pytest.mark.parametrize("n", [0, 1, 4, 5, 11])
def test_boundary_sizes(spark, n):
    df = movements(index_range(spark, n, 5))
    got = df.agg(F.count("*"), F.min("mouvement_no"), F.max("mouvement_no")).first()
    assert got[0] == n
    if n:
        assert (got[1], got[2]) == (1, n)


def test_id_width_boundary(spark):
    df = movements(index_range(spark, 3, 1, start=9_999_998))
    ids = [r.id_mouvement for r in df.orderBy("mouvement_no").collect()]
    assert ids == ["M9999999", "M10000000", "M10000001"]  # never truncated to 7 digits (H1)


def test_distribution_chi2(spark):
    n = 200_000
    df = movements(index_range(spark, n, 8))
    crit = {3: 16.3, 4: 18.5, 18: 42.3, 19: 43.8, 29: 58.3}  # p = 0.001
    for col, k in [("produit", 4), ("type_op", 19), ("agence_id", 20), ("pays", 5), ("date_op", 30)]:
        counts = [r[1] for r in df.groupBy(col).count().collect()]
        assert len(counts) == k
        e = n / k
        chi2 = sum((c - e) ** 2 / e for c in counts)
        assert chi2 < crit[k - 1], (col, chi2)


def test_amount_bounds_by_type(spark):
    df = movements(index_range(spark, 200_000, 8))
    st = {r.type_op: (r.lo, r.hi) for r in df.groupBy("type_op").agg(F.min("cents").alias("lo"), F.max("cents").alias("hi")).collect()}
    for t, (lo, hi) in zip(model.OPERATION_TYPES, model.AMOUNT_BOUNDS_CENTS):
        assert lo <= st[t][0] and st[t][1] <= hi, t


def test_accented_labels(spark):
    df = movements(index_range(spark, 5000, 2), labels="accented")
    labels = {r.type_op for r in df.select("type_op").distinct().collect()}
    assert labels == set(model.OPERATION_TYPES_ACCENTED)


def test_raw_columns_order(spark):
    assert raw_columns(movements(index_range(spark, 1, 1))).columns == model.COLUMNS


def test_no_period_at_2_pow_32(spark):
    lo = movements(index_range(spark, 200, 1)).select(*COLS[2:]).collect()
    hi = movements(index_range(spark, 200, 1, start=1 << 32)).select(*COLS[2:]).collect()
    assert sum(a == b for a, b in zip(lo, hi)) < 5


def test_numpy_kernel_equals_spark_past_2_pow_32(spark):
    start = (1 << 32) - 100
    pdf = movements_batch(np.arange(start, start + 300), 42)
    sp = movements(index_range(spark, 300, 2, start=start)).orderBy("mouvement_no").toPandas()
    for c in ["id_mouvement", "montant", "produit", "type_op", "agence_id", "pays"]:
        assert (pdf[c].to_numpy() == sp[c].to_numpy()).all(), c
