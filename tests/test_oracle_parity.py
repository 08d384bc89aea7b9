"""Every registered query equals its DuckDB oracle, at sf0.001."""

import pytest

import __spark_entry__ as E
from ledgerlake.plans import catalogue
from tests.conftest import SF0001
from tools.check_oracle import duck, rows_of

QUERIES = dict(catalogue.QUERIES)  # queries of optional subpackages are tested beside them
ORACLES = dict(catalogue.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle_unless_clocked():
    assert set(QUERIES) - set(ORACLES) == {"run_metrics"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF0001)
    recs = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(recs) > 0
        return
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, recs) == rows_of(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1500
    assert df.columns == ["mouvement_no", "id_mouvement", "date_op", "produit", "type_op", "montant", "agence_id", "pays"]
