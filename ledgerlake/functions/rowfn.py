"""User row functions through Arrow batches.

The reference's only user-function surface is a per-element function that
turns an index into a row. In Spark that is ``mapInPandas``: the function
gets whole Arrow batches of a partition, so there is no per-row Python call.
``movements_batch`` is the generator written that way (NumPy, vectorised);
it equals the native-column generator row for row and serves as the worked
example and cross-check. The native generator stays the default path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ledgerlake import model
from ledgerlake.functions import draws as D

MOVEMENT_BATCH_SCHEMA = ("mouvement_no long, id_mouvement string, date_op string, produit string, "
                         "type_op string, montant double, agence_id string, pays string")


def apply_row_function(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of every partition (no shuffle)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def _mix1(x: np.ndarray) -> np.ndarray:
    return ((x ^ (x >> np.uint64(16))) * np.uint64(D.MIX_MULT)) & np.uint64(D.MASK32)


def _xs(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(16))


def hashes(i: np.ndarray, seed: int, draws) -> dict[int, np.ndarray]:
    u = i.astype(np.uint64)
    hi = _xs(_mix1(_mix1(u >> np.uint64(32))))
    x = ((u & np.uint64(D.MASK32)) + np.uint64(seed * D.SEED_MULT) + hi) & np.uint64(D.MASK32)
    b = _xs(_mix1(_mix1(x)))
    return {c: _xs(_mix1(_mix1((b + np.uint64(c * D.COLUMN_MULT)) & np.uint64(D.MASK32)))) for c in draws}


def _pick(h: np.ndarray, k) -> np.ndarray:
    return ((h * np.asarray(k, dtype=np.uint64)) >> np.uint64(32)).astype(np.int64)


def movements_batch(i: np.ndarray, seed: int = 42) -> pd.DataFrame:
    h = hashes(i.astype(np.int64), seed, D.MOVEMENT_DRAWS)
    t = _pick(h[D.C_TYPE], len(model.OPERATION_TYPES))
    lo = np.array([b[0] for b in model.AMOUNT_BOUNDS_CENTS], dtype=np.int64)[t]
    hi = np.array([b[1] for b in model.AMOUNT_BOUNDS_CENTS], dtype=np.int64)[t]
    cents = lo + _pick(h[D.C_AMOUNT], (hi - lo + 1).astype(np.uint64))
    no = i.astype(np.int64) + 1
    dates = np.datetime64(model.START_DATE) + _pick(h[D.C_DATE], model.DATE_RANGE_DAYS).astype("timedelta64[D]")
    return pd.DataFrame({
        "mouvement_no": no,
        "id_mouvement": np.char.add(model.ID_PREFIX, np.char.zfill(no.astype(str), 7)).astype(object),
        "date_op": np.datetime_as_string(dates, unit="D"),
        "produit": np.array(model.PRODUCTS, dtype=object)[_pick(h[D.C_PRODUCT], len(model.PRODUCTS))],
        "type_op": np.array(model.OPERATION_TYPES, dtype=object)[t],
        "montant": cents / 100.0,
        "agence_id": np.array(model.AGENCIES, dtype=object)[_pick(h[D.C_AGENCY], model.AGENCY_COUNT)],
        "pays": np.array(model.COUNTRIES, dtype=object)[_pick(h[D.C_COUNTRY], len(model.COUNTRIES))],
    })
