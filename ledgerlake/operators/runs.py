"""Which ids are there, how often: runs instead of ids (Q6).

A task folds the ids of a batch into sorted runs (first, last, copies); ids that lie together, as a
landing's do, leave a few runs for any number of rows, and runs that touch are joined as they
come. A run is an interval that raises the count of its ids: its two ends are added up over all tasks, and one
ordered scan of the ends gives the maximal intervals of equal count. Count 0 is a gap, above 1 a
repeat. What is shuffled are ends of runs, never ids; ids in no order at all cost as many runs as ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.scan import ordered_scan

SCHEMA = pa.schema([("first_no", pa.int64()), ("last_no", pa.int64()), ("copies", pa.int64())])


def fold(ids: np.ndarray) -> np.ndarray:
    """Rows (first, last, copies) of the maximal runs of equal count."""
    if not len(ids):
        return np.zeros((0, 3), np.int64)
    no, copies = np.unique(ids, return_counts=True)
    cuts = np.flatnonzero((np.diff(no) != 1) | (np.diff(copies) != 0))
    first, last = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(no) - 1]])
    return np.stack([no[first], no[last], copies[first]], axis=1)


def task_runs(df: DataFrame, key: str) -> DataFrame:
    """Runs (first_no, last_no, copies) of each task's ids; the runs of different tasks may overlap."""

    def run(frames):
        held = np.zeros((0, 3), np.int64)
        for b in frames:
            new = fold(b.column(0).drop_null().to_numpy(zero_copy_only=False))
            if len(held) and len(new) and held[-1][1] + 1 == new[0][0] and held[-1][2] == new[0][2]:
                new[0][0], held = held[-1][0], held[:-1]  # goes on where the last batch ended
            if len(held):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], schema=SCHEMA)
            held = new
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], schema=SCHEMA)

    return df.select(F.col(key).cast("bigint").alias(key)).mapInArrow(run, "first_no long, last_no long, copies long")


def id_runs(df: DataFrame, key: str = "mouvement_no") -> DataFrame:
    """Maximal intervals first_no .. last_no, between the least and the greatest id, whose ids are all there
    ``copies`` times. Rows without an id take no part; no rows, no intervals."""
    runs = task_runs(df, key)
    ends = runs.select(F.inline(F.array(F.struct(F.col("first_no").alias("at"), F.col("copies").alias("step")), F.struct((F.col("last_no") + 1).alias("at"), (-F.col("copies")).alias("step")))))
    turns = ends.groupBy("at").agg(F.sum("step").alias("step")).filter("step <> 0")
    scanned = ordered_scan(turns, "at", sums={"copies": "step"}, following="until")
    return scanned.filter("until is not null").select(F.col("at").alias("first_no"), (F.col("until") - 1).alias("last_no"), "copies")


def id_rules(df: DataFrame, key: str = "mouvement_no") -> DataFrame:
    """The id rules of the contract from runs: n_distinct, id_unique (rows too many), id_gaps."""
    size = F.col("last_no") - F.col("first_no") + 1
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return id_runs(df, key).agg(total(F.when(F.col("copies") > 0, size)).alias("n_distinct"), total(F.when(F.col("copies") > 1, (F.col("copies") - 1) * size)).alias("id_unique"),
                                total(F.when(F.col("copies") == 0, size)).alias("id_gaps"))
