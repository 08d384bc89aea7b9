"""One row per id inside the stream (X4, R9), exact whatever the order of arrival.

State is kept per range of ``RANGE`` ids: for every id seen there, the row that is best so far by
landing priority, then by all columns (the order of the batch dedupe). A row that beats it is
emitted again as a correction; a row that does not is dropped. So a landing of higher
priority may arrive late: its rows correct what was staged. A range is read and written once
per micro-batch, not once per id, and holds at most ``RANGE`` rows.

Rows go to the state packed: each task joins its rows of a range to one value of Arrow bytes, since
Spark hands every single row of the state's input to Python as a tuple.

Ranges expire ``ttl_ms`` after their last row if that is set (an explicit choice: a
row of an expired range counts as new); without it state is kept for good. Rows without an id are
each a row of their own and pass by the state, quarantined rows too.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlake.operators.ingest import OK
from ledgerlake.streaming.landing import bounded, raw_stream

RANGE = 4096
#: Rows that a task holds to pack them, bytes of packed rows it sends at once, rows that the state takes in at once.
PACK_ROWS, PACK_BYTES, PART_ROWS = 1 << 17, 8 << 20, 1 << 16
PRIORITY, CHANGE, NEW, CORRECTED, ORIGIN = "priority", "change", "new", "corrected", "_origin"
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "128"
PRUNE = "spark.sql.optimizer.pruneFiltersCanPruneStreamingSubplan"
COLUMNS = [PRIORITY, "mouvement_no", "id_mouvement", "date_op", "produit", "type_op", "montant", "agence_id", "pays"]


class KeepBest(StatefulProcessor):
    """The best row of every id of a range; emits rows that are new or better than what was kept."""

    def __init__(self, schema: T.StructType, ttl_ms: int | None):
        self.schema, self.ttl_ms = schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.arrow = to_arrow_schema(self.schema)
        self.best = handle.getValueState("best", T.StructType([T.StructField("rows", T.BinaryType())]), self.ttl_ms)

    def tables(self, frame: pd.DataFrame) -> Iterator[pa.Table]:
        yield pa.Table.from_pandas(frame, schema=self.arrow, preserve_index=False)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        first = self.arrow.empty_table()
        if self.best.exists():
            first = pa.ipc.open_stream(self.best.get()[0]).read_all().cast(self.arrow)
        held, waiting, n = _from(first, 0), [], 0
        for frame in rows:  # a range's rows of a batch, however many, pass in parts
            for table in self.tables(frame):
                waiting.append(_from(table, 1))
                n += table.num_rows
                if n >= PART_ROWS:
                    held, waiting, n = _best([held, *waiting]), [], 0
        held = _best([held, *waiting])
        out = held.filter(pc.equal(held[ORIGIN], 1)).drop_columns(ORIGIN)
        if out.num_rows:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.arrow, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                writer.write_table(held.drop_columns(ORIGIN))
            self.best.update((sink.getvalue().to_pybytes(),))
            known = pc.is_in(out["mouvement_no"], first["mouvement_no"])
            yield out.append_column(CHANGE, pc.if_else(known, CORRECTED, NEW)).to_pandas(types_mapper=pd.ArrowDtype)

    def close(self) -> None:
        pass


class KeepBestOfParts(KeepBest):
    """``KeepBest`` on the packed rows of ``packed``."""

    def tables(self, frame: pd.DataFrame) -> Iterator[pa.Table]:
        for part in frame["rows"]:
            yield pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(part), self.arrow)])


def _from(table: pa.Table, origin: int) -> pa.Table:
    """The rows with a mark, which decides between equal ones: those held (0) before those that came (1)."""
    return table.append_column(ORIGIN, pa.array(np.full(table.num_rows, origin, np.int8)))


def _best(tables: list[pa.Table]) -> pa.Table:
    """The best row of every id, by priority, then by all columns; missing values come last."""
    rows = pa.concat_tables(tables).combine_chunks()
    order = ["mouvement_no", PRIORITY, *[c for c in rows.column_names if c not in ("mouvement_no", PRIORITY)]]
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_end"))
    no = rows["mouvement_no"].to_numpy()
    return rows.filter(pa.array(np.append(np.ones(min(1, len(no)), bool), no[1:] != no[:-1])))


def packed(rows: DataFrame) -> DataFrame:
    """id_range, rows: the rows (all with an id) of a task joined by range, in Arrow's bytes, ``PACK_ROWS`` rows at a time;
    a value holds at most ``RANGE`` rows."""
    schema = to_arrow_schema(rows.schema)
    out = pa.schema([("id_range", pa.int64()), ("rows", pa.binary())])

    def values(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table["id_range"])).combine_chunks()
        ranges = table["id_range"].to_numpy()
        table = table.select(schema.names).cast(schema)
        starts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
        made, size = [], 0
        for at, end in pairwise(starts):
            for k in range(at, end, RANGE):
                part = table.slice(k, min(RANGE, end - k)).to_batches()[0].serialize().to_pybytes()
                made.append((int(ranges[at]), part))
                size += len(part)
                if size >= PACK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), out.types, strict=True)], schema=out)
                    made, size = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), out.types, strict=True)], schema=out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for b in batches:
            if b.num_rows:
                waiting.append(b)
                n += b.num_rows
            if n >= PACK_ROWS:
                yield from values(waiting)
                waiting, n = [], 0
        if waiting:
            yield from values(waiting)

    return rows.withColumn("id_range", F.floor(F.col("mouvement_no") / RANGE)).mapInArrow(pack, "id_range long, rows binary")


# Spark sets the processor up in a Python worker on the driver that gets neither the files added to the
# session nor its search path, so the class goes there by value, not by the name of its module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def _settings(spark: SparkSession):
    """The processor's state needs a store with column families, which Spark's default one is not. A batch's
    files are listed again before they are read, by a task each unless the number of tasks is bounded.
    The branch without rows goes from a batch's plan only if Spark may prune streams."""
    new = {PROVIDER: ROCKSDB, LISTING: LISTING_TASKS, PRUNE: "true"}
    old = {key: spark.conf.get(key, None) for key in new}
    for key, value in new.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def best_rows(typed: DataFrame, ttl_ms: int | None = None, all_have_ids: bool = False) -> DataFrame:
    """Changes (``COLUMNS`` and ``change``) of a typed stream or table with ``priority``; rows without an id are ``new``.
    Those take a second pass over the input, unless the caller says that there are none: Spark then drops that branch
    when it plans. The branch stays in the query, since a checkpoint holds the number of its sources."""
    rows = typed.select(*COLUMNS)
    kept = (packed(rows.filter("mouvement_no is not null")).groupBy("id_range")
            .transformWithStateInPandas(KeepBestOfParts(rows.schema, ttl_ms), T.StructType([*rows.schema.fields, T.StructField(CHANGE, T.StringType())]), "Update", "ProcessingTime" if ttl_ms else "None"))
    without_id = F.lit(False) if all_have_ids else F.col("mouvement_no").isNull()
    return kept.unionByName(rows.filter(without_id).withColumn(CHANGE, F.lit(NEW)))


def dedupe_available(spark: SparkSession, raw_path: str, out_path: str, checkpoint: str, priority: Column, ttl_ms: int | None = None,
                     max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> None:
    """Run the stream over all available files; every micro-batch's changes go to a folder of its own
    (replaced if the batch is replayed). ``priority`` is a column over ``source_file``, smaller is better."""
    typed = raw_stream(spark, raw_path, max_files_per_trigger, max_bytes_per_trigger).withColumn(PRIORITY, priority.cast("int"))
    # A filter can't cross a generator: below the parse it would split and type the line anew for every field it names.
    typed = typed.select(F.inline(F.array(F.struct(*COLUMNS, "reason"))))
    good = typed.filter((F.col("reason") == OK) & F.col("mouvement_no").isNotNull())

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out_path}/epoch={epoch}")

    with _settings(spark):
        bounded(best_rows(good, ttl_ms, all_have_ids=True).writeStream.outputMode("update").foreachBatch(sink), checkpoint)


def current_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """The table as it stands: of each id the last change, which is the best row."""
    changes = spark.read.option("basePath", out_path).parquet(out_path)
    last = F.row_number().over(Window.partitionBy("mouvement_no").orderBy(F.desc("epoch")))
    return changes.withColumn("_last", last).filter("_last = 1").select(*COLUMNS)
