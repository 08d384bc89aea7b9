"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: a lineage
    cut that survives lost executors and keeps non-deterministic ids stable."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, per_task: int) -> int:
    """Tasks for a sort of ``df``: the session's shuffle partitions, or more where a task would get over ``per_task`` rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // per_task))


def aside(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all columns but ``used`` under names that no operator takes, and a
    function that gives them their names back (``new``: columns that replace some or come after)."""
    names = {c: c if c in used else f"_aside_{k}" for k, c in enumerate(df.columns)}

    def back(out: DataFrame, **new) -> DataFrame:
        kept = {c: F.col(n) for c, n in names.items()} | new
        return out.select(*[v.alias(c) for c, v in kept.items()])

    return df.toDF(*names.values()), back


def bucket(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``: the folds of the contracts."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (bytes split and lower-case in
    ASCII alone); ``lower``: A-Z lower-cased, nothing else changed."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return (raw.lower() if lower else raw).split()


def slices(frames: Iterator[pa.RecordBatch], size: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that few texts are Python objects at a time."""
    for b in frames:
        for k in range(0, b.num_rows, size):
            yield b.slice(k, size)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Group row tuples into Arrow batches bounded by rows and by bytes of binary values."""
    buf: list[tuple] = []
    n_bytes = 0
    for row in rows:
        buf.append(row)
        n_bytes += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(buf) >= size or n_bytes >= max_bytes:
            yield _batch(buf, schema)
            buf, n_bytes = [], 0
    if buf:
        yield _batch(buf, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
