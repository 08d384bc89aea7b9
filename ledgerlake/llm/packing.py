"""Sequence packing as a cutting-stock problem solved by column generation.

Every document (its token ids, then an end id) is cut into full sequences and one
remainder. Remainder lengths are rounded up to ``unit`` tokens and counted; the
linear program over packing patterns (how many remainders of each length share a
sequence) is solved by column generation, a knapsack dynamic program pricing the
columns. Rounded-down pattern counts and a bounded rest, filled largest first,
give for each length class consecutive rank ranges; documents are ranked within
their class and so find their sequence without any search.

Only the histogram (at most ``size / unit`` rows) and the patterns reach the
driver; both are bounded whatever the data. Ranks come from per-shard row numbers
plus prefix counts, so a length that a third of all documents share is split; shards grow with the rows.

Null text is an empty document (only the end id). Repeated rows are packed each;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import gc
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import bpe
from ledgerlake.llm.common import batches, written
from ledgerlake.llm.token_counts import _arrow

SIZE, UNIT, SHARDS, PER_SHARD = 1024, 8, 256, 20_000


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = 0) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit, binary), doc_tokens: cut at every ``size`` ids."""
    path = tokenizer_path or bpe.default_path()
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
    end = int(end_id).to_bytes(4, "little")

    def run(frames):
        en = bpe.encoder(path)
        gc.disable()

        def rows(b):
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = (en.ids(t) if t else b"") + end
                n = len(ids) // 4
                for s in range(0, n, size):
                    part = ids[4 * s:4 * (s + size)]
                    yield d, s, len(part) // 4, part, n

        for b in frames:
            yield from batches(rows(b), schema)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long")


def solve(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (size class -> copies) and how often each is used; together they cover
    ``demand`` exactly. The linear program runs on a basis inverse, one column per pivot."""
    sizes = sorted(k for k, n in demand.items() if n > 0)
    if not sizes:
        return []
    m = len(sizes)
    w, d = np.array(sizes), np.array([demand[k] for k in sizes], dtype=float)
    columns = [np.eye(1, m, k).ravel() * (capacity // s) for k, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    x = inverse @ d
    for _ in range(40 * m):
        dual = inverse.sum(axis=0)
        column = price(w, dual, capacity)
        if dual @ column <= 1 + 1e-7:
            break
        step = inverse @ column
        able = step > 1e-10
        ratio = np.where(able, x / np.where(able, step, 1), np.inf)
        r = int(ratio.argmin())
        pivot = inverse[r] / step[r]
        inverse -= np.outer(step, pivot)
        inverse[r] = pivot
        x = (x - step * ratio[r]).clip(min=0)
        x[r] = ratio[r]
        columns[r] = column
    left = {k: int(n) for k, n in demand.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []
    for column, value in zip(columns, x, strict=True):
        pattern = {sizes[k]: int(column[k]) for k in np.flatnonzero(column)}
        times = min([int(value + 1e-6), *(left[k] // c for k, c in pattern.items())])
        if times > 0:
            out.append((pattern, times))
            for k, c in pattern.items():
                left[k] -= c * times
    open_sizes = [k for k in sizes if left[k] > 0]
    while open_sizes:  # the rounded-off rest: largest first
        room, pattern = capacity, {}
        at = len(open_sizes)
        while room and (at := bisect_left(open_sizes, room + 1, 0, at)):
            k = open_sizes[at - 1]
            pattern[k] = take = min(left[k], room // k)
            room -= k * take
            at -= 1
        times = min(left[k] // c for k, c in pattern.items())
        out.append((pattern, times))
        for k, c in pattern.items():
            left[k] -= c * times
        open_sizes = [k for k in open_sizes if left[k] > 0]
    return out


def price(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable pattern: unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fit = np.searchsorted(sizes, c, side="right")
        best[c] = best[c - 1]
        if fit:
            got = best[c - sizes[:fit]] + value[:fit]
            k = int(got.argmax())
            if got[k] > best[c] + 1e-12:
                best[c], pick[c] = got[k], k
    column = np.zeros(len(sizes))
    c = capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            column[pick[c]] += 1
            c -= sizes[pick[c]]
    return column


def segments(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, copies per sequence, first sequence id): where ranks of a class go."""
    rank: dict[int, int] = {}
    out, base = [], 0
    for pattern, times in patterns:
        for k, c in sorted(pattern.items()):
            lo = rank.get(k, 0)
            rank[k] = lo + c * times
            out.append((k, lo, rank[k], c, base))
        base += times
    return out


def assign_sequences(pieces: DataFrame, size: int = SIZE, unit: int = UNIT, per_shard: int = PER_SHARD) -> DataFrame:
    """``pieces(doc_id, start, length, ...)`` with sequence_id and offset added.
    ``pieces`` must be a written table: it is read for the histogram and again for the ranks. Rows are
    dealt to shards by their place in its files (not by their values, which may all be the same), at most about
    ``per_shard`` to each, and to ``SHARDS`` of them at least."""
    spark = pieces.sparkSession
    shards = max(SHARDS, -(-pieces.count() // per_shard))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    p = pieces.select("*", F.ceil(F.col("length") / unit).cast("int").alias("_cls"), F.pmod(place, F.lit(shards)).cast("int").alias("_shard"))
    per_shard = p.groupBy("_cls", "_shard").agg(F.count("*").alias("_n"))
    demand = {r["_cls"]: r["n"] for r in per_shard.groupBy("_cls").agg(F.sum("_n").alias("n")).collect()}
    table = segments(solve(demand, size // unit))
    seg = F.broadcast(spark.createDataFrame(table, "_c int, _lo long, _hi long, _copies int, _base long"))
    before = per_shard.select(F.col("_cls").alias("_k"), F.col("_shard").alias("_s"), (F.sum("_n").over(Window.partitionBy("_cls").orderBy("_shard")) - F.col("_n")).alias("_before"))
    ties = [c for c in pieces.columns if c not in ("doc_id", "start")]
    in_shard = Window.partitionBy("_cls", "_shard").orderBy("doc_id", "start", *ties)
    ranked = (p.withColumn("_row", F.row_number().over(in_shard) - 1)
              .join(before, (F.col("_cls") == F.col("_k")) & (F.col("_shard") == F.col("_s")))
              .withColumn("_rank", F.col("_row") + F.col("_before")))
    placed = ranked.join(seg, (F.col("_cls") == F.col("_c")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    placed = placed.withColumn("sequence_id", F.col("_base") + F.floor((F.col("_rank") - F.col("_lo")) / F.col("_copies")))
    w = Window.partitionBy("sequence_id").orderBy(F.col("_cls").desc(), "_rank")
    return (placed.withColumn("offset", F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
            .select(*pieces.columns, F.col("sequence_id").cast("long").alias("sequence_id"), "offset"))


def pack(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, unit: int = UNIT, end_id: int = 0) -> DataFrame:
    """Whole packing with token ids: pieces written once, then placed."""
    return assign_sequences(written(token_pieces(docs, tokenizer_path, size, end_id), "pieces"), size, unit)


def pack_digest(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The contract's row per piece: ids reduced to their CRC-32 before anything is shuffled."""
    pieces = token_pieces(docs, tokenizer_path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return assign_sequences(written(pieces, "pieces"))
