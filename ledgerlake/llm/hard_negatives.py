"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors (integers) are projected on a few leading directions of a bounded sample and sorted
by label and place on a Hilbert curve through that space; every ``BLOCK`` consecutive rows of a
label are one row of a Parquet table, with the least and greatest value per dimension (the zone map)
as columns of their own. Anchors are taken in waves of bounded size, neighbours on the curve together,
and each wave is broadcast. A search has two steps: the first reads the zone maps alone and keeps the blocks
whose interval of possible inner products meets the window of any anchor; the second reads these
blocks, bounds each anchor again, scores what is left exactly and keeps the first ``k`` of each
window, narrowing windows as it goes. Positives are a search among equal labels above a seed (the k-th
best in the anchor's own block), negatives one among other labels inside each positive's window.

Bounds hold for every vector of a block, so nothing is missed, whatever the sample. Rows without
id, label or vector, or with a null or non-finite component, take no part. Components beyond
2**26 count as that. Shorter vectors are filled up with zeros. Equal scores: the smaller id first.
Rows with equal ids are different rows; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, slices, tasks_for, written

BLOCK, WAVE, SAMPLE, DIRECTIONS, BITS = 512, 8192, 10_000, 7, 9
LIMIT = 1 << 26
FAR = np.int64(1 << 62)
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (coordinates below ``2**bits``):
    the curve's reflections are undone from the top bit down, then bits are interleaved."""
    x = [c.astype(np.int64) for c in cells.T]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for k in range(len(x)):
            high = (x[k] >> bit & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[k]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0]) ^ swap
            x[k] = x[k] ^ swap if k else x[0]
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ turn) >> bit & 1)
    return key


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id, label, vec (``floor(scale * x)`` as int) of the rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    cut = lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(scale), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).filter(~F.exists(vector, bad))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(vector, cut).alias("vec"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists of a column as rows of ``dim`` numbers, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact: by floating point where no sum can leave 2**53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if most < 1 << 53 else a @ b.T


def directions(rows: DataFrame, dim: int, n: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading directions (as integers, so that keys come out the same on every retry), and the range of the sample on each."""
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    some = [r["vec"] for r in rows.filter(share < min(1.0, sample / n)).select("vec").collect()] or [r["vec"] for r in rows.select("vec").limit(1).collect()]
    x = np.zeros((len(some), dim))
    for k, v in enumerate(some):
        x[k, :len(v)] = v
    _, vectors = np.linalg.eigh(np.cov(x.T).reshape(dim, dim) if len(x) > 1 else np.eye(dim))
    axes = np.round(vectors.T[::-1][:DIRECTIONS] * (1 << 20)).astype(np.int64)
    place = x.astype(np.int64) @ axes.T
    return axes, place.min(axis=0), place.max(axis=0)


def blocks_of(rows: DataFrame, is_anchor: Column, k: int, block: int = BLOCK, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """The written table of blocks of ``rows(vec_id, label, vec)``, and the dimension."""
    first = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    dim = max(int(first["dim"] or 0), 1)
    axes, low, high = directions(rows, dim, max(int(first["n"]), 1), sample) if first["n"] else (np.zeros((1, dim), np.int64),) * 3
    step = np.maximum((high - low) >> BITS, 1)

    def place(frames):
        for b in slices(frames, 10_000):
            at = matrix(b.column("vec"), dim) @ axes.T
            key = hilbert_key(np.clip((at - low) // step, 0, (1 << BITS) - 1))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("vec_id", "label", "anchor")] + [pa.array(key), b.column("vec")], names=["vec_id", "label", "anchor", "key", "vec"])

    keyed = written(rows.select("vec_id", "label", F.coalesce(is_anchor, F.lit(False)).alias("anchor"), "vec").mapInArrow(place, "vec_id long, label long, anchor boolean, key long, vec array<int>"), "hard-keys")
    dealt = keyed.repartitionByRange(tasks_for(keyed, 1_000_000), "label", "key", "vec_id").sortWithinPartitions("label", "key", "vec_id")
    names = ("part", "block", "label", "n", "n_anchors", "ids", "vecs", "lo", "hi", "anchors", "seeds")
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6)
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def cut(frames):
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def full(label, ids, vecs, anchor):
            at = np.flatnonzero(anchor)
            scores = products(vecs[at], vecs)
            scores[np.arange(len(at)), at] = -FAR
            seeds = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k and len(at) else np.full(len(at), -FAR)
            return (part, part << 32 | seq, label, len(ids), len(at), ids.tobytes(), vecs.astype("<i4").tobytes(), vecs.min(axis=0).astype("<i4").tobytes(), vecs.max(axis=0).astype("<i4").tobytes(),
                    at.astype("<i4").tobytes(), seeds.astype("<i8").tobytes())

        def out(done):
            nonlocal held, seq
            while held and (done or sum(len(h[1]) for h in held) >= block):
                label, ids, vecs, anchor = held[0][0], *(np.concatenate([h[c] for h in held]) for c in (1, 2, 3))
                yield full(label, ids[:block], vecs[:block], anchor[:block])
                seq += 1
                held = [(label, ids[block:], vecs[block:], anchor[block:])] if len(ids) > block else []

        def runs():
            for b in slices(frames, 4 * block):
                labels, ids, anchor, vecs = b.column("label").to_numpy(), b.column("vec_id").to_numpy().astype("<i8"), b.column("anchor").to_numpy(zero_copy_only=False).astype(bool), matrix(b.column("vec"), dim)
                cuts = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1], [True]])) if len(labels) else []
                for a, z in zip(cuts, cuts[1:], strict=False):
                    if held and held[0][0] != int(labels[a]):
                        yield from out(True)
                    held.append((int(labels[a]), ids[a:z], vecs[a:z], anchor[a:z]))
                    yield from out(False)
            yield from out(True)

        yield from batches(runs(), schema, size=64)

    ddl = "part int, block long, label long, n int, n_anchors int, ids binary, vecs binary, lo binary, hi binary, anchors binary, seeds binary"
    return written(dealt.select("vec_id", "label", "anchor", "vec").mapInArrow(cut, ddl), "hard-blocks"), dim


class Slots:
    """The windows of a wave: for each, its anchor (a place in ``vecs``), bounds of the score, and the anchor's own row."""

    def __init__(self, vecs, labels, refs, anchor, lo, hi, same: bool):
        self.vecs, self.labels, self.refs, self.same = vecs, labels, refs, same
        self.anchor, self.lo, self.hi = (np.asarray(v, dtype=np.int64) for v in (anchor, lo, hi))
        self.least, self.most = np.full(len(vecs), FAR), np.full(len(vecs), -FAR)
        np.minimum.at(self.least, self.anchor, self.lo)
        np.maximum.at(self.most, self.anchor, self.hi)

    def near(self, label, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which anchors (rows) may have a row in their windows in which zones (columns)."""
        up, down = np.maximum(self.vecs, 0), np.minimum(self.vecs, 0)
        above, below = products(up, hi) + products(down, lo), products(up, lo) + products(down, hi)
        fits = (self.labels[:, None] == label) == self.same
        return fits & (above >= self.least[:, None]) & (below <= self.most[:, None])


def choose_blocks(blocks: DataFrame, dim: int, slots) -> DataFrame:
    """Ids of the blocks that any window of the (broadcast) slots must read, from the zone maps alone."""
    schema = pa.schema([("block", pa.int64())])

    def run(frames):
        for b in slices(frames, 256):
            lo, hi = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<i4").reshape(-1, dim).astype(np.int64) for c in ("lo", "hi"))
            need = slots.value.near(b.column("label").to_numpy()[None, :], lo, hi).any(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(b.column("block").to_numpy()[need], pa.int64())], schema=schema)

    return blocks.select("block", "label", "lo", "hi").mapInArrow(run, "block long")


def search(blocks: DataFrame, dim: int, windows: Slots, k: int) -> DataFrame:
    """slot, rank, vec_id, score: the first ``k`` rows of every window."""
    slots = blocks.sparkSession.sparkContext.broadcast(windows)
    need = written(choose_blocks(blocks, dim, slots), "hard-need")
    schema = pa.schema([("slot", pa.int64()), ("vec_id", pa.int64()), ("ref", pa.int64()), ("score", pa.int64())])

    def best(found: np.ndarray) -> np.ndarray:
        """The first k rows (slot, id, ref, score) of each slot."""
        found = found[np.lexsort((found[:, 2], found[:, 1], -found[:, 3], found[:, 0]))]
        starts = np.flatnonzero(np.concatenate([[True], found[1:, 0] != found[:-1, 0]])) if len(found) else np.zeros(0, int)
        place = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
        return found[place < k]

    def run(frames):
        w = slots.value
        floor = w.lo.copy()
        kept, new, size = np.zeros((0, 4), np.int64), [], 0
        order = np.argsort(w.anchor, kind="stable")
        first = np.searchsorted(w.anchor[order], np.arange(len(w.vecs) + 1))
        for b in slices(frames, 1):
            row = b.to_pylist()[0]
            lo, hi = (np.frombuffer(row[c], "<i4").reshape(1, dim).astype(np.int64) for c in ("lo", "hi"))
            anchors = np.flatnonzero(w.near(row["label"], lo, hi)[:, 0])
            if not len(anchors):
                continue
            ids, vecs = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vecs"], "<i4").reshape(-1, dim).astype(np.int64)
            refs = (row["block"] << 10) + np.arange(len(ids))
            for at in range(0, len(anchors), 512):
                some = anchors[at:at + 512]
                scores = products(w.vecs[some], vecs)
                own = [order[first[a]:first[a + 1]] for a in some]
                mine, of = np.concatenate(own), np.repeat(np.arange(len(some)), [len(o) for o in own])
                s = scores[of]
                i, j = np.nonzero((s >= floor[mine][:, None]) & (s <= w.hi[mine][:, None]) & (refs[None, :] != w.refs[some][of][:, None]))
                if len(i):
                    new.append(np.stack([mine[i], ids[j], refs[j], s[i, j]], axis=1))
                    size += len(i)
            if size > 100_000:
                kept, new, size = best(np.concatenate([kept, *new])), [], 0
                full = kept[k - 1:][kept[k - 1:, 0] == kept[:len(kept) - k + 1, 0]]  # every slot's k-th row
                floor[full[:, 0]] = full[:, 3]
        kept = best(np.concatenate([kept, *new]))
        for at in range(0, len(kept), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in kept[at:at + 50_000].T], schema=schema)

    # The list of blocks decides the join by its size: Spark broadcasts it below its own threshold.
    read = blocks.select("block", "label", "ids", "vecs", "lo", "hi").join(need, "block", "left_semi")
    found = read.mapInArrow(run, "slot long, vec_id long, ref long, score long")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id", "ref"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("slot", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def waves(blocks: DataFrame, wave: int = WAVE) -> list[tuple[int, int]]:
    """Ranges of units of anchors (a task's part of the curve, or a piece of that) with about ``wave`` anchors."""
    units = blocks.groupBy("unit").agg(F.sum("n_anchors").alias("n")).collect()
    out, n = [], wave
    for unit, size in sorted((r["unit"], r["n"]) for r in units):
        if n + size > wave:
            out.append([unit, unit])
            n = 0
        out[-1][1], n = unit, n + size
    return [tuple(w) for w in out]


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), block: int = BLOCK, wave: int = WAVE, sample: int = SAMPLE) -> DataFrame:
    """For every anchor of ``rows(vec_id, label, vec)`` and each of its first ``positives``
    rows of the same label: the first ``negatives`` rows of other labels with a score from ``share`` of the positive's up to it."""
    spark = rows.sparkSession
    blocks, dim = blocks_of(rows, is_anchor, positives, block, sample)
    holds = blocks.filter("n_anchors > 0").select("part", "block", "label", "n_anchors", "ids", "vecs", "anchors", "seeds")
    so_far = F.sum("n_anchors").over(Window.partitionBy("part").orderBy("block"))
    holds = holds.withColumn("unit", F.col("part") * F.lit(1 << 24).cast("long") + F.floor((so_far - 1) / wave))
    holds = written(holds, "hard-anchors")
    num, den = share
    done = None
    for first, last in waves(holds, wave):
        here = holds.filter(F.col("unit").between(first, last)).orderBy("block").collect()
        at = [np.frombuffer(r["anchors"], "<i4") for r in here]
        ids = np.concatenate([np.frombuffer(r["ids"], "<i8")[a] for r, a in zip(here, at, strict=True)])
        vecs = np.concatenate([np.frombuffer(r["vecs"], "<i4").reshape(-1, dim)[a] for r, a in zip(here, at, strict=True)]).astype(np.int64)
        labels = np.repeat([r["label"] for r in here], [len(a) for a in at])
        refs = np.concatenate([(r["block"] << 10) + a.astype(np.int64) for r, a in zip(here, at, strict=True)])
        seeds = np.concatenate([np.frombuffer(r["seeds"], "<i8") for r in here])
        del here
        same = Slots(vecs, labels, refs, np.arange(len(ids)), seeds, np.full(len(ids), FAR), True)
        near = sorted((r["slot"], r["rank"], r["vec_id"], r["score"]) for r in search(blocks, dim, same, positives).collect())
        low = [-(-num * score // den) for *_, score in near]
        other = Slots(vecs, labels, refs, [a for a, *_ in near], low, [score for *_, score in near], False)
        table = spark.createDataFrame([(s, int(ids[a]), v, score) for s, (a, _, v, score) in enumerate(near)], "_slot long, anchor_id long, positive_id long, positive_score long")
        found = search(blocks, dim, other, negatives).join(F.broadcast(table), F.col("slot") == F.col("_slot"))
        found = written(found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-found")
        done = found if done is None else done.unionByName(found)
    return spark.createDataFrame([], RESULT) if done is None else done
