"""Substring de-duplication by level-wise doubling.

Windows of a quarter of the wanted length (13 words for 50) that occur in more than
one document are extended to twice that length; those repeated there are extended
again, capped at the wanted length; what survives is removed. Three properties keep
it exact and cheap:

* Level 1 looks at winnowed windows only: of the windows inside any ``window``
  consecutive words the one with the least hash. A repeated passage selects the
  same windows in every document, so none is lost.
* A surviving window is extended to the right and to the left; inside a repeated
  passage at least one of the two stays inside it, so its double is repeated too.
* Windows equal in all their words are told by 128 bits of hash at the last level.

Documents whose whole word sequence repeats that of a smaller id (``window`` words
or more) are removed whole beforehand: the windows of the first stand for theirs.

A word goes if some window that covers it also starts in a document with a smaller
doc_id; windows are judged on the input. Null text has no words. Rows with the same
id never remove each other's words; rows without an id are neither cut nor reason to
cut others. Repeated rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import aside, batches, slices, words_of, written
from ledgerlake.llm.token_counts import _arrow

WINDOW = 50
#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (multiply and fold)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            grow = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64), dtype=np.uint64)])
            self.up, self.down = grow(self.base), grow(self.back)
        return self.up[:n], self.down[:n]


POWERS = [Powers(b) for b in BASES]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def rolling(h: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every window of ``size`` words: differences of prefix sums, shifted back."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    up, down = POWERS[which].get(len(h))
    if which:
        h = mix(h)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * up, dtype=np.uint64)])
    return mix((sums[size:] - sums[:n]) * down[:n])


def winnow(h: np.ndarray, span: int) -> np.ndarray:
    """Positions of the least hash of every ``span`` consecutive ones (the rightmost of equals)."""
    if len(h) < span:
        return np.empty(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h[::-1], span)
    out = []
    for k in range(0, len(view), 1 << 14):
        part = view[k:k + (1 << 14)]
        out.append(np.unique(part.argmin(axis=1) + np.arange(k, k + len(part))))
    return np.unique(len(h) - 1 - np.concatenate(out))


def levels(window: int) -> tuple[int, int]:
    """Lengths of the first two levels; the third is ``window``."""
    seed = max(1, -(-window // 4))
    return seed, min(window, 2 * seed)


def profile(docs: DataFrame, window: int) -> DataFrame:
    """Per row: word count, digest of all words, and the winnowed seed windows with
    the hashes of their doubles to the right and to the left (0: does not fit)."""
    seed, double = levels(window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("digest", pa.string()),
                        ("seeds", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("left", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])

    def rows(b):
        for d, key, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
            words = words_of(t)
            digest = hashlib.sha256(b" ".join(words)).hexdigest()
            h = word_hashes(words) if len(words) >= window else np.empty(0, dtype=np.uint64)
            small = rolling(h, seed)
            at = winnow(small, window - seed + 1)
            both = rolling(h, double)
            right, left = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.uint64)
            fits = at < len(both)
            right[fits] = both[at[fits]]
            fits = at >= double - seed
            left[fits] = both[at[fits] - (double - seed)]
            yield d, key, len(words), digest, small[at].view(np.int64), right.view(np.int64), left.view(np.int64), at.astype(np.int32)

    def run(frames):
        for b in slices(frames):
            yield from batches(rows(b), schema, size=200)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_words long, digest string, seeds array<long>, right array<long>, left array<long>, at array<int>")


def repeated(df: DataFrame, *key: str) -> DataFrame:
    """Rows whose key occurs in more than one document, with the smallest id that has
    it. The ids are pre-aggregated and written, so that the join reads two plain
    exchanges and a key of a third of all rows is split between tasks."""
    least = df.groupBy(*key).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most")
    return df.join(written(least, "substring-least"), list(key))


def last_level(docs: DataFrame, survivors: DataFrame, window: int) -> DataFrame:
    """h1, h2, doc_id, text_hash, p: all windows of full length around surviving doubles."""
    _, double = levels(window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("text_hash", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("p", pa.int32())])
    key = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spots = survivors.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("spots"))

    def run(frames):
        for b in slices(frames):
            for d, k, t, spots in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_hash", "text", "spots")), strict=True):
                h = word_hashes(words_of(t))
                h1, h2 = rolling(h, window), rolling(h, window, 1)
                edge = np.zeros(len(h1) + 1, dtype=np.int64)
                s = np.asarray(spots)
                np.add.at(edge, (s - (window - double)).clip(min=0), 1)
                np.add.at(edge, (s + 1).clip(max=len(h1)), -1)
                p = np.flatnonzero(edge[:-1].cumsum() > 0)
                for c in range(0, len(p), 1 << 15):
                    q = p[c:c + (1 << 15)]
                    yield pa.RecordBatch.from_arrays([pa.array([d] * len(q), type=schema.field(0).type), pa.array(np.full(len(q), k)), pa.array(h1[q].view(np.int64)), pa.array(h2[q].view(np.int64)), pa.array(q.astype(np.int32))], schema=schema)

    return key.join(spots, ["doc_id", "text_hash"]).mapInArrow(run, f"doc_id {kind}, text_hash long, h1 long, h2 long, p int")


def removals(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(profile rows, with ``whole`` true where a smaller id has the same words;
    doc_id, text_hash, starts: windows to remove)."""
    seed, double = levels(window)
    rows = written(profile(docs, window), "substring-profile")
    first = rows.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    first = written(first.filter("least < most").drop("most"), "substring-copies")
    # A merge join, whose rows AQE splits where a group of copies is large: the digest
    # is not among the columns made distinct next, which therefore has its own exchange.
    facts = rows.select("doc_id", "text_hash", "n_words", "digest").join(first.hint("merge"), "digest", "left")
    whole = F.coalesce((F.col("least") < F.col("doc_id")) & (F.col("n_words") >= window), F.lit(False))
    facts = written(facts.select("doc_id", "text_hash", "n_words", whole.alias("whole")).distinct(), "substring-facts")
    firsts = rows.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull()).join(facts.filter("whole").select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_anti")
    seeds = firsts.select("doc_id", "text_hash", F.explode(F.arrays_zip("seeds", "right", "left", "at")).alias("s")).select("doc_id", "text_hash", F.col("s.seeds").alias("h"), F.col("s.right").alias("right"), F.col("s.left").alias("left"), F.col("s.at").alias("at"))
    kept = repeated(seeds, "h")
    doubles = kept.select("doc_id", "text_hash", F.explode(F.array(
        F.struct(F.col("right").alias("h"), F.col("at").alias("at")),
        F.struct(F.col("left").alias("h"), (F.col("at") - (double - seed)).alias("at")))).alias("d")).select("doc_id", "text_hash", F.col("d.h").alias("h"), F.col("d.at").alias("at")).filter("h != 0").distinct()
    survivors = written(repeated(written(doubles, "substring-doubles"), "h").select("doc_id", "text_hash", "at"), "substring-survivors")
    full = written(last_level(docs, survivors, window), "substring-windows")
    gone = repeated(full, "h1", "h2").filter("least < doc_id")
    starts = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("p").alias("starts"))
    return facts, starts


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) plus n_words, n_removed, kept (kept words joined by one space),
    which replace columns of these names."""
    own = ("n_words", "n_removed", "kept")
    docs, back = aside(docs.drop(*own), "doc_id", "text")
    facts, starts = removals(docs, window)
    todo = facts.join(starts, ["doc_id", "text_hash"], "left").withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash").select("_id", "_hash", "n_words", "whole", "starts")
    joined = docs.join(todo, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))).drop("_id", "_hash")

    @F.pandas_udf("n long, kept string")
    def cut(text, whole, starts):
        import pandas as pd
        out = []
        for t, w, s in zip(text, whole, starts, strict=True):
            words = words_of(t)
            if w:
                out.append((len(words), ""))
                continue
            if s is not None and len(s):
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                s = np.asarray(s)
                edge[s] += 1
                edge[s + window] -= 1
                gone = edge[:-1].cumsum() > 0
                out.append((int(gone.sum()), b" ".join(x for x, g in zip(words, gone, strict=True) if not g).decode("utf-8", "surrogatepass")))
            else:
                out.append((0, b" ".join(words).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["n", "kept"])

    done = joined.withColumn("_cut", cut("text", "whole", "starts"))
    return back(done, n_words=F.col("n_words"), n_removed=F.col("_cut.n"), kept=F.col("_cut.kept"))
