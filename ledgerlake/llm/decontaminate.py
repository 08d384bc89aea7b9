"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised alike: lower-cased, ASCII punctuation and
white space collapsed to one space, UTF-8. The patterns of an item are all its windows of
``words`` words (the first ``length`` bytes of longer ones) and its windows of ``length``
bytes, one every ``step``; an item shorter than both is one pattern. A pattern of m bytes
may differ by ``k`` edits (``rate`` of its length). So any ``words`` consecutive words of an
item are found wherever they start, within the edits of their pattern; and any ``length``
consecutive bytes, with ``step // 2`` edits less. By the q-gram lemma a match shares
at least m - q + 1 - kq q-grams with it, on diagonals at most k apart:

1. regions of the text where too few positions carry any benchmark q-gram go;
2. in the rest, shared q-grams are counted per item in overlapping diagonal bands of twice
   the largest k + 1 diagonals; hits of bands under the least bound of its patterns go;
3. what is left is counted per pattern in bands of twice k + 1 diagonals;
4. bands that do not hold the pattern as it is are verified by a banded semi-global alignment.

The benchmark is the query set: it is taken in blocks of about ``block_bytes`` of text
(an item is never cut), each broadcast and held against every row of every whole text.

Null and empty texts match nothing, nor do items of fewer than ``q`` bytes. Repeated
rows give equal rows of the result each; extra columns are ignored (``clean`` keeps
them); a row without an id is judged by its own text; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import aside, batches, slices
from ledgerlake.llm.token_counts import _arrow

Q, LENGTH, RATE, BLOCK_BYTES = 8, 80, 0.075, 2 << 20
WORDS, STEP = 13, 5
#: ASCII bytes that are neither letters nor digits become spaces.
TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
PART = 1 << 20
#: Bytes of text whose hits are counted per pattern at a time.
STRETCH = 1 << 15


def normal(text: str | None) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(TABLE).split()) if text else b""


def grams(buf: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-gram at each position as an unsigned integer (q of 8: a view, no copy)."""
    n = max(0, len(buf) - q + 1)
    if q == 8:
        return np.ndarray((n,), dtype="<u8", buffer=buf.tobytes() if not buf.flags.c_contiguous else buf, strides=(1,))
    out = np.zeros(n, dtype=np.uint64)
    for k in range(q):
        out |= buf[k:k + n].astype(np.uint64) << np.uint64(8 * k)
    return out


@dataclass
class Patterns:
    """Patterns of one block of items (item, start, end; in order), with an index from
    q-gram to places in the items, which lie in one buffer further apart than any pattern is long."""

    ids: list
    bodies: list[bytes]
    cuts: list[tuple[int, int, int]]
    q: int
    rate: float

    def __post_init__(self) -> None:
        item, start, end = np.array(self.cuts, dtype=np.int64).reshape(-1, 3).T
        self.item, self.m = item, end - start
        m = self.m
        self.k = np.minimum((m * self.rate).astype(np.int64), (m - self.q) // self.q)
        self.need = m - self.q + 1 - self.k * self.q
        self.span = int((m + self.k).max(initial=1))
        self.least = int(self.need.min(initial=1 << 30))
        lengths = np.array([len(t) for t in self.bodies], dtype=np.int64)
        self.longest = int(lengths.max(initial=0))
        self.base = np.cumsum(lengths + self.span) - lengths - self.span
        self.whole = b"".join(t + bytes(self.span) for t in self.bodies)
        self.start = self.base[item] + start
        #: What holds for every pattern of an item.
        self.item_k, self.item_need = np.zeros(len(lengths), dtype=np.int64), np.full(len(lengths), 1 << 30, dtype=np.int64)
        np.maximum.at(self.item_k, item, self.k)
        np.minimum.at(self.item_need, item, self.need)
        every = [grams(np.frombuffer(t, dtype=np.uint8), self.q) for t in self.bodies]
        g = np.concatenate(every) if every else np.empty(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(every)), [len(e) for e in every])
        place = np.concatenate([np.arange(len(e)) for e in every]) if every else np.empty(0, dtype=np.int64)
        order = np.argsort(g, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first, self.times = np.unique(g[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.slot(self.keys)] = True

    @property
    def items(self) -> list:
        return [self.ids[j] for j in self.item]

    @property
    def texts(self) -> list[bytes]:
        return [self.text(o) for o in range(len(self.m))]

    def text(self, o: int) -> bytes:
        return self.whole[self.start[o]:self.start[o] + self.m[o]]

    @staticmethod
    def slot(g: np.ndarray) -> np.ndarray:
        return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def patterns(items: list[tuple], q: int = Q, length: int = LENGTH, rate: float = RATE, words: int = WORDS, step: int = STEP) -> Patterns:
    ids, bodies, cuts = [], [], []
    for item, text in items:
        t = normal(text)
        if len(t) < q:
            continue
        starts = [0, *(at + 1 for at, c in enumerate(t) if c == 32)]
        ends = [*(s - 1 for s in starts[1:]), len(t)]
        of_words = {(s, min(e, s + length)) for s, e in zip(starts, ends[words - 1:] or [len(t)], strict=False)}
        of_bytes = {(s, min(len(t), s + length)) for s in (*range(0, max(1, len(t) - length + 1), step), max(0, len(t) - length))}
        cuts += [(len(ids), s, e) for s, e in sorted(of_words | of_bytes) if e - s >= q]
        ids.append(item)
        bodies.append(t)
    return Patterns(ids, bodies, cuts, q, rate)


def spread(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (``times`` of them) for each element, one after the other."""
    return np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def banded(owner: np.ndarray, diagonal: np.ndarray, k: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The overlapping bands (owner << 40 | band) that hold as many hits as their owner
    needs, and each hit's own band."""
    code = (owner << 40) + diagonal // (k[owner] + 1)
    some, count = np.unique(np.concatenate([code, code - 1]), return_counts=True)
    return some[count >= need[some >> 40]], code


def candidates(buf: np.ndarray, p: Patterns) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pattern, first diagonal of a band) where the q-gram lemma allows a match, one
    stretch of the text after the other. The text begins and ends with bytes of no pattern."""
    g = grams(buf, p.q)
    hit = p.filter[p.slot(g)]
    total = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
    span = min(p.span, len(g)) or 1
    dense = total[span:] - total[:len(total) - span] >= p.least
    if not dense.any():
        return
    edge = np.zeros(len(g) + 1, dtype=np.int32)
    at = np.flatnonzero(dense)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + span, -1)
    pos = np.flatnonzero(hit & (edge[:-1].cumsum() > 0))
    key = g[pos]
    k = np.searchsorted(p.keys, key).clip(max=len(p.keys) - 1)
    real = p.keys[k] == key
    pos, k = pos[real], k[real]
    i, entry = np.repeat(pos, p.times[k]), spread(p.first[k], p.times[k])
    item, place = p.owner[entry], p.place[entry]
    good, code = banded(item, i - place + p.longest, p.item_k, p.item_need)
    left = np.isin(code, good) | np.isin(code - 1, good)
    i, place = i[left], place[left] + p.base[item[left]]
    # A band's hits lie less than its width and the pattern's length behind its first diagonal:
    # each stretch sees them all for the bands that begin in it.
    reach = 4 * p.span
    for x in np.union1d(i // STRETCH, (i - reach) // STRETCH) * STRETCH:
        some = slice(*np.searchsorted(i, [x, x + STRETCH + reach]))
        low, high = np.searchsorted(p.start, place[some] + p.q - p.span), np.searchsorted(p.start, place[some], side="right")
        own = spread(low, high - low)
        h, at = np.repeat(i[some], high - low), np.repeat(place[some], high - low)
        inside = at + p.q <= p.start[own] + p.m[own]
        own, h, at = own[inside], h[inside], at[inside]
        good, _ = banded(own, h - (at - p.start[own]) + p.span, p.k, p.need)
        own = good >> 40
        first = (good & ((1 << 40) - 1)) * (p.k[own] + 1) - p.span
        begins = (first >= x) & (first < x + STRETCH)
        if begins.any():
            yield own[begins], first[begins]


def align(buf: np.ndarray, p: Patterns, own: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of a pattern against any stretch of text whose path stays in the band
    (with k diagonals to either side), and where the best one ends. All candidates row by row."""
    k_max = int(p.k[own].max())
    width = 2 * (k_max + 1) + 2 * k_max
    m = p.m[own]
    rows = int(m.max())
    text = np.zeros((len(own), rows), dtype=np.uint8)
    for c, o in enumerate(own):
        text[c, :m[c]] = np.frombuffer(p.text(o), dtype=np.uint8)
    padded = np.concatenate([buf, np.zeros(1, dtype=np.uint8)])
    lanes = np.arange(width)
    base = first - p.k[own]
    cost = np.zeros((len(own), width), dtype=np.int32)  # a match may start anywhere in the band
    best, end = np.full(len(own), 1 << 20), np.zeros(len(own), dtype=np.int64)
    for r in range(rows):
        # Lane l of row r ends before text position base + r + l.
        at = base[:, None] + r + lanes
        inside = (at >= 0) & (at < len(buf))
        same = inside & (padded[np.where(inside, at, len(buf))] == text[:, r:r + 1])
        straight = cost + ~same
        skipped = np.concatenate([cost[:, 1:], np.full((len(own), 1), 1 << 20, dtype=np.int32)], axis=1) + 1
        cost = np.minimum(straight, skipped)
        cost = np.minimum.accumulate(cost - lanes, axis=1) + lanes
        last = m == r + 1
        if last.any():
            best[last] = cost[last].min(axis=1)
            end[last] = base[last] + r + 1 + cost[last].argmin(axis=1)
    return best, end


def verify(whole: bytes, p: Patterns, own: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``align``; a band that holds the pattern as it is needs no alignment."""
    best, end = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
    for c, (o, f, k, m) in enumerate(zip(own.tolist(), first.tolist(), p.k[own].tolist(), p.m[own].tolist(), strict=True)):
        end[c] = whole.find(p.text(o), max(0, f - k), f + 3 * k + 1 + m) + m
    rest = np.flatnonzero(end < p.m[own])
    for c in range(0, len(rest), 4096):
        some = rest[c:c + 4096]
        best[some], end[some] = align(np.frombuffer(whole, dtype=np.uint8), p, own[some], first[some])
    return best, end


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, length: int = LENGTH, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_patterns, min_edits, first_byte, end_byte (in the normalised
    text): a row per row of ``docs`` and item of which a pattern matches."""
    spark = docs.sparkSession
    known = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    blocks = max(1, -(-(known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    out = None
    for b in range(blocks):
        some = [tuple(r) for r in known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        got = _block(docs, spark.sparkContext.broadcast(patterns(some, q, length, rate)), benchmark)
        out = got if out is None else out.unionByName(got)
    return out


def _block(docs: DataFrame, shared, benchmark: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("item_id", _arrow(benchmark, "item_id")), *((n, pa.int64()) for n in ("n_patterns", "min_edits", "first_byte", "end_byte"))])

    def part(ids, texts):
        p = shared.value
        if not len(p.m):
            return
        # Texts stand apart by more than any band is wide, by bytes that no pattern holds.
        gap = bytes(4 * p.span)
        lengths = np.array([len(t) for t in texts])
        starts = np.cumsum(lengths + len(gap)) - lengths
        whole = gap + gap.join(texts) + gap
        found: dict[tuple[int, int], list] = {}
        for own, first in candidates(np.frombuffer(whole, dtype=np.uint8), p):
            best, end = verify(whole, p, own, first)
            ok = best <= p.k[own]
            row = np.maximum(np.searchsorted(starts, end[ok], side="left") - 1, 0)
            for x, d, e, z in zip(own[ok].tolist(), row.tolist(), best[ok].tolist(), end[ok].tolist(), strict=True):
                z -= int(starts[d])
                begin = max(0, z - int(p.m[x]))
                got = found.setdefault((d, int(p.item[x])), [set(), e, begin, z])
                got[0].add(x)
                got[1:] = min(got[1], e), min(got[2], begin), max(got[3], z)
        for (d, item), (own, least, begin, z) in sorted(found.items(), key=lambda x: x[0][0]):
            yield ids[d], p.ids[item], len(own), least, begin, z

    def rows(b):
        ids, texts, size = [], [], 0
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            n = normal(t)
            if n:
                ids.append(d)
                texts.append(n)
                size += len(n)
            if size >= PART:
                yield from part(ids, texts)
                ids, texts, size = [], [], 0
        if texts:
            yield from part(ids, texts)

    def run(frames):
        for b in slices(frames):
            yield from batches(rows(b), schema)

    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, n_patterns long, min_edits long, first_byte long, end_byte long")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark pattern matches (all columns). Rows that
    share an id, or have none, are judged each by its own text."""
    rows, back = aside(docs, "doc_id", "text")
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    hit = matches(rows.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id.doc_id").alias("_hit"), F.col("doc_id.h").alias("_hash")).distinct()
    return back(rows.join(hit, F.col("doc_id").eqNullSafe(F.col("_hit")) & (F.xxhash64("text") == F.col("_hash")), "left_anti"))
