"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: the text with A-Z lower-cased is cut into words, words into shingles
(repeats included), each shingle hashed by XXH64 with seed 42; a bit is set if it
is set in over half the hashes. No words: fingerprint zero, linked like any other.

Links: fingerprints at ``max_bits`` (4) or fewer differing bits. The 64 bits form a
ring of five segments. By the pigeonring principle some start ``i`` has every chain
of consecutive segments from ``i`` within its proportional share of the budget:
no difference in one segment, at most 1 in two, 2 in three, 3 in four, 4 in five.
The first three of these conditions become exact keys: the first segment is equal;
of the halves (a, b) of the second and (c, d) of the third at least ab, ac, ad, bc
or bd are equal. Candidates that share a key must pass the whole chain from that
start before the full Hamming check.

Large groups: a key whose fingerprints exceed ``bucket`` is not expanded to pairs.
Its fingerprints go through a blocked path that is exact as well: two fingerprints
are within 4 bits exactly if their balls of radius 2 meet, so each of them is
linked with the smallest fingerprint of every ball point. That is a fixed number
of rows per fingerprint, whatever the size of the group.

Components take the smallest doc_id, by label propagation with pointer jumping on
fingerprints; nothing but convergence counts reaches the driver. Null text is empty
text. Null ids take part in links but never name a component unless all are null.
Repeated rows and ids keep a row each; an empty table gives no rows.

Joins whose sides grow with the fingerprints are hinted to merge: Spark sizes an exploded
one as the table before it (keys: 25 times too low, ball points: 2081 times), and would
broadcast millions of rows through the driver. The stars are written first, so Spark knows
their size: it broadcasts small ones, which spares the hub of a group a task of its own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import aside, batches, slices, words_of, written
from ledgerlake.llm.token_counts import _arrow

SHINGLE, MAX_BITS, BUCKET = 4, 4, 512
#: Ring segments (first bit, width) of the pigeonring filter for 4 bits.
RING = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes, as an unsigned integer."""
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 14):
        votes += np.unpackbits(h[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) per row."""
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("fp", pa.int64())])

    def run(frames):
        for b in slices(frames):
            rows = zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
            yield from batches(((d, _signed(fingerprint(words_of(t, lower=True), shingle))) for d, t in rows), schema)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def bits(fp, first: int, width: int):
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def keys(fp):
    """25 exact keys per fingerprint: start, half pair and the bits they fix."""
    out = []
    for i in range(5):
        seg = [RING[(i + k) % 5] for k in range(3)]
        half = []
        for first, width in seg[1:]:
            low = width // 2
            half += [(first, low), (first + low, width - low)]
        for n, (x, y) in enumerate(((0, 1), (0, 2), (0, 3), (1, 2), (1, 3))):
            key = F.lit(i * 5 + n).cast("long")
            for first, width in (seg[0], half[x], half[y]):
                key = F.shiftleft(key, width).bitwiseOR(bits(fp, first, width))
            out.append(key)
    return F.array(*out)


def chain_holds(diff, start):
    """Cumulative differences from a start stay within the proportional budgets;
    the last of the five conditions is the full Hamming check."""
    total, ok = F.lit(0), F.lit(True)
    ring = F.array(*[F.bit_count(bits(diff, f, w)) for f, w in RING])
    for k in range(5):
        total = total + F.element_at(ring, (F.pmod(start + k, F.lit(5)) + 1).cast("int"))
        ok = ok & (total <= (k + 1) * MAX_BITS // 5)
    return ok


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """src, dst pairs of fingerprints that span all groups linked at 4 bits or fewer."""
    keyed = distinct.select("fp", F.posexplode(keys(F.col("fp"))).alias("pos", "key"))
    sizes = keyed.groupBy("pos", "key").agg(F.count("*").alias("n")).filter("n > 1")
    many = written(keyed.join(sizes.hint("merge"), ["pos", "key"]), "simhash-keys")
    grouped = many.filter(F.col("n") <= bucket).groupBy("pos", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    start = F.floor(F.col("pos") / 5)
    rest = F.slice("fps", F.col("at") + 2, F.size("fps"))
    near = F.filter(rest, lambda x: chain_holds(x.bitwiseXOR(F.col("src")), start))
    direct = (grouped.select("pos", "fps", F.posexplode("fps").alias("at", "src"))
              .select("src", F.explode(near).alias("dst")))
    hot = many.filter(F.col("n") > bucket).select("fp").distinct()
    return direct.unionByName(ball_links(hot)).distinct()


def ball_links(hot: DataFrame) -> DataFrame:
    """Each fingerprint with the smallest one of every point within 2 bits of it."""
    one = [1 << k for k in range(64)]
    masks = [0, *one, *(a | b for a, b in combinations(one, 2))]
    ball = F.lit([_signed(m) for m in masks]).cast("array<bigint>")
    points = hot.select("fp", F.explode(F.transform(ball, lambda m: m.bitwiseXOR(F.col("fp")))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("dst"), F.count("*").alias("n")).filter("n > 1")
    return points.join(least.hint("merge"), "point").filter("fp != dst").select(F.col("fp").alias("src"), "dst")


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable), by alternating large and small stars."""
    both = edges.filter("src != dst").select("src", "dst").unionByName(edges.filter("src != dst").select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = written(both.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "stars")
    seen = None
    while True:
        around = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "stars")
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = mark


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs(doc_id, text)``."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    label = components(links(distinct.select("fp"), bucket))
    named = written(distinct.join(label.hint("merge"), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    # Both written: the join then has the rows of a large group to itself and can split them.
    least = written(named.groupBy("label").agg(F.min("least").alias("component_id")), "simhash-least")
    named = named.select("fp", "label").join(least.hint("merge"), "label").select("fp", "component_id")
    return fps.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` (all columns) with one document kept of each group: the smallest
    id, and of repeated rows of that id and text one. Rows without an id cannot be ranked
    and stay, one of each text."""
    rows, back = aside(docs, "doc_id", "text")
    found = near_duplicates(rows.filter("doc_id is not null"), shingle).filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = rows.join(found, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id", "text"])
    return back(kept.unionByName(rows.filter("doc_id is null").dropDuplicates(["text"])))
