"""The prefix trie against a plain recursive version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 int, n_convs int"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        below = [out[k] for k in kids[p]]
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(built[c]) == len(p)))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), sum(b[5] for b in below) or 1,
                  saved + sum(b[6] for b in below), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def rows_of(n, seed, deep=0):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.choice([1, 2, 2, 5, 12])):
            rows.append((c * r.choice([1, 1, 2]), r.choice([t, t, t, None]), r.choice(["user", "assistant", None]), r.choice(["a", "b", "é日", "", None])))
    rows += [(100_000, t, "user", f"x{t % 3}") for t in range(deep)] + [(100_005, t, "user", f"x{t % 3}") for t in range(deep)]
    rows += [(None, 1, "user", "lost")] * 3 + [(7, 1, "user", "same")] * 4
    return [(*x, "clash", 5, 6) for x in rows]


@pytest.mark.parametrize("n, deep", [(120, 0), (40, 300)])
def test_trie_equals_the_recursive_version(spark, n, deep, monkeypatch):
    monkeypatch.setattr(prefix_trie.prefixes, "__defaults__", (16,))  # long conversations in many segments
    rows = rows_of(n, n, deep)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_trie_of_nothing_and_of_long_texts(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", 1, 1)], SCHEMA)).count() == 0
    rows = [(c, 0, "user", "long " * 50_000, "", 1, 1) for c in (5, 6, 10)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_lookup_splits_hot_keys(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v")).filter("k <> 700")
    got = prefix_trie.lookup(left, right, {"k": "k"}, "n", ["v"], most=2)
    want = left.join(right.select("k", "v"), "k", "left").select("k", "id", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 1000
