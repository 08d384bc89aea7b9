"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, slot int, rank int, block string"


def expected(rows, positives=5, negatives=5):
    ok = [(i, int(lab), [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, lab, *_ in rows
          if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for n, (i, lab, v) in enumerate(ok):
        if i % 10:
            continue
        scored = sorted((-dot(v, w), j, m) for k, (j, m, w) in enumerate(ok) if k != n)
        for s, p, m in [x for x in scored if x[2] == lab][:positives]:
            near = [x for x in scored if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(near)]
    return sorted(out)


def clustered(n, dim, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.3, (8, dim))
    return [(k, [float(x) for x in centres[k % 8] + r.normal(0, 0.05, dim)], int(r.integers(0, 3)), 1, 1, "clash") for k in range(n)]


@pytest.mark.parametrize("block, wave", [(16, 7), (512, 8192)])
def test_mining_equals_brute_force(spark, block, wave):
    rows = clustered(400, 12, block)
    rows += [(1000 + k, rows[3][1], rows[3][2], 1, 1, "") for k in range(30)]  # ties
    rows += [(50, rows[50][1], rows[50][2], 1, 1, ""), (None, rows[1][1], 1, 1, 1, ""), (2000, None, 1, 1, 1, ""), (2010, [0.1, None], 1, 1, 1, ""), (2020, [float("nan")] * 12, 1, 1, 1, ""),
             (2030, [float("inf")] * 12, 1, 1, 1, ""), (2040, rows[2][1], None, 1, 1, ""), (2050, [], 1, 1, 1, ""), (2060, [0.3, 0.2], 2, 1, 1, ""), (2070, [3e4] * 12, 0, 1, 1, ""), (3000, rows[9][1], 77, 1, 1, "")]
    made = H.whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = H.mine(made, F.col("vec_id") % 10 == 0, block=block, wave=wave, sample=100)
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_zone_maps_leave_blocks_unread(spark):
    """Far clusters of one label: a window around one of them needs few blocks, and all that hold a row of it."""
    rows = [(k, v, 1, *rest) for k, v, _, *rest in clustered(2000, 6, 5)]
    blocks, dim = H.blocks_of(H.whole_vectors(spark.createDataFrame(rows, SCHEMA)), F.col("vec_id") == 0, 5, block=32)
    vec = np.array([[int(np.floor(256 * np.float32(x))) for x in rows[0][1]]])
    best = int((vec @ vec.T)[0, 0])
    slots = H.Slots(vec, np.array([1]), np.array([-1]), [0], [best * 9 // 10], [best], True)
    need = {r[0] for r in H.choose_blocks(blocks, dim, spark.sparkContext.broadcast(slots)).collect()}
    held = set()
    for r in blocks.collect():
        scores = np.frombuffer(r["vecs"], "<i4").reshape(-1, dim) @ vec[0]
        if ((scores >= best * 9 // 10) & (scores <= best)).any():
            held.add(r["block"])
    assert held <= need and len(need) < blocks.count() / 2


def test_hilbert_neighbours_are_adjacent():
    for dim, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim), axis=-1).reshape(-1, dim)
        key = H.hilbert_key(cells, bits)
        walk = cells[np.argsort(key)]
        assert sorted(key.tolist()) == list(range(len(cells))) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_nothing_to_mine(spark):
    for rows in ([], [(1, None, 1, 1, 1, "")], [(0, [0.5], 1, 1, 1, "")]):
        assert H.mine(H.whole_vectors(spark.createDataFrame(rows, SCHEMA)), F.col("vec_id") % 10 == 0).count() == 0
