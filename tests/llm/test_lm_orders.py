"""The n-gram trie at several orders against brute force, with every context that may be split in pieces."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import lm_scoring
from ledgerlake.llm.queries import op3_lm_scoring

RNG = random.Random(8)
WORDS = ["the", "The", "a", "x", "日本", "rare", "...", "of"]
TEXTS = [" ".join(RNG.choice(WORDS) for _ in range(RNG.randint(0, 40))) for _ in range(50)]
TEXTS += [None, "", " \n ", "a", "the a x " * 60, TEXTS[0], TEXTS[0], "only here unseen", "the only here the a", "unseen the a x"]
ROWS = [(k if k % 9 else None, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (3, "a a a")]


def brute_force(rows, order, held):
    toks = [[None] * (order - 1) + [w.decode() for w in (t or "").encode().lower().split()] + [None] for _, t in rows]
    count, after = {}, {}
    for (d, _), ws in zip(rows, toks, strict=True):
        for i in range(order - 1, len(ws) * (not held(d))):
            for k in range(order):
                context = tuple(ws[i - k:i])
                count[context, ws[i]] = count.get((context, ws[i]), 0) + 1
                after.setdefault(context, {})[ws[i]] = 1
    whole = {c: sum(count[c, w] for w in ws) for c, ws in after.items()}
    n, size = whole.get((), 0), len(after.get((), ()))

    def p(context, w):
        if not context:
            return (count.get(((), w), 0) + 0.1) / (n + 0.1 * (size + 1))
        lower = p(context[1:], w)
        if context not in after:
            return lower
        return max(count.get((context, w), 0) - 0.75, 0) / whole[context] + 0.75 * len(after[context]) / whole[context] * lower

    return sorted((-1 if d is None else d, len(ws) - order + 1, n, sum(np.log10(p(tuple(ws[i - order + 1:i]), ws[i])) for i in range(order - 1, len(ws)))) for (d, _), ws in zip(rows, toks, strict=True))


def same(got, want):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.train_tokens, r.score) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want, strict=True):
        assert abs(g[3] - w[3]) < 0.002 + 4e-4 * w[1]


@pytest.mark.parametrize(("order", "block", "split"), [(1, 10**6, 10**6), (2, 300, 20), (3, 300, 10**6), (3, 200, 7), (4, 10**6, 20)])
def test_every_order_equals_brute_force(spark, order, block, split):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(2)
    held = F.coalesce(F.pmod("doc_id", F.lit(4)) == 0, F.lit(False))
    got = lm_scoring.score(docs, held, block_tokens=block, shards=3, order=order, word_split=split).collect()
    same(got, brute_force(ROWS, order, lambda d: d is not None and d % 4 == 0))


def test_op3_sees_two_words_of_context(spark, tmp_path):
    spark.createDataFrame(ROWS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0
    same(op3_lm_scoring(spark, str(tmp_path)).collect(), brute_force(ROWS, 3, held))


def test_trie_reads_its_levels_from_mapped_files(tmp_path):
    a = np.array
    asked = [(a([0, 0]), a([3, 5]), a([4, 9])), (a([0, 0, 1]), a([3, 5, 3]), a([0, 2, 0])), (a([0, 1, 1]), a([5, 3, 9]), a([1, 0, 2]))]
    trie = lm_scoring.Trie(str(tmp_path), asked, 0.75, lambda c: c / 13)
    at = trie.find(0, a([0, 0, 0]), a([3, 4, 5]))
    assert at.tolist() == [0, -1, 1]
    assert trie.find(1, a([0, 0, 1, -1]), a([3, 5, 3, 3])).tolist() == [0, 1, -1, -1]  # (3, 3) is kept as the way to (3, 3, 5)
    assert trie.find(2, a([0, 1, 1]), a([5, 3, 9])).tolist() == [0, -1, 1]
    assert trie.share[1].tolist() == [lm_scoring.ABSENT, lm_scoring.quantise(a([1.25 / 2]))[0]]
    assert np.allclose(lm_scoring.restore(trie.share[0]), a([4, 9]) / 13, rtol=2e-4) and trie.total[2].tolist() == [1, 2]
    assert {f.name for f in tmp_path.iterdir()} == {"1", "2", "3"} and isinstance(trie.successors[2].low.base, np.memmap)
