"""Language identification of mixed texts by expectation-maximisation.

Each language has an additively smoothed model of byte 4-grams of lower-cased text
(hashed to a fixed number of buckets). A text is cut into blocks of bytes; a block's
log-likelihood under every language comes from its n-grams. Expectation-maximisation
over the blocks estimates the document's language proportions; of the sets of one
language up to all (nested by proportion) the one with the best penalised likelihood
wins, and its largest language is the prediction.

Models are fitted on at most ``per_language`` documents of each language (an even
hash sample; the bound is a parameter); every whole text is predicted. Texts that
are null or hold no letter are ``und`` with score 0, and so are all if there is
nothing to learn from. Repeated rows get equal results; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches
from ledgerlake.llm.token_counts import _arrow

PER_LANGUAGE, BUCKETS, BLOCK, ROUNDS = 2000, 16, 64, 15
LETTER = re.compile(r"[^\W\d_]")
PART = 1 << 21


def slots(buf: np.ndarray) -> np.ndarray:
    """Bucket of the 4-gram that starts at each byte (the last three: of what is left)."""
    padded = np.concatenate([buf, np.full(3, 32, dtype=np.uint8)])
    g = np.ndarray((len(buf),), dtype="<u4", buffer=padded, strides=(1,))
    return (g * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS)


def raw(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "surrogatepass") + b" "


def learn(train: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log-probabilities, one row of buckets per language."""
    rows = train.filter("lang is not null and text is not null and text != ''").select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.join(F.broadcast(sizes), "lang").filter(share < per_language / F.col("n")).select("lang", "text")

    def count(frames):
        sums: dict[str, np.ndarray] = {}
        for b in frames:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                got = np.bincount(slots(np.frombuffer(raw(t), dtype=np.uint8)), minlength=1 << BUCKETS)
                sums[lang] = sums[lang] + got if lang in sums else got
        yield from batches(((k, v.astype(np.int64).tobytes()) for k, v in sums.items()), pa.schema([("lang", pa.string()), ("counts", pa.binary())]))

    parts = some.repartition(8).mapInArrow(count, "lang string, counts binary").collect()
    langs = sorted({r["lang"] for r in parts})
    table = np.full((len(langs), 1 << BUCKETS), 0.5)
    for r in parts:
        table[langs.index(r["lang"])] += np.frombuffer(r["counts"], dtype=np.int64)
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def proportions(like: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over blocks of many documents at once: proportions and log-likelihood per document."""
    n = np.diff(np.append(first, len(like)))[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    top = like.max(axis=1, keepdims=True)
    ratio = np.exp(like - top)
    for _ in range(ROUNDS):
        post = ratio * share[doc]
        post /= post.sum(axis=1, keepdims=True).clip(1e-300)
        share = np.add.reduceat(post, first, axis=0) / n
    mixed = (ratio * share[doc]).sum(axis=1).clip(1e-300)
    return share, np.add.reduceat(np.log(mixed) + top[:, 0], first)


def mixtures(texts: list[bytes], table: np.ndarray, penalty: float = 6.0) -> tuple[np.ndarray, np.ndarray]:
    """Per text: proportions of the chosen set of languages (others 0), and the set's size."""
    lengths = np.array([len(t) for t in texts])
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    doc = np.repeat(np.arange(len(texts)), blocks)
    starts = (np.cumsum(lengths) - lengths)[doc] + (np.arange(len(doc)) - first[doc]) * BLOCK
    at = slots(np.frombuffer(b"".join(texts), dtype=np.uint8))
    like = np.stack([np.add.reduceat(row[at], starts).astype(np.float64) for row in table], axis=1)
    langs = like.shape[1]
    share, total = proportions(like, doc, first, np.ones((len(texts), langs)))
    order = np.argsort(-share, axis=1, kind="stable")
    best = np.full(len(texts), -np.inf)
    out, size = np.zeros_like(share), np.zeros(len(texts), dtype=np.int64)
    for k in range(1, langs + 1):
        allowed = np.zeros_like(share)
        np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
        got, fit = proportions(like, doc, first, allowed)
        value = fit - penalty * (k - 1) * np.log1p(blocks)
        better = value > best
        out[better], size[better], best[better] = got[better], k, value[better]
    return out, size


def identify(docs: DataFrame, train: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, lang_pred, score (its proportion), n_langs for every row of ``docs``."""
    langs, table = learn(train, per_language)
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))
    schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_langs", pa.int64())])

    def part(ids, texts):
        names, model = shared.value
        if names and texts:
            share, size = mixtures(texts, model)
            for d, k, s, n in zip(ids, share.argmax(axis=1).tolist(), share.max(axis=1).tolist(), size.tolist(), strict=True):
                yield d, names[k], min(1.0, s), n
        else:
            for d in ids:
                yield d, "und", 0.0, 0

    def rows(b):
        ids, texts, size = [], [], 0
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            if t is None or LETTER.search(t) is None:
                yield d, "und", 0.0, 0
                continue
            ids.append(d)
            texts.append(raw(t))
            size += len(texts[-1])
            if size >= PART:
                yield from part(ids, texts)
                ids, texts, size = [], [], 0
        yield from part(ids, texts)

    def run(frames):
        for b in frames:
            yield from batches(rows(b), schema)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_langs long")
