"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is an interpolated n-gram model of any ``order`` with absolute discounting over
words and one end token per text; a text's first tokens follow end tokens:

    p(w | u v) = max(c(u v w) - D, 0) / c(u v .) + D T(u v) / c(u v .) * p(w | v), and so on down to
    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),

with all unknown words sharing one place of p; a context not seen in training, or with an
unknown word, leaves the probability to the next shorter one. ``op3`` takes order 3.

The trie has one level per order: words, their successors, the successors of these. It is
cut into shards by first word (and by successor below a frequent context), each a file of
flat buffers that the task which looks n-grams up maps and reads in place. A level is a
monotone (Elias-Fano) sequence of pointers from the nodes above to successor ranges, a
monotone sequence of successors, each shifted by the base of its node, and quantised
logarithms of probabilities (words' too) and of the rests left to the shorter context. An
n-gram is looked up from the root, level by level, by the successor search of (base of its
context's node + its word). The file is the task's own: executors share no local files.

Nothing of the model is broadcast or gathered in one place: documents are tokenised in
blocks of bounded size, each block asks every shard once for its distinct words and
n-grams, and the shards' answers return to the block. So what moves is the distinct n-grams
of the blocks, and one that makes up a third of the corpus is one entry per block. Shards
grow with the training tokens; a context whose rarest word is frequent lies in as many more
pieces, whose shares and rests the block weighs by their tokens.

Null text is empty text (only the end token). Repeated rows are counted and scored
each; extra columns are ignored; with no training text every probability comes from
the unknown place; an empty table gives no rows.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, words_of, written
from ledgerlake.llm.ef import EliasFano
from ledgerlake.llm.token_counts import _arrow

BLOCK_TOKENS, DISCOUNT = 2_000_000, 0.75
ALPHA = 0.1
#: Quantisation: codes of -log10(p) in steps of 1 / SCALE; 0 is "absent".
SCALE, ABSENT = 4096.0, 0
PART = 1 << 20
#: Training tokens a trie's shard is meant for, and of a context beyond which it is split.
TRIE_TOKENS, WORD_SPLIT = 2_000_000, 4_000_000


def deflate(a: np.ndarray) -> bytes:
    """Integers as byte planes of the least width that holds them, compressed."""
    a = np.ascontiguousarray(a)
    width = 1
    while width < 8 and len(a) and int(a.max()) >= 1 << 8 * width:
        width *= 2
    planes = a.astype(a.dtype.newbyteorder("<"), copy=False).view(np.uint8).reshape(-1, a.itemsize)
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(b"".join(planes[:, k].tobytes() if k < a.itemsize else bytes(len(a)) for k in range(width)))


def inflate(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), dtype=np.uint8)
    planes = planes.reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    for k, plane in enumerate(planes):
        out[:, k] = plane
    return out.view("<i8").ravel()


class Numbers(dict):
    """Numbers words by first appearance."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def tokenised(docs: DataFrame, shards: int, block_tokens: int) -> DataFrame:
    """Blocks of documents (tokens by block-local numbers) and, per block and shard, the
    sorted hashes of its distinct words with their training counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("block", pa.string()), ("shard", pa.int32()), ("doc_ids", pa.list_(_arrow(docs, "doc_id"))), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())),
                        ("tokens", pa.binary()), ("order", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])

    def close(name, ids, held, parts, numbers):
        lengths = np.array([len(p) for p in parts])
        tokens = np.concatenate(parts)
        often = np.argsort(-np.bincount(tokens), kind="stable")  # frequent words get the least numbers, which take fewest bytes
        number = np.empty(len(often), dtype=np.int64)
        number[often] = np.arange(len(often))
        tokens = number[tokens]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), dtype=np.uint64, count=len(numbers))[often]
        shard = (hashes % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((hashes, shard))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        counts = np.bincount(tokens[np.repeat(~np.array(held), lengths)], minlength=len(numbers))
        yield name, None, ids, held, lengths.tolist(), deflate(tokens), deflate(place), None, None
        edge = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(edge)):
            own = order[edge[s]:edge[s + 1]]
            yield name, int(s), None, None, None, None, None, hashes[own].tobytes(), deflate(counts[own])

    def run(frames):
        def rows():
            task = TaskContext.get().partitionId()
            n, size = 0, 0
            ids, held, parts, numbers = [], [], [], Numbers()
            for b in frames:
                for d, h, t in zip(b.column("doc_id").to_pylist(), b.column("held").to_pylist(), b.column("text").to_pylist(), strict=True):
                    words = words_of(t, lower=True)
                    words.append(b"")  # the end token: no word is empty
                    ids.append(d)
                    held.append(h)
                    parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
                    size += len(words)
                    if size >= block_tokens:
                        yield from close(f"{task}-{n}", ids, held, parts, numbers)
                        n, size = n + 1, 0
                        ids, held, parts, numbers = [], [], [], Numbers()
            if ids:
                yield from close(f"{task}-{n}", ids, held, parts, numbers)

        yield from batches(rows(), schema, size=64)

    return docs.mapInArrow(run, f"block string, shard int, doc_ids array<{kind}>, held array<boolean>, lengths array<long>, tokens binary, order binary, keys binary, counts binary")


def word_level(asked: DataFrame, shards: int) -> DataFrame:
    """Per block and shard, ranks in the shard (0: unknown) and training counts of the asked words; and one
    row per shard (null block) with its words and training tokens."""

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        keys = [np.frombuffer(k, dtype=np.uint64) for k in pdf["keys"]]
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([inflate(c) for c in pdf["counts"]]), minlength=len(distinct)).astype(np.int64)
        known = total > 0
        rank = np.empty(len(total), dtype=np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(1, len(total) + 1)
        rank[~known] = 0
        out, at = [(None, shard, None, None, int(known.sum()), int(total.sum()))], 0
        for block, k in zip(pdf["block"], keys, strict=True):
            own = back[at:at + len(k)]
            out.append((block, shard, deflate(rank[own]), deflate(total[own]), None, None))
            at += len(k)
        return pd.DataFrame(out, columns=["block", "shard", "ranks", "totals", "n_words", "n_tokens"]).astype({"n_words": "Int64", "n_tokens": "Int64"})

    return asked.groupBy("shard").applyInPandas(merge, "block string, shard int, ranks binary, totals binary, n_words long, n_tokens long")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


class Block:
    """A block's documents with the word level's answers: its distinct n-grams of known contexts, level
    by level, and the nodes of the shards' tries it asks for.

    An n-gram lies in the shard of its first word, unless a context on its way may be frequent: one whose
    rarest word has over ``split`` training tokens has that many more pieces, by its successor, each in a
    shard of its own. A block asks every piece of its contexts."""

    def __init__(self, rows: pd.DataFrame, answers: pd.DataFrame, order: int, shards: int, split: int, word_shards: int):
        row = rows.iloc[0]
        answers = answers.sort_values("shard")
        self.ids, self.held, self.lengths = list(row["doc_ids"]), np.asarray(row["held"], dtype=bool), np.asarray(row["lengths"], dtype=np.int64)
        place = inflate(row["order"])
        ranks = [inflate(b) for b in answers["ranks"]]
        ids = np.concatenate([np.where(r > 0, r * word_shards + s, 0) for r, s in zip(ranks, answers["shard"], strict=True)])[place]
        self.total = np.concatenate([inflate(b) for b in answers["totals"]])[place]
        self.tokens = inflate(row["tokens"])
        self.first = np.cumsum(self.lengths) - self.lengths
        self.id, number = np.unique(np.append(0, ids), return_inverse=True)  # the block's words by their ids; 0: all unknown ones
        number = number[1:]
        self.count = np.zeros(len(self.id), dtype=np.int64)
        self.count[number] = self.total
        self.count[0] = 0
        # every text follows order - 1 end tokens
        texts = np.arange(len(self.lengths))
        self.real = np.arange(len(self.tokens)) + np.repeat((texts + 1) * (order - 1), self.lengths)
        self.word = np.full(len(self.tokens) + len(texts) * (order - 1), number[self.tokens[-1]], dtype=np.int32)
        self.word[self.real] = number[self.tokens]
        self._grams(order)
        self._nodes(shards, split)

    def _grams(self, order: int):
        """Per level: place of each token's n-gram among the distinct ones (-1: none), and of these, in
        order of their ids, the context's place, the last word and the training count."""
        width = len(self.id)
        train = np.zeros(len(self.word), dtype=bool)
        train[self.real] = np.repeat(~self.held, self.lengths)
        inside = np.arange(len(self.word)) - np.repeat(self.first + np.arange(len(self.lengths)) * (order - 1), self.lengths + order - 1)
        self.gram, self.context, self.last, self.seen = [self.word], [None], [np.arange(width)], [self.count]
        for k in range(1, order):
            at = np.flatnonzero(inside >= k)
            at = at[(self.gram[-1][at - 1] >= 0) & (self.word[at - 1] > 0)]
            code = self.gram[-1][at - 1].astype(np.int64) * width + self.word[at]
            distinct, back = np.unique(code, return_inverse=True)
            gram = np.full(len(self.word), -1, dtype=np.int32)
            gram[at] = back
            self.gram.append(gram)
            self.context.append(distinct // width)
            self.last.append(distinct % width)
            self.seen.append(np.bincount(back[train[at]], minlength=len(distinct)))

    def _nodes(self, shards: int, split: int):
        """Per level, sorted, the asked nodes as shard * n-grams + n-gram, and each one's place among the contexts asked."""
        order = len(self.gram)
        key, rarest = [mix(self.id.astype(np.uint64))], [self.count]
        for k in range(1, order):
            up, last = self.context[k], self.last[k]
            own, pieces = key[-1][up], 1 + rarest[-1][up] // split
            hot = np.flatnonzero(pieces > 1)
            own[hot] = mix(own[hot] + (1 + self.id[last[hot]] % pieces[hot]).astype(np.uint64))
            key.append(own)
            rarest.append(np.minimum(rarest[-1][up], self.count[last]))
        self.shard = [(k % np.uint64(shards)).astype(np.int64) for k in key]
        self.nodes, self.parent = [None] * order, [None] * order
        shard, gram = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)  # of the level below
        for k in reversed(range(order)):
            n = len(self.last[k])
            own = np.argsort(self.shard[k].astype(np.uint16 if shards <= 1 << 16 else np.int64), kind="stable")
            own = own[own > 0] if not k else own  # words: all but the unknown
            nodes = self.shard[k][own] * n + own
            up = self.context[k + 1][gram] if k < order - 1 else gram
            away = np.flatnonzero(self.shard[k][up] != shard)  # below a frequent context
            more = [shard[away] * n + up[away]]
            if k < order - 1:
                pieces = 1 + rarest[k] // split
                hot = np.flatnonzero(pieces > 1)
                each = np.repeat(hot, pieces[hot])
                piece = np.arange(len(each)) - np.repeat(np.cumsum(pieces[hot]) - pieces[hot], pieces[hot])
                home = (mix(key[k][each] + (1 + piece).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
                more.append((home * n + each)[home != self.shard[k][each]])
            more = np.unique(np.concatenate(more))
            self.nodes[k] = np.sort(np.concatenate([nodes, more]), kind="stable") if len(more) else nodes
            if k < order - 1:
                place = np.zeros(n, dtype=np.int64)
                place[own] = np.arange(len(own)) + (np.searchsorted(more, nodes) if len(more) else 0)
                self.parent[k + 1] = place[up]
                self.parent[k + 1][away] = np.searchsorted(self.nodes[k], shard[away] * n + up[away])
            shard, gram = np.divmod(self.nodes[k], n)

    def shared(self, k: int) -> np.ndarray:
        """Whether the n-gram of a node of level ``k`` has nodes in other shards too."""
        gram = self.nodes[k] % len(self.last[k])
        return np.bincount(gram, minlength=len(self.last[k]))[gram] > 1

    def asks(self, shards: int):
        """Per shard and level, words, training counts and children of the asked nodes, and the places of shared ones."""
        levels, edges = [], []
        for k, nodes in enumerate(self.nodes):
            shard, gram = np.divmod(nodes, len(self.last[k]))
            counts = np.where(self.shard[k][gram] == shard, self.seen[k][gram], 0) if k else self.count[gram]
            inner = k < len(self.nodes) - 1
            levels.append((self.id[self.last[k][gram]], counts, np.bincount(self.parent[k + 1], minlength=len(nodes)) if inner else None, self.shared(k) if inner else None))
            edges.append(np.searchsorted(shard, np.arange(shards + 1)))
        for s in np.flatnonzero(np.diff(edges[0])):
            own = [[None if a is None else a[e[s]:e[s + 1]] for a in level] for level, e in zip(levels, edges, strict=True)]
            own[0][0] = np.diff(own[0][0], prepend=0)  # the words are in order
            yield (int(s), [deflate(o[0]) for o in own], [deflate(o[1]) for o in own], [deflate(o[2]) for o in own[:-1]], [deflate(np.flatnonzero(o[3])) for o in own[:-1]])

    def probabilities(self, levels: pd.DataFrame, unknown: float) -> np.ndarray:
        """The model's probability of every token, from the shards' answers."""
        levels = levels.sort_values("shard")
        get = lambda column, k: np.concatenate([np.empty(0, dtype=np.int64), *(inflate(b[k]) for b in levels[column])])
        n = len(self.id)
        p = np.full(n, restore(quantise(np.array([unknown])))[0])
        p[self.nodes[0] % n] = restore(get("share", 0))
        p = p[self.word[self.real]]
        for k in range(1, len(self.nodes)):
            shared, n = self.shared(k - 1), len(self.last[k - 1])
            context, weight, rest = self.nodes[k - 1] % n, np.ones(len(shared)), restore(get("rest", k - 1))
            total = get("total", k - 1).astype(float)
            whole = np.bincount(context[shared], weights=total, minlength=n)
            weight[shared] = total / np.maximum(whole[context[shared]], 1)
            rest = np.bincount(context, weights=weight * rest, minlength=n)
            m = len(self.last[k])
            shard, gram = np.divmod(self.nodes[k], m)
            own = np.flatnonzero(self.shard[k][gram] == shard)
            share = np.zeros(m)
            share[gram[own]] = restore(get("share", k)[own]) * weight[self.parent[k][own]]
            at = np.flatnonzero(self.gram[k][self.real] >= 0)
            gram = self.gram[k][self.real[at]]
            rest = rest[self.context[k]][gram]
            at, gram, rest = at[rest > 0], gram[rest > 0], rest[rest > 0]  # other contexts have no successor in training
            p[at] = share[gram] + rest * p[at]
        return p


def ask_grams(blocks: DataFrame, answers: DataFrame, order: int, shards: int, split: int, word_shards: int) -> DataFrame:
    """Per block and shard: the nodes of the shard's trie that the block asks for, level by level."""

    def ask(key, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        out = [(key[0], *a) for a in Block(rows, got, order, shards, split, word_shards).asks(shards)]
        return pd.DataFrame(out, columns=["block", "shard", "words", "counts", "times", "shared"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        ask, "block string, shard int, words array<binary>, counts array<binary>, times array<binary>, shared array<binary>")


def runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the runs of equal neighbours and, per element, its run."""
    new = np.append(True, a[1:] != a[:-1])[:len(a)]
    return a[new], np.cumsum(new) - 1


def mapped(path: str, arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays, written to one file and mapped."""
    with open(path, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data if len(a) else b"")
        f.write(b"\0")
    flat, at, out = np.memmap(path, dtype=np.uint8, mode="r"), 0, []
    for a in arrays:
        out.append(flat[at:at + a.nbytes].view(a.dtype))
        at += a.nbytes
    return out


class Trie:
    """The n-grams of one shard. Per level, in a file that is mapped: pointers from the nodes above to
    their ranges, the successors of these, each shifted by the base of its node, and quantised
    logarithms of the nodes' shares and of the rests of those above."""

    def __init__(self, folder: str, asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]], discount: float, unigram):
        """``asked``: per level, sorted and distinct, places of the nodes above, words and training counts."""
        keep = [c > 0 for _, _, c in asked]
        for k in range(len(asked) - 1, 0, -1):  # ways to a seen node are kept
            keep[k - 1] = keep[k - 1] | (np.bincount(asked[k][0][keep[k]], minlength=len(keep[k - 1])) > 0)
        self.span = max(int(w.max()) + 1 if len(w) else 1 for _, w, _ in asked)
        self.successors, self.pointers, self.share, self.rest, self.total = [], [], [], [], []
        nodes = 1  # the root
        for k, (up, word, count) in enumerate(asked):
            place = np.cumsum(keep[k - 1]) - 1 if k else np.zeros(1, dtype=np.int64)
            up, word, count = place[up[keep[k]]], word[keep[k]], count[keep[k]]
            total, types = np.bincount(up, weights=count, minlength=nodes), np.bincount(up[count > 0], minlength=nodes)
            with np.errstate(divide="ignore", invalid="ignore"):
                share = quantise(unigram(count) if not k else (count - discount) / total[up])
                rest = np.where(total > 0, quantise(np.nan_to_num(discount * types / total)), ABSENT).astype(np.uint16)
            share[count == 0] = ABSENT
            self._level(f"{folder}/{k + 1}", EliasFano.encode(np.searchsorted(up, np.arange(nodes + 1))), EliasFano.encode(up * self.span + word), share, rest, total)
            nodes = len(word)

    def _level(self, path: str, pointers: EliasFano, successors: EliasFano, share: np.ndarray, rest: np.ndarray, total: np.ndarray):
        flat = [np.frombuffer(b, dtype=np.uint8) for e in (pointers, successors) for b in e.buffers()]
        a, b, c, d, share, rest, total = mapped(path, [*flat, share, rest, total])
        self.pointers.append(EliasFano(pointers.n, pointers.low_bits, a, b))
        self.successors.append(EliasFano(successors.n, successors.low_bits, c, d))
        self.share.append(share)
        self.rest.append(rest)
        self.total.append(total)

    def find(self, k: int, up: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places in level ``k`` of words below the nodes at places ``up`` of the level above (-1: none)."""
        out = np.full(len(up), -1, dtype=np.int64)
        if not self.successors[k].n:
            return out
        for a in range(0, len(up), PART):
            own = np.flatnonzero(up[a:a + PART] >= 0) + a
            key = up[own] * self.span + word[own]
            at = self.successors[k].successor(key)
            above, back = runs(up[own])
            inside = at < self.pointers[k].access(above + 1)[back]
            own, key, at = own[inside], key[inside], at[inside]
            hit = self.successors[k].access(at) == key
            out[own[hit]] = at[hit]
        return out


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes 1 .. 65535 of probabilities; steps of 10 ** (-1 / SCALE)."""
    return (np.rint(-np.log10(np.maximum(p, 1e-15)) * SCALE) + 1).clip(1, 65535).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    return np.where(code == ABSENT, 0.0, 10.0 ** (-(code - 1.0) / SCALE))


def successor_level(asked: DataFrame, order: int, discount: float, n_words: int, n_tokens: int) -> DataFrame:
    """Per block and shard, level by level: codes of the asked nodes' shares and rests, and the training
    tokens below shared ones."""

    def taken(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, values[at.clip(0)], 0) if len(values) else np.zeros(len(at), dtype=np.int64)

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        levels, backs, sizes = [], [], []
        for k in range(order):
            words = [inflate(w[k]) for w in pdf["words"]]
            sizes.append(np.cumsum([0, *map(len, words)]))
            words = np.concatenate(words if k else list(map(np.cumsum, words)))
            counts = np.concatenate([inflate(c[k]) for c in pdf["counts"]])
            span = int(words.max()) + 1 if len(words) else 1
            code = np.repeat(backs[-1].astype(np.int64), np.concatenate([inflate(t[k - 1]) for t in pdf["times"]])) * span + words if k else words
            distinct, back = np.unique(code, return_inverse=True)
            if k:
                count = np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)
            else:  # every block knows the words' counts
                count = np.zeros(len(distinct), dtype=np.int64)
                count[back] = counts
            levels.append((distinct // span if k else np.zeros(len(distinct), dtype=np.int64), distinct % span, count))
            backs.append(back.astype(np.int32))
            del words, counts, code
        with tempfile.TemporaryDirectory(prefix="lm-trie-") as folder:
            trie = Trie(folder, levels, discount, lambda c: (c + ALPHA) / (n_tokens + ALPHA * (n_words + 1)))
            share, rest, total, at = [], [], [], np.zeros(1, dtype=np.int64)
            for k, (up, word, _) in enumerate(levels):
                at = trie.find(k, at[up], word)
                share.append(taken(trie.share[k], at))
                if k < order - 1:
                    rest.append(taken(trie.rest[k + 1], at))
                    total.append(taken(trie.total[k + 1], at).astype(np.int64))
        out = []
        for i, (block, shared) in enumerate(zip(pdf["block"], pdf["shared"], strict=True)):
            own = [back[size[i]:size[i + 1]] for back, size in zip(backs, sizes, strict=True)]
            out.append((block, int(key[0]), [deflate(a[b]) for a, b in zip(share, own, strict=True)], [deflate(a[b]) for a, b in zip(rest, own, strict=False)],
                        [deflate(a[b[inflate(s)]]) for a, b, s in zip(total, own, shared, strict=False)]))
        return pd.DataFrame(out, columns=["block", "shard", "share", "rest", "total"])

    return asked.groupBy("shard").applyInPandas(merge, "block string, shard int, share array<binary>, rest array<binary>, total array<binary>")


def score(docs: DataFrame, held_out, block_tokens: int = BLOCK_TOKENS, discount: float = DISCOUNT, shards: int | None = None, order: int = 2, word_split: int = WORD_SPLIT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of
    ``docs``; rows where the condition ``held_out`` is true are not learned from."""
    if order < 1:
        raise ValueError("order must be at least 1")
    shards = shards or max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = written(tokenised(docs.select("doc_id", held_out.alias("held"), "text"), shards, block_tokens), "lm-blocks")
    blocks = rows.filter("shard is null").select("block", "doc_ids", "held", "lengths", "tokens", "order")
    asked = rows.filter("shard is not null").select("block", "shard", "keys", "counts")
    words = written(word_level(asked, shards), "lm-words")
    stats = words.filter("block is null").agg(F.sum("n_words"), F.sum("n_tokens")).first()
    n_words, n_tokens = int(stats[0] or 0), int(stats[1] or 0)
    tries = max(shards, -(-n_tokens // TRIE_TOKENS))
    answers = words.filter("block is not null").select("block", "shard", "ranks", "totals")
    levels = successor_level(ask_grams(blocks, answers, order, tries, word_split, shards), order, discount, n_words, n_tokens)
    both = answers.unionByName(levels, allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def finish(key, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, got[got["ranks"].notna()], order, tries, word_split, shards)
        weight = n_tokens + ALPHA * (n_words + 1)
        base = np.log10((block.total + ALPHA) / weight)[block.tokens]
        result = np.log10(block.probabilities(got[got["share"].notna()], ALPHA / weight))
        total = lambda x: np.add.reduceat(x, block.first)
        return pd.DataFrame({"doc_id": pd.Series(block.ids, dtype=object), "held_out": block.held, "n_tokens": block.lengths, "n_known": total((block.total > 0)[block.tokens].astype(np.int64)),
                             "train_tokens": n_tokens, "base_score": total(base), "score": total(result)})

    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
