"""Byte-level BPE on the workers: pre-tokenisation at synchronising points, exact
ids through the tokenizer library, and a lazily compiled counting transducer.

A *synchronising point* of the pre-tokenizer is a space followed by a character
that is not white space: a new piece starts there whatever comes before. Texts
are cut at these points, so each block can be looked up in a bounded memo.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

#: Fixed value: the pre-tokenisation pattern of the public vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = regex.compile(PATTERN)
#: The usual block: one run of ASCII letters, perhaps with its space and an ASCII tail without letters, digits, quotes or space.
PLAIN = re.compile(r"( ?[A-Za-z]+)([!-&(-/:-@\[-`{-~]*)\Z")
#: A superset of the places where a space is not a synchronising point.
UNSAFE_SPACE = re.compile(r" [\s\x1c-\x1f\x85\xa0]| \Z")
SYNC = regex.compile(r" (?=\S)")
MEMO_ENTRIES = 300_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def blocks(text: str) -> list[str]:
    """Cut a text at its synchronising points; each block but the first begins with its space."""
    if UNSAFE_SPACE.search(text) is None:
        first, *rest = text.split(" ")
    else:
        first, *rest = SYNC.split(text)
    out = [" " + b for b in rest]
    if first:
        out.insert(0, first)
    return out


class Memo(dict):
    """Block -> value; emptied when full (a cache: values never depend on it)."""

    def __init__(self, compute, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def pieces(block: str) -> list[str]:
    """Pre-tokenizer pieces of a block."""
    m = PLAIN.match(block)
    return [p for p in m.groups() if p] if m else PIECES.findall(block)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in keep}
    for n, b in enumerate(b for b in range(256) if b not in set(keep)):
        out[chr(256 + n)] = b
    return out


def plain_byte_level(spec: dict, path: str) -> None:
    if spec.get("normalizer") or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        raise ValueError(f"not a plain byte-level BPE file: {path}")


def vocabulary(spec: dict) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """Token bytes -> id, and the merges in order."""
    alpha = byte_alphabet()
    decode = lambda s: bytes(alpha[c] for c in s)
    ids = {decode(t): k for t, k in spec["model"]["vocab"].items() if all(c in alpha for c in t)}
    merges = [tuple(map(decode, m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
    return ids, merges


class Specials:
    """Special strings inside a text, which the library's default matches first."""

    def __init__(self, spec: dict):
        added = [t for t in spec.get("added_tokens", []) if t["content"]]
        self.ids = {t["content"]: t["id"] for t in added}
        self.pattern = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.ids, key=len, reverse=True)) + ")") if added else None

    def split(self, text: str) -> list[str]:
        if self.pattern is None or not any(s in text for s in self.ids):
            return [text]
        return self.pattern.split(text)


class Encoder:
    """Exact ids of whole texts: memoised blocks; misses go to the ranked-merge
    library where ids rise with the merges (then both libraries agree), else to
    the library of the file itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain_byte_level(spec, path)
        self.specials = Specials(spec)
        vocab, merges = vocabulary(spec)
        ids = [vocab[a + b] for a, b in merges]
        if ids == sorted(ids) and min(ids) > max(v for k, v in vocab.items() if len(k) == 1):
            import tiktoken
            self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={}).encode_ordinary
        else:
            tokenizer = Tokenizer.from_file(path)
            self.encode = lambda block: tokenizer.encode(block, add_special_tokens=False).ids
        self.memo = Memo(self._block)

    def _block(self, block: str) -> bytes:
        return array("I", self.encode(block)).tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        look = self.memo.__getitem__
        out = []
        for part in self.specials.split(text):
            special = self.specials.ids.get(part)
            if special is None:
                out.extend(map(look, blocks(part)))
            else:
                out.append(array("I", (special,)).tobytes())
        return b"".join(out)


class CountTransducer:
    """BPE compiled to a deterministic finite-state transducer over bytes.

    The states are the suffixes that may still grow into a token (rows are compiled
    when first met). A transition lists the tokens that may end with its byte,
    longest first. A token sequence is the BPE encoding of its text exactly if each
    adjacent pair is the encoding of its own text, so exactly one listed token pairs
    with the last token of the place where it starts; the transition emits that
    place's count plus one. Many pieces run through the rows in lockstep.

    Pairs are judged by walking back in merge order: a merge over the border would
    have come first if it ranks below the next merge of its left part and not above
    that of its right part.
    """

    NONE = (1 << 17) - 1
    CACHE = 1 << 20
    FAR = 1 << 30

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain_byte_level(spec, path)
        self.specials = Specials(spec)
        self.ids, merges = vocabulary(spec)
        size = max(self.ids.values()) + 1
        self.length = np.zeros(size, dtype=np.int32)
        for t, k in self.ids.items():
            self.length[k] = len(t)
        self.left, self.right = np.full(size, -1, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        self.rank = np.full(size, -1, dtype=np.int32)
        keys = np.empty(len(merges), dtype=np.int64)
        made = np.empty(len(merges), dtype=np.int32)
        for k, (x, y) in enumerate(merges):
            m, i, j = self.ids[x + y], self.ids[x], self.ids[y]
            keys[k], made[k] = i << 17 | j, k
            if self.rank[m] < 0:
                self.rank[m], self.left[m], self.right[m] = k, i, j
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[order], made[order]
        whole = self.judge(self.left.clip(0), self.right.clip(0), self.FAR, inside=True)
        self.alone = (self.rank < 0) | whole
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.cache_key = np.full(self.CACHE, -1, dtype=np.int64)
        self.cache_ok = np.zeros(self.CACHE, dtype=bool)
        self.nodes: dict[bytes, int] = {b"": 0}
        self.names = [b""]
        self.edge = np.full((1024, 256), -1, dtype=np.int32)
        self.edges = 0
        self.target = np.zeros(1024, dtype=np.int32)
        self.ends = np.full((1024, 8), -1, dtype=np.int32)
        self.memo: dict[str, int] = {}

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, or FAR."""
        key = a.astype(np.int64) << 17 | b
        at = np.searchsorted(self.pair_keys, key).clip(max=len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], self.FAR)

    def judge(self, a: np.ndarray, b: np.ndarray, far: int, inside: bool = False) -> np.ndarray:
        """Whether no merge over the border of ``a`` and ``b`` comes before theirs.
        ``inside``: the two are the halves of one token, whose own merge is allowed."""
        a, b = a.copy(), b.copy()
        limit_a, limit_b = np.full(len(a), far), np.full(len(a), far)
        ok = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        first = inside
        while len(todo):
            x, y = a[todo], b[todo]
            if not first:
                c = self.cross(x, y)
                ok[todo[(c < limit_a[todo]) & (c <= limit_b[todo]) & (c < far)]] = False
            first = False
            rx, ry = self.rank[x], self.rank[y]
            more = ok[todo] & ((rx >= 0) | (ry >= 0))
            todo, x, y, rx, ry = todo[more], x[more], y[more], rx[more], ry[more]
            back = rx > ry  # the part made last is undone first; of two equal ones the right
            limit_a[todo[back]], a[todo[back]] = rx[back], self.right[x[back]]
            limit_b[todo[~back]], b[todo[~back]] = ry[~back], self.left[y[~back]]
        return ok

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token ``b`` may follow ``a`` (NONE: begin a piece); verdicts are cached."""
        key = a.astype(np.int64) << 17 | b
        slot = (key ^ (key >> 17) * 40503) & self.CACHE - 1
        miss = np.flatnonzero(self.cache_key[slot] != key)
        out = self.cache_ok[slot]
        if len(miss):
            some, back = np.unique(key[miss], return_inverse=True)
            x, y = some >> 17, some & self.NONE
            ok = self.alone[y].copy()
            later = np.flatnonzero(x != self.NONE)
            ok[later] &= self.judge(x[later].astype(np.int32), y[later].astype(np.int32), self.FAR)
            got = ok[back]
            out[miss] = got
            self.cache_key[slot[miss]], self.cache_ok[slot[miss]] = key[miss], got
            # Two keys may share a slot: keep slots whose verdict belongs to their key.
            lost = self.cache_key[slot[miss]] != key[miss]
            self.cache_key[slot[miss][lost]] = -1
        return out

    def compile(self, node: int, byte: int) -> None:
        """Add the transition of a state on a byte."""
        grown = self.names[node] + bytes((byte,))
        ends = [self.ids[grown[k:]] for k in range(len(grown)) if grown[k:] in self.ids]
        cut = 0
        while cut < len(grown) and grown[cut:] not in self.prefixes:
            cut += 1
        to = self.nodes.setdefault(grown[cut:], len(self.nodes))
        if to == len(self.names):
            self.names.append(grown[cut:])
            if to == len(self.edge):
                self.edge = np.concatenate([self.edge, np.full_like(self.edge, -1)])
        if self.edges == len(self.target):
            self.target = np.concatenate([self.target, np.zeros_like(self.target)])
            self.ends = np.concatenate([self.ends, np.full_like(self.ends, -1)])
        if len(ends) > self.ends.shape[1]:
            self.ends = np.pad(self.ends, ((0, 0), (0, len(ends) - self.ends.shape[1])), constant_values=-1)
        self.edge[node, byte] = self.edges
        self.target[self.edges], self.ends[self.edges, :len(ends)] = to, ends
        self.edges += 1

    def run(self, some: list[bytes]) -> np.ndarray:
        """Emitted-token counts of pieces, all in lockstep."""
        lengths = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
        order = np.argsort(-lengths, kind="stable")
        text = np.frombuffer(b"".join(some), dtype=np.uint8)
        start = (np.cumsum(lengths) - lengths)[order]
        most = int(lengths.max(initial=0))
        window = int(self.length.max()) + 1  # places older than the longest token are overwritten
        depth = min(window, most + 1)
        node = np.zeros(len(some), dtype=np.int32)
        last = np.full((depth, len(some)), self.NONE, dtype=np.int32)
        count = np.zeros((depth, len(some)), dtype=np.int64)
        out = np.zeros(len(some), dtype=np.int64)
        live = np.searchsorted(-lengths[order], -np.arange(most), side="left")
        for i, n in enumerate(live):
            byte = text[start[:n] + i]
            e = self.edge[node[:n], byte]
            if (new := e < 0).any():
                for pair in np.unique(node[:n][new].astype(np.int64) << 8 | byte[new]).tolist():
                    self.compile(pair >> 8, pair & 255)
                e = self.edge[node[:n], byte]
            ends = self.ends
            here, undecided = (i + 1) % depth, np.arange(n)
            for k in range(ends.shape[1]):
                token = ends[e[undecided], k]
                place = (i + 1 - self.length[token]) % depth
                prior = last[place, undecided]
                ok = (token >= 0) & self.follows(prior, token.clip(0))
                hit = undecided[ok]
                count[here, hit] = count[place[ok], hit] + 1
                last[here, hit] = token[ok]
                undecided = undecided[~ok]
                if not len(undecided):
                    break
            if len(undecided):
                raise AssertionError("no token ends here")
            node[:n] = self.target[e]
            done = live[i + 1] if i + 1 < most else 0
            out[order[done:n]] = count[here, done:n]
        return out

    def learn(self, some: set[str]) -> None:
        """Put the counts of blocks into the memo."""
        names = list(some)
        cut = [pieces(b) for b in names]
        distinct = list({p for ps in cut for p in ps})
        known: dict[str, int] = {}
        for k in range(0, len(distinct), 4096):
            part = distinct[k:k + 4096]
            known |= zip(part, self.run([p.encode("utf-8", "surrogatepass") for p in part]).tolist(), strict=True)
        self.memo |= zip(names, (sum(map(known.__getitem__, ps)) for ps in cut), strict=True)

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of stretches that start and end at synchronising points."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = {}
        split = [[x for part in self.specials.split(t) if part not in self.specials.ids for x in blocks(part)] for t in texts]
        marks = [sum(part in self.specials.ids for part in self.specials.split(t)) for t in texts]
        self.learn(set().union(*split) - self.memo.keys())
        look = self.memo.__getitem__
        return [n + sum(map(look, bs)) for n, bs in zip(marks, split, strict=True)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def transducer(path: str) -> CountTransducer:
    return CountTransducer(path)
