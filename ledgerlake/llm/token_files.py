"""Token ids in binary files: a concatenated id array per file, Elias-Fano document ends.

A file is one block: whole documents in ascending id order, ``block_ids`` tokens or a
little more (a longer document has a file of its own). Layout (little-endian, but for the
two numbers that are put in last)::

    EFTOKEN1 | start: u64 big-endian | first document: u64 big-endian |
    width u8, low bits of ends u8, of ids u8, 0 | documents u32 | without id u32 | base id i64 | tokens u64 |
    lengths of the seven sections u64 each | ends: low, high, samples | ids: low, high, samples | tokens | newline

``start`` counts the tokens of all files before it. Tokens have 2 bytes where the vocabulary
allows it. Ends are the monotone sums of token counts: ``low`` holds their low bits packed, ``high`` the
rest in unary, ``samples`` the ones before every 512th bit as u32. ``select`` finds the
i-th one from a sample and at most 64 bytes, so an offset costs no table of 64-bit numbers:
about 2.3 bits a document beside the low bits. Document ids are a second such sequence above ``base``.

Text is sorted by range, tokenised and made into blocks in one pass; blocks are a table until the
tasks' token counts are known (one row per task), then every block is written by Spark's
own sink (commit protocol, any file system, one file per row) and read by its binary source.

Null text is empty (only the end id). Rows without an id come first. Rows with equal ids
are each kept, ordered by their text's hash; extra columns are ignored; an empty table gives no files
and reads as no rows. Ids must be integers, and a file's ids must span less than 2**63.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, slices, tasks_for, written
from ledgerlake.llm.ef import _POP, _SELECT
from ledgerlake.session import scratch_path

MAGIC, HEAD, LENGTHS = b"EFTOKEN1", struct.Struct("<BBBxIIqQ"), struct.Struct("<7Q")
BLOCK, SUPER, END = 1 << 21, 64, 2
#: Pieces of text whose ids a worker remembers; the memo starts anew when it is full.
MEMO = 300_000


class Monotone:
    """A non-decreasing sequence of numbers from 0, in three flat byte sections."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> Monotone:
        v = np.asarray(values, dtype=np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        bits = min(56, max(0, ((top + 1) // max(n, 1)).bit_length() - 1))
        plain = (v[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        low = np.concatenate([np.packbits(plain.ravel(), bitorder="little"), np.zeros(8, np.uint8)])
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = SUPER * (int(at[-1]) // (8 * SUPER) + 1 if n else 1)
        high = np.zeros(size, np.uint8)
        np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
        ones = _POP[high.reshape(-1, SUPER)].sum(axis=1, dtype=np.uint32)
        return cls(n, bits, low, high, np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4"))

    def sections(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]

    @classmethod
    def read(cls, n: int, bits: int, low: memoryview, high: memoryview, samples: memoryview) -> Monotone:
        return cls(n, bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4"))

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``: a sample, 64 bytes of ones, the low bits."""
        i = np.asarray(i, dtype=np.int64)
        if len(i) > 1 << 14:
            return np.concatenate([self.select(i[k:k + (1 << 14)]) for k in range(0, len(i), 1 << 14)])
        if not len(i):
            return i
        block = np.searchsorted(self.samples, i, side="right") - 1
        rest = i - self.samples[block]
        content = self.high.reshape(-1, SUPER)[block]
        ones = np.cumsum(_POP[content], axis=1, dtype=np.int64)
        byte = (ones <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(i))
        rest -= np.where(byte > 0, ones[rows, byte - 1], 0)
        place = 8 * (SUPER * block + byte) + _SELECT[content[rows, byte], rest]
        return (place - i) << self.bits | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        bit = i * self.bits
        words = np.ndarray((len(self.low) - 7,), dtype="<u8", buffer=self.low, strides=(1,))
        return (words[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.bits) - 1)).astype(np.int64)


class Block:
    """A file's bytes; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.start, self.first_doc = struct.unpack(">QQ", view[8:24])
        self.width, ends, ids, self.n_docs, self.n_null, self.base, self.n_ids = HEAD.unpack_from(view, 24)
        at = 24 + HEAD.size
        lengths = LENGTHS.unpack_from(view, at)
        at += LENGTHS.size
        cuts = [at, *(at + np.cumsum(lengths)).tolist()]
        parts = [view[a:z] for a, z in zip(cuts, cuts[1:], strict=False)]
        self.ends = Monotone.read(self.n_docs, ends, *parts[:3])
        self.doc_ids = Monotone.read(self.n_docs - self.n_null, ids, *parts[3:6])
        self.tokens = np.frombuffer(parts[6], f"<u{self.width}")

    def bounds(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the tokens of documents ``i`` begin and end in this file."""
        i = np.asarray(i, dtype=np.int64)
        return np.where(i > 0, self.ends.select(np.maximum(i - 1, 0)), 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        (a,), (z,) = self.bounds(np.array([i]))
        return self.tokens[a:z]

    def doc_id(self, i: np.ndarray) -> list[int | None]:
        i = np.asarray(i, dtype=np.int64)
        known = (self.doc_ids.select(i[i >= self.n_null] - self.n_null) + self.base).tolist()
        return [None] * int((i < self.n_null).sum()) + known

    def find(self, doc_id: int) -> int | None:
        """The first document with this id, by halving over ``select``."""
        lo, hi = 0, self.doc_ids.n
        while lo < hi:
            mid = (lo + hi) // 2
            if self.doc_ids.select(np.array([mid]))[0] + self.base < doc_id:
                lo = mid + 1
            else:
                hi = mid
        return lo + self.n_null if lo < self.doc_ids.n and self.doc_ids.select(np.array([lo]))[0] + self.base == doc_id else None


def body(doc_ids: list[int | None], counts: list[int], tokens: bytes, width: int) -> bytes:
    """A block from its documents (those without an id first): all of a file but its first 24 bytes."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    ends, ids = Monotone.encode(np.cumsum(counts)), Monotone.encode(np.array([d - base for d in known], dtype=np.uint64))
    sections = [*ends.sections(), *ids.sections(), tokens]
    head = HEAD.pack(width, ends.bits, ids.bits, len(doc_ids), len(doc_ids) - len(known), base, sum(counts))
    return b"".join([head, LENGTHS.pack(*map(len, sections)), *sections])


def _plain_classes() -> tuple[str, str]:
    """Letters and numbers among the characters that ``PLAIN`` allows, as bodies of a pattern's class."""
    of = lambda kind: "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)
    return of("L"), of("N")


#: Texts of Latin letters and signs that normalisation leaves as they are but for case; no special strings.
PLAIN = re.compile(r"(?:[\x00-;=-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]++|<(?!\|))*+\Z")
_LETTERS, _NUMBERS = _plain_classes()
#: Fixed pattern: how the tokenizer's file cuts text into pieces (over ``PLAIN`` characters).
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\x20\x09-\x0d{_LETTERS}{_NUMBERS}]+")
#: Fixed values of byte-level vocabularies: a printable byte is its own character, the others are 256 and up.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Encoder:
    """The tokenizers library, asked once per distinct piece of text.

    A plain text is cut into pieces as the tokenizer's file says, and most pieces were seen before. New
    ones are encoded many at a time by the library's model, as one spaced text whose ids fall apart again at
    the tokens that end a word. A text with other characters is taken by its chunks between ASCII white
    space, which neither normalisation nor special strings reach across: chunks that are not plain go
    to the whole library as they are. For other tokenizers (``spaced=False``) whole texts do."""

    def __init__(self, path: str, spaced: bool = True):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.library, self.model):
            t.no_truncation()
            t.no_padding()
        # The model alone: pieces come normalised, in byte characters, one per word.
        self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        size = self.library.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.spaced = spaced
        self.pieces: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        self.ends = np.zeros(size, dtype=bool)
        for token, k in self.library.get_vocab(with_added_tokens=False).items():
            self.ends[k] = token.endswith("</w>")

    def _pack(self, ids) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _ask(self, texts: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), 256):  # few of the library's result objects at a time
            out += [self._pack(e.ids) for e in self.library.encode_batch_fast(texts[k:k + 256], add_special_tokens=False)]
        return out

    def _learn(self, new: list[str]) -> None:
        for k in range(0, len(new), 2000):
            some = new[k:k + 2000]
            spaced = " ".join(p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(BYTE_CHARS) for p in some)
            ids = np.array(self.model.encode_batch_fast([spaced], add_special_tokens=False)[0].ids, dtype=f"<u{self.width}")
            raw, at = ids.tobytes(), [0, *((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()]
            self.pieces.update((p, raw[a:z]) for p, a, z in zip(some, at[:-1], at[1:], strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text (null: none)."""
        if not self.spaced:
            return self._ask([t or "" for t in texts])
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        if len(self.odd) > MEMO // 4:
            self.odd.clear()
        new: set[str] = set()
        odd: set[str] = set()
        mixed: set[int] = set()
        cut: list[list] = []  # of a plain text its pieces; of another its chunks, each a list of pieces or a string
        for t in texts:
            if not t:
                cut.append([])
            elif PLAIN.match(t):
                cut.append(PIECE.findall(t.lower()))
                new.update(cut[-1])
            else:
                cut.append([PIECE.findall(c.lower()) if PLAIN.match(c) else c for c in (x.decode() for x in t.encode().split())])
                mixed.add(len(cut) - 1)
                new.update(*[x for x in cut[-1] if isinstance(x, list)])
                odd.update(x for x in cut[-1] if isinstance(x, str))
        self._learn(list(new.difference(self.pieces)))
        strange = list(odd.difference(self.odd))
        self.odd.update(zip(strange, self._ask(strange), strict=True))
        get = self.pieces.__getitem__
        return [b"".join(b"".join(map(get, x)) if isinstance(x, list) else self.odd[x] for x in c) if k in mixed else b"".join(map(get, c)) for k, c in enumerate(cut)]


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END, block_ids: int = BLOCK, spaced: bool = True) -> None:
    """Write ``docs(doc_id, text)`` to files under ``path``, in ascending doc_id order."""
    spark, model = docs.sparkSession, tokenizer_path or default_path()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange(tasks_for(docs, 200_000), *order).sortWithinPartitions(*order)
    schema = pa.schema([("part", pa.int32()), ("rel_start", pa.int64()), ("rel_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary())])

    def run(frames):
        encoder, part = Encoder(model, spaced), TaskContext.get().partitionId()
        end = int(end_id).to_bytes(encoder.width, "little")
        ids, counts, held, size, start, first = [], [], [], 0, 0, 0

        def block():
            return pa.RecordBatch.from_pylist([{"part": part, "rel_start": start, "rel_doc": first, "n_docs": len(ids), "n_ids": size, "body": body(ids, counts, b"".join(held), encoder.width)}], schema=schema)

        for b in slices(frames, 250):
            for d, packed in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text").to_pylist()), strict=True):
                n = len(packed) // encoder.width + 1
                if ids and size + n > block_ids:
                    yield block()
                    start, first = start + size, first + len(ids)
                    ids, counts, held, size = [], [], [], 0
                ids.append(d)
                counts.append(n)
                held.append(packed + end)
                size += n
        if ids:
            yield block()

    blocks = written(dealt.mapInArrow(run, "part int, rel_start long, rel_doc long, n_docs long, n_ids long, body binary"), "token-blocks")
    # One row per task of the sort: where its blocks start among all.
    sizes = sorted((r["part"], r["d"], r["t"]) for r in blocks.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("n_ids").alias("t")).collect())
    before, n_docs, n_ids = [], 0, 0
    for part, d, t in sizes:
        before.append((part, n_docs, n_ids))
        n_docs, n_ids = n_docs + d, n_ids + t
    starts = F.broadcast(spark.createDataFrame(before, "_part int, _doc long, _start long"))
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    files = blocks.join(starts, F.col("part") == F.col("_part")).select(F.concat(F.lit(bytearray(MAGIC)), number(F.col("_start") + F.col("rel_start")), number(F.col("_doc") + F.col("rel_doc")), "body").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian
    u32) and, ``with_ids``, ids (little-endian u32): everything from the files' own structures."""
    fields = [("doc_id", pa.int64(), "long"), ("start", pa.int64(), "long"), ("n_tokens", pa.int64(), "long"), ("ids_crc32", pa.int64(), "long")] + [("ids", pa.binary(), "binary")] * with_ids
    schema = pa.schema([(n, t) for n, t, _ in fields])

    def rows(data):
        block = Block(data)
        every = np.arange(block.n_docs)
        begin, end = block.bounds(every)
        for d, a, z in zip(block.doc_id(every), begin.tolist(), end.tolist(), strict=True):
            ids = block.tokens[a:z].astype("<u4").tobytes()
            yield (d, block.start + a, z - a, zlib.crc32(ids), ids) if with_ids else (d, block.start + a, z - a, zlib.crc32(ids))

    def run(frames):
        for b in slices(frames, 1):
            yield from batches(rows(b.column("content")[0].as_py()), schema)

    kinds = ", ".join(f"{n} {k}" for n, _, k in fields)
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kinds)
    return files.mapInArrow(run, kinds)


def token_files(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the files to the shared scratch folder and read them back: the contract's columns."""
    path = scratch_path(docs.sparkSession, "llm-token-files")
    write_token_files(docs, path, tokenizer_path)
    return read_token_files(docs.sparkSession, path, with_ids=False)
