"""Token counts by a compiled finite-state tokenizer.

The vocabulary file is compiled to a transducer whose transitions emit token
counts (``bpe.CountTransducer``). Long texts are cut into chunks anywhere. The
state map of a chunk is held in converged form: after its first synchronising
point the state no longer depends on the entry state, so the map is (head before
that point, tokens counted up to the last point, tail after it). Maps compose
associatively - the seam is one tail joined to one head - and are folded pairwise,
level by level, as in a parallel prefix scan.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows and ids give one
result row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import bpe
from ledgerlake.llm.common import batches

CHUNK = 1 << 16
MAPS = "row long, part int, head string, n long, tail string, synced boolean"
SCHEMA = pa.schema([("row", pa.int64()), ("part", pa.int32()), ("head", pa.string()), ("n", pa.int64()), ("tail", pa.string()), ("synced", pa.bool_())])


def cut_points(text: str, specials: bpe.Specials) -> tuple[int, int] | None:
    """First and last synchronising points of a chunk from which no special string
    and no white-space run reaches back over the chunk's edge."""
    first = bpe.SYNC.search(text)
    if first is None:
        return None
    a = b = first.start()
    for k in range(len(text) - 2, a, -1):
        if text[k] == " " and bpe.SYNC.match(text, k):
            b = k
            break
    return (a, b) if not any(" " in s for s in specials.ids) else None


def state_map(text: str, part: int, parts: int, tr: bpe.CountTransducer) -> tuple[str, str, str, bool]:
    """Head, middle and tail of a chunk; the first chunk has no open head, the last no open tail."""
    cut = (0, len(text)) if parts == 1 else cut_points(text, tr.specials)
    if cut is None:
        return text, "", "", False
    a, b = (0 if part == 0 else cut[0]), (len(text) if part == parts - 1 else cut[1])
    return text[:a], text[a:b], text[b:], True


def compose(maps: list[tuple], count) -> tuple:
    """Fold (head, n, tail, synced) maps pairwise until one is left."""
    while len(maps) > 1:
        out = []
        for k in range(0, len(maps) - 1, 2):
            (h1, n1, t1, s1), (h2, n2, t2, s2) = maps[k], maps[k + 1]
            if s1 and s2:
                out.append((h1, n1 + count(t1 + h2) + n2, t2, True))
            elif s1:
                out.append((h1, n1, t1 + h2, True))
            elif s2:
                out.append((h1 + h2, n2, t2, True))
            else:
                out.append((h1 + h2, 0, "", False))
        maps = out + maps[len(maps) - len(maps) % 2:]
    return maps[0]


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, limit: int = 512, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs(doc_id, text)``."""
    path = tokenizer_path or bpe.default_path()
    text = F.coalesce(F.col("text"), F.lit(""))
    length = F.length("text")
    cut = F.when(length <= chunk, F.array("text")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((length - 1) / chunk).cast("int")), lambda k: F.col("text").substr(k * chunk + 1, F.lit(chunk))))
    chunks = (docs.select("doc_id", text.alias("text")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row"), cut.alias("chunks"))
              .select("doc_id", "n_bytes", "row", F.size("chunks").alias("parts"), F.posexplode("chunks").alias("part", "chunk")))

    def run(frames):
        tr = bpe.transducer(path)
        gc.disable()
        for b in frames:
            got = list(zip(*(b.column(c).to_pylist() for c in ("row", "part", "parts", "chunk", "doc_id", "n_bytes")), strict=True))
            maps = [state_map(t, p, n, tr) for _, p, n, t, _, _ in got]
            sums = tr.counts([m[1] for m in maps])
            yield from batches(((r, p, m[0], s, m[2], m[3], d, o, n) for (r, p, n, _, d, o), m, s in zip(got, maps, sums, strict=True)), schema)

    extra = [("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("n_bytes", "bigint"), ("parts", "int")]
    schema = pa.schema([*SCHEMA, ("doc_id", _arrow(docs, "doc_id")), ("n_bytes", pa.int64()), ("parts", pa.int32())])
    maps = chunks.mapInArrow(run, MAPS + "".join(f", {n} {t}" for n, t in extra))

    total_schema = pa.schema([("doc_id", _arrow(docs, "doc_id")), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def fold(frames):
        tr = bpe.transducer(path)
        for b in frames:
            rows = zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_bytes", "maps")), strict=True)
            yield from batches(((d, o, _total(ms, tr)) for d, o, ms in rows), total_schema)

    per_row = (maps.groupBy("row", "doc_id", "n_bytes")
               .agg(F.sort_array(F.collect_list(F.struct("part", "head", "n", "tail", "synced"))).alias("maps")))
    total = per_row.select("doc_id", "n_bytes", "maps").mapInArrow(fold, f"doc_id {extra[0][1]}, n_bytes long, n_tokens long")
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _total(maps: list[dict], tr: bpe.CountTransducer) -> int:
    count = lambda s: tr.counts([s])[0] if s else 0
    head, n, tail, synced = compose([(m["head"], m["n"], m["tail"], m["synced"]) for m in maps], count)
    return count(head) + n + count(tail) if synced else count(head)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)
