"""Prefix trie of conversations, its subtree totals found by parallel tree contraction.

A node is a distinct sequence of first turns. Turns are ranked by one global sort (a
conversation may span many tasks), each turn at its depth is hashed to 128 bits and a
prefix is the exclusive-or of its turns' hashes, so prefixes are a scan that composes
over segments of a conversation and a parent's key is a child's key without its last turn.

Subtree totals (childless nodes; ``(members - 1) * bytes of the last text``) come from
rounds of joins: **rake** adds every leaf to its parent and takes it out, **compress**
splices nodes with a single child out of their chain (an independent set, by a coin per
node and round; the child remembers what lay between it and its new parent). A node keeps
the count and the sums of its children's ids, so a node with one child knows which it is and
every message goes to one row: no join meets a hot key. Each round is a written table;
rounds are logarithmic in the tree, long chains included. Then the rounds are
**re-expanded** backwards: a spliced node's total is what it held plus its child's.

Turn order: ``turn`` (null first), then role and text. Null role or text is empty. Rows
without a conv_id take no part. Repeated rows are turns of their own; extra columns are
ignored; an empty table has no nodes (not even the root).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, tasks_for, written

SHARED, FAMILY, SEGMENT = 9, 5, 1024
ID = "decimal(38,0)"


def lookup(left: DataFrame, right: DataFrame, keys: dict[str, str], weight: str, new: list[str], most: int = 1000) -> DataFrame:
    """``left`` with the columns ``new`` of the row of ``right`` whose keys are equal (null if
    there is none); ``keys``: left name -> right name, unique in ``right``. ``weight`` says how many rows of ``left``
    a row of ``right`` meets. Rows that meet at least a ``most``-th of them all (so at most
    ``most`` rows) are broadcast; the rest is a shuffled join without hot keys."""
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    bar = max(1, -(-int(total) // most))
    names = {k: f"_r{i}" for i, k in enumerate(keys.values())}
    side = lambda cond, tag: right.filter(cond).select(*[F.col(k).alias(f"{v}{tag}") for k, v in names.items()], *[F.col(c).alias(f"_{c}{tag}") for c in new], F.lit(True).alias(f"_found{tag}"))
    on = lambda tag: [F.col(a) == F.col(f"{names[b]}{tag}") for a, b in keys.items()]
    hot = left.join(F.broadcast(side(F.col(weight) >= bar, "h")), on("h"), "left")
    known = hot.filter("_foundh").select(*left.columns, *[F.col(f"_{c}h").alias(c) for c in new])
    rest = hot.filter("_foundh is null").select(*left.columns).join(side(F.col(weight) < bar, "c"), on("c"), "left")
    return known.unionByName(rest.select(*left.columns, *[F.col(f"_{c}c").alias(c) for c in new]))


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t1, t2 (a digest of role and text), n_bytes (of the text): one sort by range,
    in which a conversation may fill several tasks, then positions from the tasks' counts."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    word = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    rows = rows.select("conv_id", "turn", "role", "text", word(1).alias("t1"), word(16).alias("t2"), F.octet_length("text").cast("long").alias("n_bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = rows.repartitionByRange(tasks_for(conversations, 1_000_000), *order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "n_bytes")
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("idx", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n_bytes", pa.int64())])

    def run(frames: Iterator[pa.RecordBatch]):
        part, last, at = TaskContext.get().partitionId(), None, 0
        for b in frames:
            c = b.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(c):
                continue
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            idx = np.arange(len(c)) - np.repeat(first, np.diff(np.append(first, len(c))))
            if last == c[0]:  # the batch goes on with the last one's conversation
                idx[:first[1] if len(first) > 1 else len(c)] += at
            last, at = c[-1], int(idx[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(np.full(len(c), part, np.int32)), pa.array(idx), b.column("t1"), b.column("t2"), b.column("n_bytes")], schema=schema)

    turns = written(dealt.mapInArrow(run, "conv_id long, part int, idx long, t1 long, t2 long, n_bytes long"), "trie-turns")
    # Only conversations that lie across two tasks need an offset: fewer than two rows per task in all.
    runs = turns.groupBy("conv_id", "part").agg((F.max("idx") + 1).alias("n"))
    across = runs.join(runs.groupBy("conv_id").agg(F.count("*").alias("k")).filter("k > 1").select("conv_id"), "conv_id")
    before = across.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("_before"))
    placed = turns.join(F.broadcast(before), (F.col("conv_id") == F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    return placed.select("conv_id", (F.col("idx") + F.coalesce("_before", F.lit(0)) + 1).alias("pos"), "t1", "t2", "n_bytes")


def rebuilt(conversations: DataFrame, shared: int = SHARED, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first h turns of its family's first one before its own turns
    after h (h: crc32 of its id modulo ``shared``). Two tables: (conv_id, length) and
    (conv_id, depth, length, t1, t2, n_bytes)."""
    turns = ranked_turns(conversations)
    head = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(shared))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    sizes = sizes.select("conv_id", "own", head("conv_id").alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("_b"), F.col("own").alias("_n"))
    sizes = sizes.join(bases, F.col("base") == F.col("_b"), "left")
    got = F.least("h", F.coalesce("_n", F.lit(0)))
    lengths = written(sizes.select("conv_id", "own", "h", "base", got.alias("got"), (got + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "trie-lengths")
    # Inherited turns: fewer than ``shared`` of a base, for at most ``family`` (or twice that, around 0) conversations.
    heirs = lengths.filter("got > 0").select(F.col("conv_id").alias("_c"), "base", "got", "length")
    first = turns.filter((F.col("pos") < shared) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "_from")
    old = first.join(heirs, (F.col("_from") == F.col("base")) & (F.col("pos") <= F.col("got"))).select(F.col("_c").alias("conv_id"), F.col("pos").alias("depth"), "length", "t1", "t2", "n_bytes")
    rest = lookup(turns.filter(F.col("pos") > head("conv_id")), lengths, {"conv_id": "conv_id"}, "own", ["got", "length"])
    own = rest.select("conv_id", (F.col("pos") - head("conv_id") + F.col("got")).alias("depth"), "length", "t1", "t2", "n_bytes")
    return lengths.select("conv_id", "length"), old.unionByName(own)


def prefixes(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``rows`` with the prefix key (k1, k2) and the parent's (p1, p2). The running exclusive-or is taken in
    segments of bounded length, then carried over the segments of long conversations."""
    turn = lambda salt: F.xxhash64("depth", "t1", "t2", F.lit(salt))
    rows = rows.select("conv_id", "depth", "length", "n_bytes", F.floor(F.col("depth") / segment).alias("seg"), turn("first").alias("x1"), turn("second").alias("x2"))
    run = Window.partitionBy("conv_id", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"k1": F.bit_xor("x1").over(run), "k2": F.bit_xor("x2").over(run)})
    totals = rows.filter(F.col("length") >= segment).groupBy("conv_id", "seg").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col("conv_id").alias("_c"), F.col("seg").alias("_s"), F.bit_xor("s1").over(earlier).alias("_o1"), F.bit_xor("s2").over(earlier).alias("_o2"))
    late = local.filter("seg > 0").join(carry.filter("_s > 0"), (F.col("conv_id") == F.col("_c")) & (F.col("seg") == F.col("_s")))
    late = late.withColumns({"k1": F.col("k1").bitwiseXOR(F.col("_o1")), "k2": F.col("k2").bitwiseXOR(F.col("_o2"))}).select(*local.columns)
    return local.filter("seg = 0").unionByName(late).withColumns({"p1": F.col("k1").bitwiseXOR(F.col("x1")), "p2": F.col("k2").bitwiseXOR(F.col("x2"))}).drop("seg", "x1", "x2")


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids per node (depth, k1, k2). Ids are sorted by range and joined
    to strings of bounded size in many tasks; the strings of a node then pass, in order, through
    one hash (SHA-256 cannot be split), a few bytes at a time, never held as a whole."""
    key = ["depth", "k1", "k2"]
    dealt = ends.select(*key, "conv_id").repartitionByRange(tasks_for(ends, 2_000_000), *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    schema = pa.schema([*((k, pa.int64()) for k in key), ("first", pa.int64()), ("ids", pa.string())])

    def join(frames):
        def runs():
            for b in frames:
                cols = [b.column(k).to_numpy(zero_copy_only=False) for k in (*key, "conv_id")]
                if not len(cols[0]):
                    continue
                cuts = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0), [True]]))
                for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                    yield (*(int(c[a]) for c in cols[:3]), int(cols[3][a]), ",".join(map(str, cols[3][a:z].tolist())))
        yield from batches(runs(), schema)

    pieces = dealt.mapInArrow(join, "depth long, k1 long, k2 long, first long, ids string")
    schema2 = pa.schema([*((k, pa.int64()) for k in key), ("ends_sha256", pa.string())])

    def digest(frames):
        def nodes():
            last, h = None, None
            for b in frames:
                for *k, ids in zip(*(b.column(c).to_pylist() for c in (*key, "ids")), strict=True):
                    if k != last:
                        if last is not None:
                            yield (*last, h.hexdigest())
                        last, h = k, hashlib.sha256(ids.encode())
                    else:
                        h.update(b"," + ids.encode())
            if last is not None:
                yield (*last, h.hexdigest())
        yield from batches(nodes(), schema2)

    return pieces.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def trie_nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (conv_id, depth, k1, k2, parent_conv_id, n_convs, n_children, kid_sum, kid_depths, saved) and their ends' digests."""
    lengths, rows = rebuilt(conversations)
    members = written(prefixes(rows), "trie-members")
    inner = members.groupBy("depth", "k1", "k2", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "conv_id", "n_convs", zero.alias("n_bytes"))
    nodes = written(inner.unionByName(root), "trie-keys")
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("_d"), F.col("p1").alias("_k1"), F.col("p2").alias("_k2")).agg(
        F.count("*").alias("n_children"), F.sum(F.col("conv_id").cast(ID)).cast(ID).alias("kid_sum"))
    own = nodes.join(kids, (F.col("depth") == F.col("_d")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").drop("_d", "_k1", "_k2")
    n = F.coalesce("n_children", zero)
    own = written(own.withColumns({"n_children": n, "kid_sum": F.coalesce("kid_sum", F.lit(0).cast(ID)), "kid_depths": (n * (F.col("depth") + 1)).cast(ID), "saved": (F.col("n_convs") - 1) * F.col("n_bytes"), "up": F.col("depth") - 1}), "trie-own")
    parents = own.filter("n_children > 0").select("depth", "k1", "k2", F.col("conv_id").alias("parent_conv_id"), "n_children")
    named = lookup(own, parents, {"up": "depth", "p1": "k1", "p2": "k2"}, "n_children", ["parent_conv_id"])
    ends = members.filter("depth = length").select("depth", "k1", "k2", "conv_id").unionByName(lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    return written(named.drop("p1", "p2", "up", "n_bytes"), "trie-nodes"), ends_digest(ends)


def _coin(c: str, d: str, turn: int) -> Column:
    return F.pmod(F.xxhash64(c, d, F.lit(turn)), F.lit(2)) == 1


def contract(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens (of the subtree) of every node
    (conv_id, depth, parent_conv_id, n_children, kid_sum, kid_depths, saved)."""
    leaf = (F.col("n_children") == 0).cast("long")
    live = nodes.select("conv_id", "depth", F.col("parent_conv_id").alias("pc"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"), F.col("n_children").alias("k"), F.col("kid_sum").alias("kc"), F.col("kid_depths").alias("kd"),
                        leaf.alias("leaves"), F.col("saved").cast(ID).alias("saved"), F.lit(0).cast("long").alias("gap_leaves"), F.lit(0).cast(ID).alias("gap_saved"))
    names = live.columns
    raked, spliced = [], []
    while True:
        inner = F.col("pc").isNotNull()
        leaves = live.filter("k = 0")
        raked.append(leaves.select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")))
        # Rake: what a leaf holds, and what was spliced out above it, goes to its parent.
        given = leaves.filter(inner).groupBy(F.col("pc").alias("_c"), F.col("pd").alias("_d")).agg(
            F.count("*").alias("_k"), F.sum(F.col("conv_id").cast(ID)).cast(ID).alias("_kc"), F.sum(F.col("depth").cast(ID)).cast(ID).alias("_kd"),
            F.sum(F.col("leaves") + F.col("gap_leaves")).alias("_l"), F.sum(F.col("saved") + F.col("gap_saved")).cast(ID).alias("_s"))
        rest = live.filter("k > 0").join(given, (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("_d")), "left")
        less = lambda c, t: (F.col(c) - F.coalesce(F.col(t), F.lit(0))).cast(live.schema[c].dataType)
        more = lambda c, t: (F.col(c) + F.coalesce(F.col(t), F.lit(0))).cast(live.schema[c].dataType)
        left = written(rest.withColumns({"k": less("k", "_k"), "kc": less("kc", "_kc"), "kd": less("kd", "_kd"), "leaves": more("leaves", "_l"), "saved": more("saved", "_s")}).select(*names), "trie-raked")
        if left.isEmpty():
            break
        # Compress: unary nodes whose coin fell and whose child is not such a node itself.
        turn = len(raked)
        unary = F.col("pc").isNotNull() & (F.col("k") == 1) & _coin("conv_id", "depth", turn)
        out = left.filter(unary).select(F.col("conv_id").alias("uc"), F.col("depth").alias("ud"), F.col("pc").alias("upc"), F.col("pd").alias("upd"), F.col("kc").cast("long").alias("cc"), F.col("kd").cast("long").alias("cd"), F.col("leaves").alias("ul"),
                                        F.col("saved").alias("us"), F.col("gap_leaves").alias("ugl"), F.col("gap_saved").alias("ugs"))
        pairs = out.join(left.filter(~unary), (F.col("cc") == F.col("conv_id")) & (F.col("cd") == F.col("depth")))
        cut = written(pairs.select("uc", "ud", "upc", "upd", "cc", "cd", "ul", "us", "ugl", "ugs", F.col("gap_leaves").alias("cgl"), F.col("gap_saved").alias("cgs")), "trie-spliced")
        spliced.append(cut)
        none = lambda t: F.lit(None).cast(t)
        message = lambda c, d, gone=False, p=(none("long"), none("long")), gap=(F.lit(0).cast("long"), F.lit(0).cast(ID)), kid=(F.lit(0).cast(ID), F.lit(0).cast(ID)): cut.select(
            F.col(c).alias("_c"), F.col(d).alias("_d"), F.lit(gone).alias("_gone"), p[0].alias("_pc"), p[1].alias("_pd"), gap[0].cast("long").alias("_gl"), gap[1].cast(ID).alias("_gs"), kid[0].cast(ID).alias("_kc"), kid[1].cast(ID).alias("_kd"))
        mail = (message("uc", "ud", gone=True)
                .unionByName(message("cc", "cd", p=(F.col("upc"), F.col("upd")), gap=(F.col("ul") + F.col("ugl"), F.col("us") + F.col("ugs"))))
                .unionByName(message("upc", "upd", kid=(F.col("cc").cast(ID) - F.col("uc").cast(ID), F.col("cd").cast(ID) - F.col("ud").cast(ID)))))
        mail = mail.groupBy("_c", "_d").agg(F.max("_gone").alias("_gone"), F.max("_pc").alias("_pc"), F.max("_pd").alias("_pd"), F.sum("_gl").alias("_gl"), F.sum("_gs").cast(ID).alias("_gs"), F.sum("_kc").cast(ID).alias("_kc"), F.sum("_kd").cast(ID).alias("_kd"))
        kept = left.join(mail, (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("_d")), "left").filter(~F.coalesce("_gone", F.lit(False)))
        live = written(kept.withColumns({"pc": F.coalesce("_pc", "pc"), "pd": F.coalesce("_pd", "pd"), "gap_leaves": more("gap_leaves", "_gl"), "gap_saved": more("gap_saved", "_gs"), "kc": more("kc", "_kc"), "kd": more("kd", "_kd")}).select(*names), "trie-live")
    # Re-expand: a round's spliced nodes hang on nodes that left later, so their totals are known.
    known = raked.pop()
    while spliced:
        cut = spliced.pop()
        child = known.select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), "n_leaves", "saved_tokens")
        totals = cut.join(child, (F.col("cc") == F.col("_c")) & (F.col("cd") == F.col("_d"))).select(
            F.col("uc").alias("conv_id"), F.col("ud").alias("depth"), (F.col("ul") + F.col("cgl") + F.col("n_leaves")).alias("n_leaves"), (F.col("us") + F.col("cgs") + F.col("saved_tokens")).cast(ID).alias("saved_tokens"))
        known = written(known.unionByName(totals).unionByName(raked.pop()), "trie-totals")
    return known


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (the contract's columns)."""
    nodes, digests = trie_nodes(conversations)
    totals = contract(nodes).select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), "n_leaves", F.col("saved_tokens").cast("long").alias("saved_tokens"))
    marks = digests.select(F.col("depth").alias("_e"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "ends_sha256")
    full = nodes.join(totals, (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("_d")))
    full = full.join(marks, (F.col("depth") == F.col("_e")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"))
