"""Exact top-k search of binary codes by incremental multi-index hashing.

A code of 64 bits is cut into four segments of 16 bits, each indexed. Round s probes
all segment values exactly s flips from the query's. After round s every code at
distance 4(s + 1) - 1 or less has met the query in some segment, so a query is done
once its k-th verified distance is covered by that bound; the others go on to the
next radius. Work is on distinct codes with their k smallest ids each, so a code
that a third of all rows share is one entry, and no row is lost.

Rows without an id or code are neither query nor answer. Repeated ids answer once
each row; ties go to the smaller id. Fewer than k rows give all of them. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

SEGMENTS, BITS, TOP = 4, 16, 10


def sign_code(vector, dims: int = 64):
    """Bit i is set if component i is above zero; missing, null or NaN components are not."""
    part = lambda i: F.get(vector, F.lit(i))
    code = F.lit(0).cast("long")
    for i in range(dims):
        bit = F.when((part(i) > 0) & ~F.isnan(part(i)), F.lit(1)).otherwise(F.lit(0)).cast("long")
        code = code.bitwiseOR(F.shiftleft(bit, i))
    return F.when(vector.isNotNull(), code)


def segment(code, s: int):
    return F.shiftrightunsigned(code, BITS * s).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def smallest(rows: DataFrame, key: list[str], order: list[str], k: int, salts: int = 64) -> DataFrame:
    """The first k rows of each key, in two steps so that no key is one task."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    for part in ([*key, "_salt"], key):
        salted = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")
    return salted.drop("_salt")


def top_k(codes: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, id, distance: the k nearest rows of ``codes(id, code)`` for each
    row of ``queries(query_id, code)``, ties by id."""
    rows = codes.select("id", "code").dropna()
    ids = smallest(rows, ["code"], ["id"], k)
    entries = written(ids.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "topk-codes")
    index = written(entries.select("code", F.size("ids").alias("n"), F.explode(F.array(*[F.struct(F.lit(s).alias("seg"), segment(F.col("code"), s).alias("value")) for s in range(SEGMENTS)])).alias("p")).select("p.seg", "p.value", "code", "n"), "topk-index")
    active = written(queries.select(F.col("code").alias("q")).dropna().distinct().withColumn("most", F.lit(64)), "topk-active")
    found = None
    done = None
    left = active.count()
    for radius in range(BITS + 1):
        if not left:
            break
        masks = F.expr(f"filter(sequence(0, {(1 << BITS) - 1}), x -> bit_count(x) = {radius})")
        probes = active.select("q", "most", F.explode(F.array(*[F.struct(F.lit(s).alias("seg"), segment(F.col("q"), s).alias("v")) for s in range(SEGMENTS)])).alias("p"))
        probes = probes.select("q", "most", F.col("p.seg").alias("at"), F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("p.v")))).alias("v"))
        # Nothing farther than the k-th distance verified so far can still be an answer. The
        # probes grow only in their last step, which size estimates do not see: no broadcast.
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        meet = (F.col("at") == F.col("seg")) & (F.col("v") == F.col("value")) & (distance <= F.col("most"))
        hits = probes.hint("merge").join(index, meet).select("q", "code", "n", distance.alias("distance")).distinct()
        if found is not None:
            hits = hits.unionByName(found).distinct()
        # Enough codes to hold k rows: nearest first, up to the code that holds the k-th row.
        upto = F.sum("n").over(Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        same = F.sum("n").over(Window.partitionBy("q", "distance"))
        found = written(hits.withColumn("upto", upto).withColumn("same", same).filter(F.col("upto") - F.col("same") < k).select("q", "code", "n", "distance"), "topk-found")
        kth = found.groupBy("q").agg(F.sum("n").alias("n"), F.max("distance").alias("d"))
        covered = (F.col("n") >= k) & (F.col("d") <= SEGMENTS * (radius + 1) - 1)
        ready = kth.filter(covered).select("q") if radius < BITS else kth.select("q")
        finished = found.join(ready, "q", "left_semi")
        done = finished if done is None else done.unionByName(finished)
        known = kth.select(F.col("q").alias("k_q"), F.when(F.col("n") >= k, F.col("d").cast("int")).otherwise(F.lit(64)).alias("bound"))
        active = written(active.join(ready, "q", "left_anti").join(known, F.col("q") == F.col("k_q"), "left").select("q", F.coalesce("bound", "most").alias("most")), "topk-active")
        found = found.join(ready, "q", "left_anti")
        left = active.count()
    if done is None:
        none = rows.join(queries.select("query_id", "code").dropna(), "code").filter(F.lit(False))
        return none.select("query_id", F.lit(0).alias("rank"), "id", F.lit(0).alias("distance"))
    done = written(done, "topk-done")
    answers = queries.select("query_id", F.col("code").alias("q")).join(done, "q").join(entries, "code").select("query_id", "distance", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", F.col("distance").cast("int").alias("distance"))
