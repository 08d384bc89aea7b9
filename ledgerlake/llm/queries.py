"""The queries of this subpackage (one per operator, and the pipeline) and their SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import chat_format, decontaminate, hard_negatives, language_id, lm_scoring, packing, prefix_trie, simhash, substring, token_counts, token_files, topk_search, toxicity
from ledgerlake.llm.common import bucket, table

CONTROL = "</s>[INST] ok [/INST]"


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows by Hamming distance of sign codes, for every id divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk_search.sign_code(F.col("embedding")).alias("code"))
    queries = rows.filter(F.pmod("id", F.lit(100)) == 0).withColumnRenamed("id", "query_id")
    return topk_search.top_k(rows, queries).withColumnRenamed("id", "vec_id")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(CONTROL).alias("text"))
    read = chat_format.read_back(chat_format.format_chats(conversations.unionByName(control)))
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), bucket(F.col("doc_id"), 10) == 0, order=3)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = bucket(F.col("doc_id"), 3) == 1
    return language_id.identify(docs, docs.filter(~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_langs")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", F.col("n_removed").cast("long").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"), ~held))
    return model.score(docs).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_topk_search, op2_chat_format, op3_lm_scoring, op4_simhash_dedup, op5_language_id, op6_token_counts, op7_packing,
                                   op8_decontamination, op9_substring_dedup, op10_toxicity, op11_prefix_trie, op12_hard_negatives, op13_token_files, pipeline)}

ORACLES = {
    "op1_topk_search": """
        WITH e AS (SELECT vec_id, list_transform(range(1, 65), lambda i: coalesce(embedding[i] > 0, false)) AS bits FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
        d AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(len(list_filter(range(1, 65), lambda i: q.bits[i] <> e.bits[i])) AS INT) AS distance
              FROM e AS q JOIN e ON q.vec_id % 100 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank, vec_id, distance FROM d)
        SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10""",
    "op2_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        s AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                     coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                     3 + sum(17 + length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g'))) AS chars
              FROM c GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM s""",
    "op9_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
        p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS p, ws FROM d WHERE len(ws) >= 50),
        h AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h FROM p),
        m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
        g AS (SELECT h.doc_id, list(DISTINCT h.p) AS starts FROM h JOIN m USING (h) WHERE m.least < h.doc_id GROUP BY h.doc_id),
        x AS (SELECT g.doc_id, unnest(starts) AS s FROM g),
        gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(s, s + 50)) AS i FROM x) GROUP BY doc_id),
        k AS (SELECT d.doc_id, ws, coalesce(gone, []) AS gone FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
               sha256(array_to_string(CASE WHEN len(gone) = 0 THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END, ' ')) AS kept_sha256
        FROM k""",
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
        b AS (SELECT conv_id, list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))) AS bytes FROM own),
        c AS (SELECT conv_id, xor(list_reduce(bytes, lambda c, x: list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) AS crc FROM b),
        m AS (SELECT c.conv_id, crc % 9 AS h, c.conv_id - c.conv_id % 5 AS base, least(crc % 9, coalesce(o.n, 0)) AS got FROM c LEFT JOIN own AS o ON o.conv_id = c.conv_id - c.conv_id % 5),
        r AS (SELECT m.conv_id, t.pos AS depth, role, text FROM m JOIN t ON t.conv_id = m.base AND t.pos <= m.got
              UNION ALL SELECT m.conv_id, t.pos - m.h + m.got, role, text FROM m JOIN t ON t.conv_id = m.conv_id AND t.pos > m.h),
        p AS (SELECT conv_id, depth, strlen(text) AS bytes, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS k FROM r
              UNION ALL SELECT conv_id, 0, 0, '' FROM own),
        n AS (SELECT depth, k, min(conv_id) AS node, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY depth, k),
        w AS (SELECT p.conv_id, p.depth, n.node FROM p JOIN n USING (depth, k)),
        up AS (SELECT DISTINCT a.node, a.depth, b.node AS parent FROM w AS a JOIN w AS b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
        kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM up GROUP BY 1, 2),
        v AS (SELECT n.node, n.depth, n_convs, coalesce(n_children, 0) AS n_children, up.parent, (n_convs - 1) * bytes AS saved
              FROM n LEFT JOIN kids ON kids.node = n.node AND kids.depth = n.depth LEFT JOIN up ON up.node = n.node AND up.depth = n.depth),
        s AS (SELECT w.node, w.depth, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum(v.saved) AS saved_tokens FROM v JOIN w ON w.conv_id = v.node AND w.depth <= v.depth GROUP BY 1, 2),
        len AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
        e AS (SELECT w.node, w.depth, sha256(string_agg(CAST(w.conv_id AS VARCHAR), ',' ORDER BY w.conv_id)) AS ends FROM len JOIN w USING (conv_id, depth) GROUP BY 1, 2)
        SELECT v.node AS conv_id, CAST(v.depth AS BIGINT) AS depth, v.parent AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
        FROM v JOIN s ON s.node = v.node AND s.depth = v.depth LEFT JOIN e ON e.node = v.node AND e.depth = v.depth""",
    "op12_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
