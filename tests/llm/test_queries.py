"""Registered queries against their SQL, and the pipeline stage by stage."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, queries, simhash
from ledgerlake.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.ORACLES[name]).df()[list(got.columns)]
    key = list(got.columns)
    assert got.sort_values(key).reset_index(drop=True).astype(str).equals(want.sort_values(key).reset_index(drop=True).astype(str))


def test_pipeline_stages(spark):
    import corpus_pipeline

    # Extra columns, called as the operators call their own.
    clash = ["size", "seed", "margin", "prediction", "probability", "rawPrediction", "score", "label", "_features", "_kept", "_hit", "_hash", "_id", "_cut",
             "n_words", "n_removed", "kept", "whole", "starts", "text_hash", "fp", "component_id", "item_id", "length", "offset", "sequence_id", "ids", "_row"]
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in clash})
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), f"test-{name}")
        kept.append(docs)
        if name != "packing":
            assert docs.columns == documents.columns
            assert docs.filter(F.concat_ws(" ", *clash) != F.concat_ws(" ", *[F.concat(F.lit(c), F.col("doc_id")) for c in clash])).count() == 0
        if name == "simhash_dedup":
            want = simhash.near_duplicates(before).select("component_id").distinct()
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(r[0] for r in want.collect())
        if name == "substring_dedup":
            seen = set()
            for r in docs.orderBy("doc_id").collect():
                w = r.text.split()
                own = {hashlib.md5(" ".join(w[k:k + 50]).encode()).digest() for k in range(len(w) - 49)}
                assert r.n_chars == len(r.text)
                seen |= own
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            items = [decontaminate.normal(r.text) for r in bench.collect()]
            texts = {r.doc_id: decontaminate.normal(r.text) for r in before.collect()}
            left = {r.doc_id for r in docs.collect()}
            assert not [d for d in left if any(i in texts[d] for i in items)]
            assert left | {r.doc_id for r in decontaminate.matches(before, bench).collect()} == set(texts)
    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert pieces.filter("n <> t").count() == 0 and pieces.count() == kept[-2].count()
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
