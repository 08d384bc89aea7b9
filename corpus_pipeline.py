"""Corpus pipeline: each stage calls one operator of ``ledgerlake.llm`` on all that
the stage before it kept. All stages but the last return the columns of ``documents``;
the last returns the packed pieces.

Null text passes as empty text through every stage; rows without an id are kept by
the filters as their operators define it; an empty table packs to no rows. Documents
may have further columns, of whatever names: they are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, packing, simhash, substring, toxicity
from ledgerlake.llm.common import aside, bucket, table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (score of 0.5 or more) go."""
    fold = bucket(F.col("doc_id"), 5) != 0
    model = toxicity.fit(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"), fold))
    rows, back = aside(docs, "doc_id", "text")
    return back(model.score(rows, tuple(rows.columns)).filter(F.col("score") < 0.5))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id."""
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; texts without any stay as they are, others are their kept words."""
    rows, back = aside(docs, "doc_id", "text", "n_chars")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return back(substring.remove_repeats(rows), **new)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their place in packed sequences."""
    return packing.pack_digest(docs)


STAGES = [("toxicity", toxicity_stage), ("simhash_dedup", simhash_stage), ("substring_dedup", substring_stage), ("decontamination", decontamination_stage), ("packing", packing_stage)]

#: Learned scores, XXH64 fingerprints and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
