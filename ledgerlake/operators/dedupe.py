"""One row per id across overlapping landings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.runs import id_runs
from ledgerlake.operators.scan import ordered_scan
from ledgerlake.session import scratch_path


def union_landings(*landings: DataFrame) -> DataFrame:
    """Concatenate landings by column name (R4); columns missing in one side become NULL."""
    out = landings[0]
    for other in landings[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def keep_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Keep the first row of every ``key`` by an explicit priority.

    ``dropDuplicates`` would keep an arbitrary row; here the landing priority
    decides. Catalyst rewrites ``row_number() = 1`` into a WindowGroupLimit
    that already trims each map task's rows before the shuffle by ``key``, and
    every key group is as small as the number of landings, so no task ever
    holds a large group.
    """
    # Rows without a key are not duplicates of each other, equal ones included: each is
    # a group of its own, so none is dropped and they do not pile up in one task.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    # All columns break ties after the given order, so a rerun keeps an equal row.
    order = [*order_cols, *[c for c in df.columns if c not in order_cols]]
    w = Window.partitionBy(key, "__alone").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (df.withColumn("__alone", alone).withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn", "__alone"))


def zone_maps(staged: DataFrame, key: str) -> DataFrame:
    """file_path, lo, hi of ``key`` per file: one scan of that column."""
    files = staged.select(F.col("_metadata.file_path").alias("file_path"), key)
    return files.groupBy("file_path").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo is not null")


def files_with_repeats(staged: DataFrame, key: str) -> DataFrame:
    """file_path of the files of a written table in whose range (least to greatest id) any id is there
    twice: intervals of repeated ids and files meet in one ordered scan, not in pairs."""
    repeated = id_runs(staged, key).filter("copies > 1")
    files = zone_maps(staged, key)
    none = F.lit(None).cast("bigint")
    # A file meets a repeated interval if the greatest end of those that begin by its end is not before its begin.
    both = (repeated.select(F.col("first_no").alias("at"), F.col("last_no").alias("until"), none.alias("lo"), F.lit(None).cast("string").alias("file_path"))
            .unionByName(files.select(F.col("hi").alias("at"), none.alias("until"), F.col("lo"), "file_path")))
    return ordered_scan(both, "at", greatest={"reach": "until"}).filter("file_path is not null and reach >= lo").select("file_path")


def keep_first_by_zones(staged: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """``keep_first`` of a written (file-based) table that shuffles only what can hold a repeated id:
    files whose range of ids meets a repeated id go through the dedupe, all other files pass as they are.
    Landings write contiguous ids, so the shuffle grows with the overlap of the landings, not with the table."""
    files = scratch_path(staged.sparkSession, "overlap")
    files_with_repeats(staged, key).select(F.col("file_path").alias("__hit")).write.parquet(files)
    hit = staged.sparkSession.read.schema("__hit string").parquet(files)  # its size decides how it is joined
    rows = staged.select("*", F.col("_metadata.file_path").alias("__file"))
    on = F.col("__file") == F.col("__hit")
    again = keep_first(rows.join(hit, on, "left_semi").drop("__file"), key, order_cols)
    return rows.join(hit, on, "left_anti").drop("__file").unionByName(again)
