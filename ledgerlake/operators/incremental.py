"""Incremental ingestion: files not yet ingested."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.ingest import type_movements
from ledgerlake.sources.headers import read_by_header
from ledgerlake.sources.raw import CSV_FILES, inventory


def new_files(spark: SparkSession, root: str, manifest: DataFrame, glob: str = CSV_FILES) -> DataFrame:
    """Inventory of ``root`` minus the files in ``manifest`` (path, length, modificationTime).

    A file that was replaced under its name has another length or time, so it is new. A
    left-anti join; the manifest grows with the number of files (not rows)
    and AQE picks a broadcast only once its real size is known.
    """
    seen = ["path", "length", "modificationTime"]
    return inventory(spark, root, glob=glob).join(manifest.select(*seen), seen, "left_anti")


def record_manifest(spark: SparkSession, files: DataFrame, manifest_path: str) -> None:
    """Append ingested file paths to the manifest table."""
    (files.select("path", "length", "modificationTime", F.current_timestamp().alias("ingested_at"))
          .write.mode("append").parquet(manifest_path))


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The recorded files; an empty frame before the first run has recorded any."""
    try:
        return spark.read.parquet(manifest_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp, ingested_at timestamp")


def ingest_new(spark: SparkSession, root: str, manifest_path: str, out_path: str, glob: str = CSV_FILES) -> bool:
    """One run of the loop: list what is new under ``root``, type its rows into
    ``out_path/rows``, then record the files. False if nothing is new.

    The listing is written first (``out_path/files``) and rows of other files are
    left out, so what lands during the run waits for the next one. Files are recorded
    only after their rows are committed: a run that fails is repeated as it was. The
    driver gets folders (one per landing), never file paths.
    """
    listed = f"{out_path}/files"
    new_files(spark, root, read_manifest(spark, manifest_path), glob).write.mode("overwrite").parquet(listed)
    files = spark.read.parquet(listed)
    folders = [r[0] for r in files.select(F.regexp_replace("path", r"/[^/]*\z", "")).distinct().collect()]
    if not folders:
        return False
    rows = read_by_header(spark, folders, glob=glob, recursive=False)
    mine = rows.join(files.select(F.col("file_uri").alias("file_path")), "file_path", "left_semi")
    type_movements(mine).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out_path}/rows")
    record_manifest(spark, files, manifest_path)
    return True
