"""Readers of the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import model

EXTRA = "_extra_field"
#: The line of a row as it was read.
LINE = "_line"
_MORE = "_line_with_separator"
#: Fields of a row beyond those of its file's header (fewer: below 0), where the reader knows.
SHAPE = "_shape"
#: Landed CSV files, plain or in a compression that Spark reads; not copies such as ``x.csv.bak``.
CSV_FILES = "*.{csv,csv.gz,csv.bz2,csv.deflate,csv.lz4,csv.snappy,csv.zst}"


def read_raw(spark: SparkSession, paths: str | list[str], header: bool = True, encoding: str = "UTF-8",
             shape: bool = False, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """All-string CSV read with the fixed 7-column schema.

    ``header`` drops the first line of every file. With ``shape`` an eighth
    column ``_extra_field`` captures a token beyond the seventh, so rows with
    too many fields can be quarantined (R2), and ``_line`` holds the line as it
    was read; rows with too few fields get NULLs. ``recursive`` reads sub-folders too, as every raw zone
    is ingested; without it a ``key=value`` layout gives its partition columns. Spark readers skip names starting with ``.`` or ``_``
    (``.gitkeep``, ``_SUCCESS``) by themselves.
    """
    r = whole_lines(spark.read) if shape else spark.read.schema(model.RAW_SCHEMA)
    r = (r.option("header", header)
         .option("encoding", encoding)
         .option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return split_fields(r.csv(paths)) if shape else r.csv(paths)


def whole_lines(reader):
    """A batch or stream reader whose ``csv`` gives each line as one value: header, encoding
    and empty lines as the CSV source treats them, nothing split and no quote taken off. The
    separator is a control character; a line that holds it comes whole as the corrupt record."""
    return (reader.schema(f"{LINE} string, {_MORE} string").option("sep", "\x01").option("quote", "")
            .option("columnNameOfCorruptRecord", _MORE))


def split_fields(lines: DataFrame) -> DataFrame:
    """The seven columns, ``_extra_field`` and ``_line`` of lines read by ``whole_lines``."""
    names = (*model.COLUMNS, EXTRA)
    parse = lambda *cols: F.from_csv(LINE, ", ".join(f"{c} string" for c in cols), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = lines.withColumn(LINE, F.coalesce(_MORE, LINE)).withColumn(_MORE, parse(*names))
    # An empty eighth field may have others behind it; such lines, with neither 7 nor 8 fields, are parsed again.
    commas = F.length(LINE) - F.length(F.replace(LINE, F.lit(","), F.lit("")))
    others = lambda n: parse(*names[:n], "_bad")["_bad"].isNotNull()
    hidden = F.col(_MORE)["pays"].isNotNull() & (commas > len(model.COLUMNS)) & others(7) & others(8)
    extra = F.when(F.col(_MORE)[EXTRA].isNotNull(), F.col(_MORE)[EXTRA]).when(hidden, F.lit(""))
    kept = [c for c in lines.columns if c not in (LINE, _MORE)]
    return parsed.select(*[F.col(_MORE)[c].alias(c) for c in model.COLUMNS], extra.alias(EXTRA), LINE, *kept)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the source ``file_path`` / ``file_name`` from the hidden metadata column."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name"))


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Line scan of text files (S7): ``value`` plus source ``file_name``."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(paths).select("value", F.col("_metadata.file_name").alias("file_name"))


def inventory(spark: SparkSession, root: str, glob: str | None = None, content: bool = False) -> DataFrame:
    """Recursive file listing of a zone (S5): path, size, modification time.

    The ``content`` column is pruned unless asked for, so a listing reads
    no file bytes. ``glob`` filters names (F5). ``file_uri`` is the path as the
    rows' own metadata spell it.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    cols = ["path", "length", "modificationTime"] + (["content"] if content else [])
    return df.select(*cols, F.col("_metadata.file_path").alias("file_uri"))


def listing(spark: SparkSession, root: str, n: int = 20, glob: str | None = None) -> DataFrame:
    """First ``n`` entries of a recursive listing in path order (O1, O3):
    a TakeOrderedAndProject, never a full sort into one task."""
    return inventory(spark, root, glob=glob).orderBy("path").limit(n)


def select_parts(df: DataFrame, name_fragment: str) -> DataFrame:
    """Keep rows of files whose name holds ``name_fragment``."""
    return df.filter(F.col("_metadata.file_path").contains(name_fragment))


def head(df: DataFrame, n: int = 20, order_col: str = "mouvement_no") -> DataFrame:
    """Deterministic preview (S8): top-n by id, a TakeOrderedAndProject."""
    return df.orderBy(order_col).limit(n)
