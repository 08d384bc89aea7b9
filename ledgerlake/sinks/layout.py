"""Shards, landing writers, compaction and published layouts.

Physical file names are Spark's own (``part-NNNNN-...``); the logical shard
name of the reference (``mouvements-00000-of-00005.csv``) is a column. The
part number equals the writing task's partition id, so a landing written
straight from ``spark.range(0, N, 1, n)`` has exactly ``n`` files of
contiguous id intervals and its plan has no Exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.sources.generate import index_range, movements, raw_columns


def shard_of(i: Column | str, n_rows: int | Column, n_shards: int) -> Column:
    """Shard of 0-based row ``i`` when ``n_rows`` are cut into ``n_shards``
    contiguous intervals exactly as ``spark.range(0, n_rows, 1, n_shards)``
    does (M1, remainder kept: 11 rows / 5 shards -> 2, 2, 2, 2, 3)."""
    i = F.col(i) if isinstance(i, str) else i
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    return F.floor(((i + 1) * F.lit(n_shards) - 1) / n).cast("bigint")


def shard_name(shard: Column, n_shards: int, beam: bool = False) -> Column:
    """Logical shard file name (P16; P17 when ``beam``)."""
    fmt = model.BEAM_SHARD_NAME_FORMAT if beam else model.SHARD_NAME_FORMAT
    return F.format_string(fmt, shard, F.lit(n_shards))


def part_number(file_name: Column) -> Column:
    """Writer task number from a Spark output file name."""
    return F.regexp_extract(file_name, r"part-(\d+)", 1).cast("bigint")


def csv_line(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Comma-joined text line without quoting (P14); safe because no value holds a comma."""
    cols = cols or df.columns
    return F.concat_ws(",", *[F.col(c).cast("string") for c in cols])


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None,
              encoding: str | None = None, mode: str = "errorifexists", by: str | None = None, file_rows: int | None = None) -> None:
    """CSV sink (K1, P13): minimal quoting, LF line ends, one file per task; with ``by`` one per value
    of that column and task, in a folder of the value, with ``file_rows`` a new one after so many rows."""
    w = df.write.mode(mode).option("header", header).option("lineSep", "\n")
    if compression:
        w = w.option("compression", compression)
    if encoding:
        w = w.option("encoding", encoding)
    if by:
        w = w.partitionBy(by)
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    w.csv(path)


def land_movements(spark: SparkSession, path: str, n_rows: int, n_shards: int = model.DEFAULT_SHARDS,
                   seed: int = 42, labels: str = "ascii", start: int = 0, id_offset: int = 0,
                   encoding: str | None = None, compression: str | None = None, header: bool = True,
                   mode: str = "errorifexists", index: DataFrame | None = None, file_rows: int | None = None) -> DataFrame:
    """Generate ``n_rows`` and land them as ``n_shards`` CSV files (K1, K2).

    The source is ``spark.range`` with one partition per shard, so each
    writer task writes one contiguous id interval and nothing is shuffled;
    ``index`` gives row counters of another table, dealt the same way, instead; with
    ``file_rows`` a task begins a new file after so many rows.
    Returns the generated frame (lazy) for callers that want metrics.
    """
    gen = movements(index_range(spark, n_rows, n_shards, start) if index is None else index, seed=seed, labels=labels, id_offset=id_offset)
    write_csv(raw_columns(gen), path, header=header, compression=compression, encoding=encoding, mode=mode, file_rows=file_rows)
    return gen


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> None:
    """Text sink of one ``value`` column."""
    w = lines.write.mode("errorifexists")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def compact(df: DataFrame, shard_col: str, n_shards: int, order_col: str | None = None,
            files_per_shard: int = 1) -> DataFrame:
    """Consolidate many part files into ``files_per_shard`` files per shard (K3).

    ``repartitionById`` sends each row to the partition named by its id (no
    sampled range bounds): shard ``s`` goes to partitions
    ``s*k .. s*k+k-1``, split by a hash of ``order_col``, so a large shard
    is written by ``k`` tasks instead of one. Rows are put back in id order
    inside each file (O2). Callers assert rows in = rows out from metrics.
    """
    k = max(1, files_per_shard)
    pid = F.col(shard_col).cast("int") * F.lit(k)
    if k > 1:
        pid = pid + F.pmod(F.xxhash64(F.col(order_col or shard_col)), F.lit(k)).cast("int")
    out = df.repartitionById(n_shards * k, pid)
    if order_col:
        out = out.sortWithinPartitions(order_col)
    return out


def neighbour_groups(files: Iterable[tuple[str, int]], target_bytes: int) -> Iterator[list[str]]:
    """Paths of consecutive files of one folder, at most ``target_bytes`` together (a larger file is a group of its
    own); ``files`` (path, length) come in the order that the rows are to be in."""
    group: list[str] = []
    size, folder = 0, None
    for path, length in files:
        here = path.rsplit("/", 1)[0]
        if group and (here != folder or size + length > target_bytes):
            yield group
            group, size = [], 0
        group.append(path)
        size, folder = size + length, here
    if group:
        yield group


def merged(groups: list[list[str]], uris: dict[str, str], read: Callable[[list[str]], DataFrame], order_col: str) -> DataFrame:
    """The rows of each group in one task, in id order: files are read where they are wanted, nothing is shuffled.

    All files are listed and planned once; a group is that frame held to its files (by ``uris``, as the rows' metadata
    spell them), which Spark prunes to those files before it reads. One statement joins the groups, so it is analysed once."""
    every = read([path for g in groups for path in g]).select("*", F.col("_metadata.file_path").alias("_file"))
    names: dict[str, str] = {}
    tasks = []
    for k, group in enumerate(groups):
        own = {f"g{k}_{i}": uris[path] for i, path in enumerate(group)}
        names |= own
        tasks.append(f"SELECT /*+ COALESCE(1) */ * FROM {{every}} WHERE _file IN ({', '.join(f':{x}' for x in own)})")
    return every.sparkSession.sql(" UNION ALL ".join(tasks), args=names, every=every).drop("_file").sortWithinPartitions(order_col)


@contextmanager
def _one_task_per_group(spark: SparkSession):
    """Unions of one-task frames keep a task for each, instead of joining them to one; without an
    exchange there is nothing to adapt, which would be planned for each of them."""
    keys = ["spark.sql.unionOutputPartitioning", "spark.sql.adaptive.enabled"]
    old = [spark.conf.get(key, "true") for key in keys]
    for key in keys:
        spark.conf.set(key, "false")
    try:
        yield
    finally:
        for key, value in zip(keys, old, strict=True):
            spark.conf.set(key, value)


def compact_files(files: DataFrame, read: Callable[[list[str]], DataFrame], write: Callable[[DataFrame], None], order_col: str,
                  target_bytes: int = 128 << 20, order: Column | str = "path", wave: int = 64) -> int:
    """Consolidate neighbouring files (path, length, file_uri, as ``inventory`` lists them) into files of at most
    ``target_bytes`` (K3) without an exchange: groups come from the inventory alone, each is one task and one file. ``read`` reads a
    list of paths, ``write`` appends rows; ``wave`` groups make one job, so the driver
    holds that many paths and plans at a time. Returns the number of files written."""
    n, waiting = 0, []
    uris: dict[str, str] = {}

    def listed():
        for r in files.orderBy(order, "path").select("path", "length", "file_uri").toLocalIterator():
            uris[r["path"]] = r["file_uri"]
            yield r["path"], r["length"]

    def put(groups: list[list[str]]) -> int:
        write(merged(groups, {path: uris.pop(path) for g in groups for path in g}, read, order_col))
        return len(groups)

    with _one_task_per_group(files.sparkSession):
        for group in neighbour_groups(listed(), target_bytes):
            waiting.append(group)
            if len(waiting) == wave:
                n, waiting = n + put(waiting), []
        if waiting:
            n += put(waiting)
    return n


def publish_partitioned(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet",
                        dynamic: bool = True, sort_col: str | None = None,
                        num_tasks: int | None = None, observation=None) -> None:
    """Published table (K5-K7): files partitioned by column values.

    A rebalance on ``partition_cols`` leaves the number of writer tasks to AQE, which
    sizes them by the bytes that were shuffled: a hot value (one country holding a third
    of the table) is split over many tasks and files, small ones share a task. Rows are
    in ``sort_col`` order inside each file. With ``num_tasks`` given, rows are
    range-partitioned into that many tasks instead, by bounds that a sampling job finds.
    With ``dynamic`` only the partitions present in ``df`` are replaced (K10).
    ``observation`` counts the rows written; it sits above the exchange, because the
    sampling job also runs everything below it.
    """
    keys = [F.col(c) for c in partition_cols] + ([F.col(sort_col)] if sort_col else [])
    out = df.repartitionByRange(num_tasks, *keys) if num_tasks else df.hint("rebalance", *keys[:len(partition_cols)])
    if sort_col:
        out = out.sortWithinPartitions(*keys)
    if observation is not None:
        out = out.observe(observation, F.count("*").alias("n"))
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_cols)
        .format(fmt)
        .save(path))


def table_format(spark: SparkSession, preferred: str = "delta") -> str:
    """Format of the final table zone (K6): ``preferred`` when its data source
    is on the classpath, else partitioned Parquet."""
    try:
        spark.read.format(preferred).load("/")
    except (AnalysisException, Py4JJavaError) as e:
        if "DATA_SOURCE_NOT_FOUND" in str(e):
            return "parquet"
        if isinstance(e, Py4JJavaError):
            raise
    return preferred  # the source is there: it only found no table at the root


def write_format(df: DataFrame, path: str, fmt: str, compression: str | None = None) -> None:
    """Several output formats (K8) with optional compression (K9)."""
    w = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if compression:
        w = w.option("compression", compression)
    try:
        w.save(path)
    except (AnalysisException, Py4JJavaError) as e:
        if "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find" not in str(e):
            raise
        raise ValueError(f"format {fmt!r} needs a module that is not on this session's classpath") from e
