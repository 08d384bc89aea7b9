"""Deterministic generation of the ``mouvements`` table.

A row is a pure function of its 0-based index ``i`` and the seed, so the same
rows come out for any partitioning, on any retry of a lost task, and from
DuckDB for the oracle. The plan is one scan (or ``Range``) followed by
projections: no shuffle, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions import draws as D
from ledgerlake.functions.columns import cents_to_amount, format_id, pick_from, pick_int

LABEL_SETS = {
    "ascii": (model.PRODUCTS, model.OPERATION_TYPES),
    "accented": (model.PRODUCTS_ACCENTED, model.OPERATION_TYPES_ACCENTED),
}


def index_range(spark: SparkSession, n: int, num_partitions: int | None = None, start: int = 0) -> DataFrame:
    """Dense index ``start .. start+n-1`` (S1/S2). Partition ``p`` holds a
    contiguous interval; the remainder is spread, never dropped (H5)."""
    if not num_partitions:
        try:
            num_partitions = max(1, spark.sparkContext.defaultParallelism)
        except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext)
            num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.range(start, start + n, 1, num_partitions).withColumnRenamed("id", "i")


def chunked_index(spark: SparkSession, n: int, chunk_size: int, start: int = 0) -> DataFrame:
    """Index cut into ``ceil(n / chunk_size)`` tasks (S3): one task per chunk."""
    return index_range(spark, n, max(1, math.ceil(n / chunk_size)), start)


def index_from_table(df: DataFrame, col: str) -> DataFrame:
    """Use a dense 0-based key of an existing table as the row counter."""
    return df.select(F.col(col).cast("bigint").alias("i"))


def movements(
    index: DataFrame,
    seed: int = 42,
    labels: str = "ascii",
    start_date: str = model.START_DATE,
    days: int = model.DATE_RANGE_DAYS,
    id_offset: int = 0,
    index_col: str = "i",
    extra_draws: tuple[int, ...] = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Generate movement rows for every index value.

    Returns ``mouvement_no, id_mouvement, date_op, produit, type_op, type_ord,
    cents, montant, agence_id, pays`` plus ``h<c>`` for ``extra_draws`` and the
    ``keep`` columns of the input.
    """
    products, types = LABEL_SETS[labels]
    hashed = D.with_hashes(
        index.select(index_col, *keep), index_col, seed, D.MOVEMENT_DRAWS + tuple(extra_draws)
    )
    typed = hashed.select(
        "*",
        (F.col(index_col) + F.lit(1 + id_offset)).alias("mouvement_no"),
        D.pick("h3", len(types)).alias("type_ord"),
    )
    t = F.col("type_ord")
    lo = pick_int([b[0] for b in model.AMOUNT_BOUNDS_CENTS], t)
    hi = pick_int([b[1] for b in model.AMOUNT_BOUNDS_CENTS], t)
    staged = typed.select("*", (lo + D.pick("h4", hi - lo + F.lit(1))).alias("cents"))
    return staged.select(
        "mouvement_no",
        format_id(F.col("mouvement_no")).alias("id_mouvement"),
        F.date_add(F.to_date(F.lit(start_date)), D.pick("h1", days).cast("int")).alias("date_op"),
        pick_from(products, D.pick("h2", len(products))).alias("produit"),
        pick_from(types, F.col("type_ord")).alias("type_op"),
        "type_ord",
        "cents",
        cents_to_amount("cents").alias("montant"),
        pick_from(model.AGENCIES, D.pick("h5", model.AGENCY_COUNT)).alias("agence_id"),
        pick_from(model.COUNTRIES, D.pick("h6", len(model.COUNTRIES))).alias("pays"),
        *[f"h{c}" for c in extra_draws],
        *keep,
    )


def raw_columns(df: DataFrame) -> DataFrame:
    """The seven landed columns, in file order."""
    return df.select(*model.COLUMNS)


def movements_from_orders(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Movements with ``orders.o_orderkey`` (dense from 0) as the row counter."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return movements(index_from_table(orders, "o_orderkey"), **kw)
