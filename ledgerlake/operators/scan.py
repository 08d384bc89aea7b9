"""Running values along a global order, in parts.

A window without a partition would pass all rows through one task. Here rows are sorted by
range into tasks, every task's part is scanned on its own, and a small table with one row per
task carries sums, greatest values and next keys over the tasks' borders.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path


def ordered_scan(df: DataFrame, key: str, sums: dict[str, str] | None = None, greatest: dict[str, str] | None = None, following: str | None = None) -> DataFrame:
    """``df`` with running values in the order of ``key`` (ties see each other): ``sums`` and ``greatest`` map a new
    column to the one it runs over; ``following`` names a column for the next larger key."""
    sums, greatest = sums or {}, greatest or {}
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "scan")
    df.repartitionByRange(key).select("*", F.spark_partition_id().alias("_part")).write.parquet(path)
    rows = spark.read.parquet(path)  # written, so that a part is the same set of rows whoever reads it
    parts = [r.asDict() for r in rows.groupBy("_part").agg(
        F.min(key).alias("_key"), *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in greatest.items()]).collect()]
    carry: list[dict] = []
    so_far: dict = dict.fromkeys(sums, 0) | dict.fromkeys(greatest)
    for p in sorted(parts, key=lambda p: p["_part"]):  # one row per task
        carry.append({"_p": p["_part"], **{f"_before_{n}": so_far[n] for n in so_far}})
        for n in sums:
            so_far[n] += p[n] or 0
        for n in greatest:
            so_far[n] = max((v for v in (so_far[n], p[n]) if v is not None), default=None)
    upcoming = None
    for c, p in zip(reversed(carry), sorted(parts, key=lambda p: -p["_part"]), strict=True):
        c["_next"], upcoming = upcoming, p["_key"]
    types = {n: "decimal(38,0)" for n in sums} | {n: dict(rows.dtypes)[c] for n, c in greatest.items()}
    ddl = ", ".join(["_p int", *[f"_before_{n} {t}" for n, t in types.items()], f"_next {dict(rows.dtypes)[key]}"])
    made = [tuple(Decimal(c[f"_before_{n}"]) if n in sums else c[f"_before_{n}"] for n in types) for c in carry]
    before = spark.createDataFrame([(c["_p"], *m, c["_next"]) for c, m in zip(carry, made, strict=True)], ddl)
    run = Window.partitionBy("_part").orderBy(key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(F.broadcast(before), F.col("_part") == F.col("_p"), "left")
    new = {n: (F.coalesce(F.sum(c).over(run), F.lit(0)) + F.col(f"_before_{n}")).cast("bigint") for n, c in sums.items()}
    new |= {n: F.greatest(F.max(c).over(run), F.col(f"_before_{n}")) for n, c in greatest.items()}
    if following:  # from the greatest key down, so that the frame grows: one that shrinks is computed anew for every row
        above = Window.partitionBy("_part").orderBy(F.desc(key)).rangeBetween(Window.unboundedPreceding, -1)
        new[following] = F.coalesce(F.min(key).over(above), F.col("_next"))
    return out.withColumns(new).select(*df.columns, *new)
