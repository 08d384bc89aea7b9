"""Exact medians and anomalies that outliers cannot hide from (Q7).

A median of integer cents is found by refining a histogram: every round counts, per group, the rows in
``CELLS`` equal cells of the interval that is known to hold the middle rank, and goes on inside one
cell. The interval shrinks ``CELLS``-fold, so four rounds do for amounts of 12 digits,
whatever the number of rows; a round shuffles counts and the driver holds two intervals per group
(groups are the operation types and one for all others). Rows never meet in a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.operators.quality import OTHER, rule_group

CELLS = 1024
GROUPS = [*model.OPERATION_TYPES, OTHER]


def _at(values: dict[str, int], group: Column) -> Column:
    """The group's value, as a literal map of at most 20 entries."""
    return F.try_element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("bigint"))]), group)


def double_medians(df: DataFrame, group: Column, value: Column) -> dict[str, int]:
    """Twice the median of an integer ``value`` for each group of ``GROUPS`` that has any: the sum of
    the two middle values (of an odd count: twice the one)."""
    rows = df.select(group.alias("g"), value.cast("bigint").alias("v")).filter("v is not null")
    first = {r["g"]: r for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    # Two targets per group: the lower and the upper middle; each an interval and the rank inside it.
    lo = [{g: r["lo"] for g, r in first.items()} for _ in range(2)]
    hi = [{g: r["hi"] for g, r in first.items()} for _ in range(2)]
    rank = [{g: (r["n"] - 1) // 2 for g, r in first.items()}, {g: r["n"] // 2 for g, r in first.items()}]
    while any(lo[t][g] < hi[t][g] for t in range(2) for g in first):
        step = [{g: (hi[t][g] - lo[t][g]) // CELLS + 1 for g in first} for t in range(2)]
        cells = []
        for t in range(2):
            low, high = _at(lo[t], F.col("g")), _at(hi[t], F.col("g"))
            cells.append(F.struct(F.lit(t).alias("t"), F.when(F.col("v").between(low, high), F.floor((F.col("v") - low) / _at(step[t], F.col("g")))).alias("cell")))
        found = rows.select("g", F.inline(F.array(*cells))).filter("cell is not null").groupBy("g", "t", "cell").agg(F.count("*").alias("n")).collect()
        for r in sorted(found, key=lambda r: r["cell"]):
            t, g = r["t"], r["g"]
            if rank[t][g] < 0 or lo[t][g] == hi[t][g]:
                continue  # already decided in this round, or before
            if rank[t][g] < r["n"]:
                base = lo[t][g] + r["cell"] * step[t][g]
                lo[t][g], hi[t][g], rank[t][g] = base, min(base + step[t][g] - 1, hi[t][g]), -1 - rank[t][g]
            else:
                rank[t][g] -= r["n"]
        rank = [{g: (-1 - k if k < 0 else k) for g, k in ranks.items()} for ranks in rank]
    return {g: lo[0][g] + lo[1][g] for g in first}


def anomalies_mad(df: DataFrame, threshold: int = 35) -> DataFrame:
    """Rows further from their type's median than ``threshold`` tenths of the robust deviation (median
    absolute deviation over 0.6745), with ``median2_cents`` (twice the median) and ``mad4_cents`` (four times the
    deviation's median). Integers throughout; a group whose deviation is 0 has every other amount as an anomaly."""
    group = rule_group(F.col("type_op"))
    middle = double_medians(df, group, F.col("cents"))
    if not middle:
        return df.limit(0).withColumns({"median2_cents": F.lit(0).cast("bigint"), "mad4_cents": F.lit(0).cast("bigint")})
    off = F.abs(F.lit(2) * F.col("cents") - _at(middle, group))
    spread = double_medians(df, group, off)
    marked = df.withColumns({"median2_cents": _at(middle, group), "mad4_cents": _at(spread, group)})
    wide = lambda c: c.cast("decimal(38,0)")
    far = wide(off) * F.lit(2 * 6745) > wide(F.col("mad4_cents")) * F.lit(1000 * threshold)
    return marked.filter(F.coalesce(far, F.lit(False)))
