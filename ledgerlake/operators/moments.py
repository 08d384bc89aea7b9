"""Statistics as state that merges (Q5).

A month's state has one row per group: count, least, greatest, exact sums of cents and squares, a KLL
sketch of the amounts and an HLL sketch of a label. Months are merged by adding and by merging sketches, in any
grouping, without reading rows again; moments come out the same as over all rows at once.

The deviation is taken from the sums without cancelling: with ``q`` and ``r`` the quotient and the rest of
sum and count, the squares around ``q`` are an exact integer, and only that is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def exact_deviation(stats: DataFrame) -> DataFrame:
    """``mean_cents`` and ``sd_cents`` of n_rows, sum_cents, sum_sq_cents (null below two rows). Exact up to one
    rounding of each part; sums fit for up to 10**13 rows of 12 digits."""
    n, total, squares = (F.col(c).cast(EXACT) for c in ("n_rows", "sum_cents", "sum_sq_cents"))
    some = stats.withColumn("__r", F.when(F.col("n_rows") > 0, F.pmod(total, n)).cast(EXACT))
    some = some.withColumn("__q", F.try_divide(total - F.col("__r"), n).cast(EXACT))
    q = F.col("__q")
    around = squares - (F.lit(2).cast(EXACT) * q * total).cast(EXACT) + (n * q * q).cast(EXACT)
    rest = F.col("__r").cast("double")
    count = F.col("n_rows").cast("double")
    spread = around.cast(EXACT).cast("double") - F.try_divide(rest * rest, count)
    return some.withColumns({"mean_cents": F.try_divide(total.cast("double"), count), "sd_cents": F.sqrt(F.try_divide(spread, count - F.lit(1.0)))}).drop("__r", "__q")


def month_state(df: DataFrame, keys: list[str], cents: str = "cents", label: str = "agence_id") -> DataFrame:
    """One row of state per ``keys``."""
    c = F.col(cents)
    return df.groupBy(*keys).agg(
        F.count(c).alias("n_rows"), F.min(c).alias("min_cents"), F.max(c).alias("max_cents"), F.sum(c.cast(EXACT)).cast(EXACT).alias("sum_cents"),
        F.sum((c.cast("decimal(19,0)") * c.cast("decimal(19,0)")).cast(EXACT)).cast(EXACT).alias("sum_sq_cents"),
        F.kll_sketch_agg_bigint(c).alias("amounts"), F.hll_sketch_agg(label).alias("labels"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of months (or of parts of one) merged into one per ``keys``."""
    return states.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.min("min_cents").alias("min_cents"), F.max("max_cents").alias("max_cents"), F.sum("sum_cents").cast(EXACT).alias("sum_cents"),
        F.sum("sum_sq_cents").cast(EXACT).alias("sum_sq_cents"), F.kll_merge_agg_bigint("amounts").alias("amounts"), F.hll_union_agg("labels").alias("labels"))


def report(states: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Figures of states: exact moments, sketched quantiles (``q25_cents``, ...) and distinct labels."""
    q = {f"q{round(100 * p)}_cents": F.when(F.col("n_rows") > 0, F.kll_sketch_get_quantile_bigint("amounts", F.lit(p))) for p in quantiles}
    return exact_deviation(states).withColumns(q | {"n_labels": F.hll_sketch_estimate("labels")}).drop("amounts", "labels", "sum_sq_cents")


def rank_error(cents: Column, sketch: Column, true_rank: Column) -> Column:
    """Distance between a sketch's rank of a value and the true one."""
    return F.abs(F.kll_sketch_get_rank_bigint(sketch, cents) - true_rank)
