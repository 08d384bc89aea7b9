"""Alerts over the runs of a metrics table: a lasting change, not one bad run (Q8).

A one-sided CUSUM per metric: what a run lies above its baseline (the mean of the first ``warmup`` runs)
and an allowed ``slack`` is added up, never below 0; beyond ``limit`` the run raises an alert. The
recursion ``s = max(0, s + x)`` is a running sum less its running least value, so it is two
windows over the runs of a metric. Values are integers (breaches per million), so it is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MILLION = 1_000_000


def cusum_alerts(metrics: DataFrame, key: str = "rule", order: str = "run", warmup: int = 4, slack: int = 2000, limit: int = 10_000) -> DataFrame:
    """``metrics(key, order, n_checked, n_breaches)`` with ``per_million``, ``baseline``, ``cusum`` and ``alert``.
    Runs without checked rows add nothing; warm-up runs raise no alert."""
    runs = Window.partitionBy(key).orderBy(order)
    so_far = runs.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rate = F.when(F.col("n_checked") > 0, F.floor(F.col("n_breaches") * F.lit(MILLION) / F.col("n_checked"))).cast("bigint")
    m = metrics.withColumns({"per_million": rate, "_no": F.row_number().over(runs)})
    first = F.when(F.col("_no") <= warmup, F.col("per_million"))
    whole = Window.partitionBy(key)
    m = m.withColumn("baseline", F.floor(F.sum(first).over(whole) / F.count(first).over(whole)).cast("bigint"))
    step = F.when((F.col("_no") > warmup) & F.col("per_million").isNotNull(), F.col("per_million") - F.col("baseline") - slack).otherwise(0)
    m = m.withColumn("_sum", F.sum(step).over(so_far))
    m = m.withColumn("cusum", F.col("_sum") - F.least(F.min("_sum").over(so_far), F.lit(0)))
    return m.withColumn("alert", F.col("cusum") > limit).drop("_no", "_sum")
