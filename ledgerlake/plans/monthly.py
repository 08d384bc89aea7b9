"""Catalogue of the monthly job: versions of published months, resumed runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans import oracle as O
from ledgerlake.plans.catalogue import N_SQL, ROWS_PER_FILE, SEED, dealt_index, n_orders, orders, register
from ledgerlake.plans.files import _staged
from ledgerlake.session import scratch_path
from ledgerlake.sinks import versions as V
from ledgerlake.sources.generate import movements


# --- K6 K10: months with versions ---------------------------------------------------
# Four runs: June; a smaller June (half the rows); 30 days from 20 June; July. The table is
# read after each, by its snapshot, when all are done.
RUNS = [("2025-06-01", 30, 1, 1), ("2025-06-01", 30, 2, 2), ("2025-06-20", 30, 3, 1), ("2025-07-01", 31, 4, 1)]


def _month_versions_sql() -> str:
    ctes = []
    for k, (start, days, seed, part) in enumerate(RUNS, 1):
        keys = "(SELECT o_orderkey AS i FROM orders)" if part == 1 else f"(SELECT o_orderkey AS i FROM orders WHERE o_orderkey < {N_SQL} // {part})"
        ctes += O.movements_ctes(f"r{k}", keys, seed=seed, start_date=start, days=days)
    ctes.append("""live AS (SELECT 1 AS snapshot, * FROM r1 UNION ALL SELECT 2, * FROM r2
        UNION ALL SELECT 3, * FROM r2 WHERE date_op < DATE '2025-06-20' UNION ALL SELECT 3, * FROM r3
        UNION ALL SELECT 4, * FROM r2 WHERE date_op < DATE '2025-06-20' UNION ALL SELECT 4, * FROM r3 WHERE date_op < DATE '2025-07-01' UNION ALL SELECT 4, * FROM r4)""")
    return O.with_(ctes, "SELECT CAST(snapshot AS BIGINT) AS snapshot, strftime(date_op, '%Y-%m') AS mois, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, "
                         "min(mouvement_no) AS min_no, max(mouvement_no) AS max_no, min(date_op) AS first_day, max(date_op) AS last_day FROM live GROUP BY 1, 2")


@register("month_versions", _month_versions_sql())
def month_versions(spark, sf):
    root, n = scratch_path(spark, "versions"), n_orders(spark, sf)
    keys = orders(spark, sf).select(F.col("o_orderkey").alias("i"))
    seqs = []
    for k, (start, days, seed, part) in enumerate(RUNS, 1):
        index = keys if part == 1 else keys.filter(F.col("i") < n // part)  # the smaller June is a table of its own
        first = dt.date.fromisoformat(start)
        rows = _staged(movements(index, seed=seed, start_date=start, days=days))
        seqs.append(V.publish_days(rows, root, first, first + dt.timedelta(days=days - 1), f"run{k}")[0].seq)
    out: DataFrame | None = None
    for seq in seqs:
        t = V.read_months(spark, root, seq).withColumn("snapshot", F.lit(seq).cast("bigint"))
        got = t.groupBy("snapshot", "mois").agg(
            F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"), F.min("mouvement_no").alias("min_no"),
            F.max("mouvement_no").alias("max_no"), F.min("date_op").alias("first_day"), F.max("date_op").alias("last_day"))
        out = got if out is None else out.unionByName(got)
    return out


# --- X3: a run that fails after every stage, and goes on ----------------------------

class _Killed(RuntimeError):
    pass


STAGES = ("land_raw", "parse_typed", "publish", "contract_report")


@register("run_resume", O.with_(O.orders_movements(), f"""SELECT * FROM (
  SELECT stage, CASE stage WHEN 'quarantined' THEN 0 WHEN 'contract_report' THEN 9 ELSE {N_SQL} END AS n_rows, 2 AS attempts, NULL::BIGINT AS sum_cents
  FROM (VALUES {', '.join(f"('{s}')" for s in (*STAGES, 'quarantined'))}) AS t(stage)
  UNION ALL SELECT 'published_table', count(*), 1, CAST(sum(cents) AS BIGINT) FROM mv
  UNION ALL SELECT 'metrics_table', 9, 1, NULL) AS r"""))
def run_resume(spark, sf):
    """Killed once when a stage's output is written and once when it is on record, and started again
    each time: every stage ran twice (not once per start), nothing is there twice."""
    from ledgerlake.plans.run import JobConfig, run_job
    cfg = JobConfig(base=scratch_path(spark, "lake_resume"), n_rows=n_orders(spark, sf), seed=SEED, run_id="resumed", rows_per_file=ROWS_PER_FILE)
    index = dealt_index(spark, sf, cfg.n_rows, cfg.shards)
    due = {(stage, moment) for stage in STAGES for moment in ("written", "committed")}

    def hook(stage, moment):
        if (stage, moment) in due:
            due.remove((stage, moment))
            raise _Killed(f"{stage} {moment}")

    while True:
        try:
            done = run_job(spark, cfg, index, hook)
            break
        except _Killed:
            continue
    table = V.read_months(spark, cfg.paths.tables).agg(F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"))
    metrics = spark.read.parquet(cfg.paths.metrics).agg(F.count("*").alias("n_rows"))
    none = F.lit(None).cast("bigint")
    return (done.select("stage", "n_rows", F.col("attempt").alias("attempts"), none.alias("sum_cents"))
            .unionByName(table.select(F.lit("published_table").alias("stage"), "n_rows", F.lit(1).alias("attempts"), "sum_cents"))
            .unionByName(metrics.select(F.lit("metrics_table").alias("stage"), "n_rows", F.lit(1).alias("attempts"), none.alias("sum_cents"))))
