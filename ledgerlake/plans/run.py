"""The whole job, stage by stage, with its metrics.

generate + land raw CSV -> parse and type (quarantine split) -> one row per
id -> publish the days of the run -> contract report. Each stage is one Spark
job writing to its zone through the commit protocol, so a lost executor only
re-runs its tasks (every draw is a pure function of the row index). Row counts
come from ``Observation`` metrics collected while the stage writes, not from a
second pass. Finished stages are on a ledger: a run that failed is repeated with
the same ``run_id`` and goes on where it stopped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.operators import ingest as I
from ledgerlake.operators import quality as Q
from ledgerlake.operators.dedupe import keep_first
from ledgerlake.plans.ledger import Ledger
from ledgerlake.sinks import layout as L
from ledgerlake.sinks import versions as V
from ledgerlake.sources.generate import index_range, movements, raw_columns
from ledgerlake.sources.raw import read_raw, with_source_file


def _run_label() -> str:
    """Run label from the clock."""
    return "mouvements-" + datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")


@dataclass(frozen=True)
class JobConfig:
    base: str
    n_rows: int
    n_shards: int | None = None  # default: by rows_per_file
    rows_per_file: int = model.ROWS_PER_SHARD
    seed: int = 42
    labels: str = "ascii"
    start_date: str = model.START_DATE
    days: int = model.DATE_RANGE_DAYS
    run_id: str = field(default_factory=_run_label)

    @property
    def shards(self) -> int:
        return self.n_shards or model.shard_count(self.n_rows, self.rows_per_file)

    @property
    def paths(self) -> model.LakePaths:
        return model.LakePaths(self.base)

    @property
    def first_day(self) -> dt.date:
        return dt.date.fromisoformat(self.start_date)

    @property
    def last_day(self) -> dt.date:
        return self.first_day + dt.timedelta(days=self.days - 1)


def run_job(spark: SparkSession, cfg: JobConfig, index: DataFrame | None = None, hook: Callable[[str, str], None] | None = None) -> DataFrame:
    """Run all stages that are not on the run's ledger. Raw, staging and metrics folders belong to the
    ``run_id``; the published table has the run's days replaced, other days and months as they were."""
    p = cfg.paths
    raw, parsed, metrics = f"{p.raw}/{cfg.run_id}", f"{p.staging}/{cfg.run_id}", f"{p.metrics}/run_id={cfg.run_id}"
    settings = {k: getattr(cfg, k) for k in ("n_rows", "seed", "labels", "start_date", "days")} | {"shards": cfg.shards}
    ledger = Ledger(spark, p.ledger, cfg.run_id, settings, hook)

    def land() -> dict[str, int]:
        """Generate and land (S1-S2, P1-P12, K1-K2, K4): no shuffle."""
        gen = movements(index_range(spark, cfg.n_rows, cfg.shards) if index is None else index, seed=cfg.seed, labels=cfg.labels,
                        start_date=cfg.start_date, days=cfg.days)
        seen = Observation()
        L.write_csv(raw_columns(gen).observe(seen, F.count("*").alias("n")), raw, mode="overwrite")
        return V.observed(seen, "n")

    def parse() -> dict[str, int]:
        """Parse and type; good and quarantined rows in one write."""
        typed = I.type_movements(with_source_file(read_raw(spark, raw, shape=True, recursive=True)))
        seen = Observation()
        (typed.observe(seen, F.count("*").alias("n"), F.count_if(F.col("reason") != I.OK).alias("bad"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("reason").parquet(parsed))
        return V.observed(seen, "n", "bad")

    def publish() -> dict[str, int]:
        """One row per id; the run's days of the table replaced."""
        good = spark.read.parquet(parsed).filter(F.col("reason") == I.OK)
        one = keep_first(good, "mouvement_no", list(model.COLUMNS)).select(*[f.name for f in model.STAGED_SCHEMA.fields])
        snap, n = V.publish_days(one, p.tables, cfg.first_day, cfg.last_day, cfg.run_id)
        return {"n": n, "snapshot": snap.seq}

    def report() -> dict[str, int]:
        """Contract report over the published days, one folder of metrics per run (Q6, Q8)."""
        seq = ledger.records[-1].counts["snapshot"]
        table = V.read_months(spark, p.tables, seq, list(V.months_between(cfg.first_day, cfg.last_day)))
        mine = table.filter(F.col("date_op").between(F.lit(cfg.first_day), F.lit(cfg.last_day))).withColumn("cents", (F.col("montant") * 100).cast("bigint"))
        seen = Observation()
        (Q.contract_report(mine, cfg.start_date, cfg.days).observe(seen, F.count("*").alias("n"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(metrics))
        return V.observed(seen, "n")

    ledger.stage("land_raw", raw, land)
    ledger.stage("parse_typed", parsed, parse)
    ledger.stage("publish", p.tables, publish)
    ledger.stage("contract_report", metrics, report)

    rows = [(cfg.run_id, r.stage, r.output, r.counts["n"], r.seconds, r.attempt) for r in ledger.records]
    rows += [(cfg.run_id, "quarantined", f"{r.output}/reason=*", r.counts["bad"], 0.0, r.attempt) for r in ledger.records if "bad" in r.counts]
    df = spark.createDataFrame(rows, "run_id string, stage string, zone string, n_rows long, seconds double, attempt int")
    # Throughput (Q2, A3): rows per second, NULL for stages with no clock.
    return df.withColumn("rows_per_sec", F.try_divide(F.col("n_rows").cast("double"),
                                                      F.when(F.col("seconds") > 0, F.col("seconds"))))
