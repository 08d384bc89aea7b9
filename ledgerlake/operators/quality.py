"""Counts, contracts, statistics, samples and anomalies (Q1-Q8, A1-A3, O3).

Aggregates are computed on exact integer cents, so results do not depend on
the order in which partial sums meet. Every grouped statistic is a hash
aggregate with map-side partial aggregation: a hot key (one type holding a
third of all rows) is reduced inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions import draws as D
from ledgerlake.operators.moments import exact_deviation

# Literal maps: a lookup without any join. Size fixed by ``model``.
def _bound_map(pos: int) -> Column:
    return F.create_map(*[x for t, b in zip(model.OPERATION_TYPES, model.AMOUNT_BOUNDS_CENTS)
                          for x in (F.lit(t), F.lit(b[pos]).cast("bigint"))])


OTHER = "__other__"


def rule_lo(label: Column) -> Column:
    """Low bound in cents of the amount rule for a (folded) label."""
    return F.coalesce(F.try_element_at(_bound_map(0), label), F.lit(model.DEFAULT_BOUNDS_CENTS[0]).cast("bigint"))


def rule_hi(label: Column) -> Column:
    return F.coalesce(F.try_element_at(_bound_map(1), label), F.lit(model.DEFAULT_BOUNDS_CENTS[1]).cast("bigint"))


def rule_group(label: Column) -> Column:
    """Known label, else one shared bucket: at most 20 groups whatever the data."""
    return F.when(label.isin(*model.OPERATION_TYPES), label).otherwise(F.lit(OTHER))


def rows_per_file(df: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Rows per file and the grand total in one pass (Q1, A1, A2): a rollup,
    whose total row has ``file_col`` NULL."""
    return df.rollup(file_col).agg(F.count("*").alias("n_rows"))


def contract_report(df: DataFrame, start_date: str = model.START_DATE,
                    days: int = model.DATE_RANGE_DAYS) -> DataFrame:
    """One row per rule: ``rule, n_checked, n_breaches`` (Q6).

    The row rules are one global aggregate without a shuffle by key; a second, pruned
    scan shuffles ids alone for uniqueness and gaps.
    Domain checks are ``IN`` lists of fixed domains, so no join at all.
    """
    end = F.date_add(F.to_date(F.lit(start_date)), days - 1)
    c = F.col
    flags = {
        "produit_domain": ~F.coalesce(c("produit").isin(*model.PRODUCTS), F.lit(False)),
        "type_op_domain": ~F.coalesce(c("type_op").isin(*model.OPERATION_TYPES), F.lit(False)),
        "agence_domain": ~F.coalesce(c("agence_id").isin(*model.AGENCIES), F.lit(False)),
        "pays_domain": ~F.coalesce(c("pays").isin(*model.COUNTRIES), F.lit(False)),
        "date_window": ~F.coalesce(c("date_op").between(F.to_date(F.lit(start_date)), end), F.lit(False)),
        "amount_bounds": ~F.coalesce(c("cents").between(rule_lo(c("type_op")), rule_hi(c("type_op"))), F.lit(False)),
    }
    rules = df.agg(F.count("*").alias("n_rows"), *[F.count_if(v).alias(k) for k, v in flags.items()])
    per_id = df.groupBy("mouvement_no").agg(F.count("*").alias("n"))
    ids = per_id.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(c("mouvement_no").isNull(), c("n")).otherwise(0)).alias("id_parse"),
        F.sum(F.when(c("mouvement_no").isNotNull(), c("n") - 1).otherwise(0)).alias("id_unique"),
        (F.max("mouvement_no") - F.min("mouvement_no") + 1 - F.count("mouvement_no")).alias("id_gaps"),
    )

    def stacked(one: DataFrame, names: list[str]) -> DataFrame:
        pairs = ", ".join(f"'{r}', CAST(coalesce({r}, 0) AS BIGINT)" for r in names)
        return one.selectExpr("CAST(coalesce(n_rows, 0) AS BIGINT) AS n_checked", f"stack({len(names)}, {pairs}) AS (rule, n_breaches)")

    return stacked(ids, ["id_parse", "id_unique", "id_gaps"]).unionByName(stacked(rules, list(flags)))


def exact_stats(df: DataFrame, key: Column | str, cents: str = "cents", extra: tuple[Column, ...] = ()) -> DataFrame:
    """Count, min, max, exact sums of cents and squared cents per key."""
    key = F.col(key) if isinstance(key, str) else key
    c = F.col(cents)
    return df.groupBy(key.alias("grp")).agg(
        F.count(c).alias("n_rows"),
        F.min(c).alias("min_cents"),
        F.max(c).alias("max_cents"),
        F.sum(c).alias("sum_cents"),
        F.sum((c.cast("decimal(19,0)") * c.cast("decimal(19,0)")).cast("decimal(38,0)")).alias("sum_sq_cents"),
        *extra,
    )


def stats_by_type(df: DataFrame) -> DataFrame:
    """Statistics per operation type (Q5), exact up to the final division.

    One aggregate: the distinct agency count rides along as Spark's
    single-distinct rewrite, still partially aggregated map-side.
    """
    stats = exact_deviation(exact_stats(df, "type_op", extra=(F.countDistinct("agence_id").alias("n_agencies"),)))
    return stats.select(
        F.col("grp").alias("type_op"), "n_rows", "min_cents", "max_cents",
        F.col("sum_cents").cast("bigint").alias("sum_cents"),
        (F.col("mean_cents") / F.lit(100.0)).alias("avg_montant"),
        (F.col("sd_cents") / F.lit(100.0)).alias("sd_montant"),
        "n_agencies",
    )


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Deterministic sample (Q5): keep rows whose key hash is below a threshold.
    Retry-stable and partition-independent, unlike ``sample``."""
    hashed = D.with_hashes(df, key, seed, [D.C_SAMPLE])
    return hashed.filter(D.below("h9", fraction)).drop("h9")


def anomalies_zscore(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Rows whose amount lies more than ``threshold`` standard deviations from
    the mean of its operation type (Q7).

    The statistics side has one row per ``rule_group`` (at most 20, whatever
    the data), so broadcasting it is bounded; the fact side is never shuffled.
    """
    grp = rule_group(F.col("type_op"))
    stats = exact_deviation(exact_stats(df.withColumn("__g", grp), "__g"))
    joined = df.withColumn("grp", grp).join(F.broadcast(stats.select("grp", "mean_cents", "sd_cents")), "grp")
    z = F.try_divide(F.col("cents").cast("double") - F.col("mean_cents"), F.col("sd_cents"))
    return joined.withColumn("z", z).filter(F.abs(F.col("z")) > F.lit(threshold)).drop("grp", "mean_cents", "sd_cents")


def anomalies_bounds(df: DataFrame) -> DataFrame:
    """Rows whose amount breaks the rule bounds of its type or is missing (Q7, exact)."""
    lo, hi = rule_lo(F.col("type_op")), rule_hi(F.col("type_op"))
    return (df.withColumns({"lo_cents": lo, "hi_cents": hi})
              .filter(~F.coalesce(F.col("cents").between(F.col("lo_cents"), F.col("hi_cents")), F.lit(False))))
