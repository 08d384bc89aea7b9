"""Query catalogue: one Spark builder per operator group, each paired with
the DuckDB statement that computes the same result from the same tables.

Every query derives its rows from the driver tables: ``orders.o_orderkey``
(dense from 0) is the row counter of the generator, so the work of each
query grows with the table. Queries that exercise file sources and sinks
write their landing under a fresh folder of the shared checkpoint directory
and return a DataFrame reading it back.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions import draws as D
from ledgerlake.functions.columns import fold_accents, format_id, parse_id
from ledgerlake.operators import quality as Q
from ledgerlake.plans import oracle as O
from ledgerlake.sources.generate import (
    chunked_index, index_from_table, movements, movements_from_orders, raw_columns,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEED = 42
MV_COLS = ["mouvement_no", "id_mouvement", "date_op", "produit", "type_op", "montant", "agence_id", "pays"]
N_SQL = "(SELECT count(*) FROM orders)"
# The catalogue's landings: rows per file and per chunk task, whatever the table's size.
ROWS_PER_FILE, ROWS_PER_CHUNK = 2000, 1000
# Such files that one writer task makes where each is a folder's own: a task costs more than a file.
FILES_PER_TASK = 16
S_SQL = f"(SELECT greatest(1, CAST(ceil(count(*) / {ROWS_PER_FILE}.0) AS BIGINT)) FROM orders)"
C_SQL = f"{ROWS_PER_CHUNK}"


def shards_of(n: int) -> int:
    return model.shard_count(n, ROWS_PER_FILE)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet")


def n_orders(spark: SparkSession, sf: str) -> int:
    """Row count of ``orders`` (answered from Parquet footers)."""
    return orders(spark, sf).count()


def dealt_index(spark: SparkSession, sf: str, n: int, parts: int, start: int = 0, lo: int | None = None, hi: int | None = None, per_task: int = 1) -> DataFrame:
    """Row counters from all keys of ``orders`` (or those from ``lo`` to below ``hi``), shifted by ``start``: about ``n``
    of them, dealt in contiguous intervals to partitions as ``spark.range`` deals dense ones. Keys beyond those go to the last.
    With ``per_task`` so many neighbouring intervals share a partition, for writers that part them again."""
    from ledgerlake.sinks.layout import shard_of
    keys = orders(spark, sf).select(F.col("o_orderkey").cast("bigint").alias("k"))
    if lo is not None:
        keys = keys.filter(F.col("k") >= lo)
    if hi is not None:
        keys = keys.filter(F.col("k") < hi)
    shard = F.least(shard_of(F.col("k") - (lo or 0), max(n, 1), parts), F.lit(parts - 1)).cast("int")
    if per_task > 1:
        parts, shard = -(-parts // per_task), F.floor(shard / per_task).cast("int")
    dealt = keys.repartitionById(parts, shard).sortWithinPartitions("k")
    return dealt.select((F.col("k") + start).alias("i"))


def mv(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return movements_from_orders(spark, sf, seed=kw.pop("seed", SEED), **kw)


def _cols(cols: list[str]) -> str:
    return ", ".join(cols)


# --- S1 S2 P1-P6 P8-P12: the generator ---------------------------------------

@register("gen_movements", O.with_(O.orders_movements(), f"SELECT {_cols(MV_COLS)} FROM mv"))
def gen_movements(spark, sf):
    return mv(spark, sf).select(*MV_COLS)


# --- S1 S3 F3 M3: chunked index ---------------------------------------------

@register("gen_index", f"""
SELECT i // {C_SQL} AS chunk, min(i) + 1 AS first_no, max(i) + 1 AS last_no, count(*) AS n_rows,
       least((i // {C_SQL} + 1) * {C_SQL}, {N_SQL}) AS end_row
FROM (SELECT unnest(range(0, {N_SQL})) AS i) GROUP BY i // {C_SQL}""")
def gen_index(spark, sf):
    n = n_orders(spark, sf)
    k = ROWS_PER_CHUNK
    idx = index_from_table(orders(spark, sf), "o_orderkey")
    chunk = F.floor(F.col("i") / k).cast("bigint")
    return idx.groupBy(chunk.alias("chunk")).agg(
        (F.min("i") + 1).alias("first_no"), (F.max("i") + 1).alias("last_no"), F.count("*").alias("n_rows"),
    ).withColumn("end_row", F.least((F.col("chunk") + 1) * k, F.lit(n)).cast("bigint"))


# --- S9 S10: dimensions joined to what was generated --------------------------

@register("dim_agencies", O.with_(O.orders_movements() + [
    "ag AS (SELECT i - 1 AS ordinal, printf('AG_%03d', i) AS agence_id FROM range(1, 21) t(i))",
    "cnt AS (SELECT agence_id, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents FROM mv GROUP BY agence_id)",
], "SELECT ag.ordinal, ag.agence_id, coalesce(cnt.n_rows, 0) AS n_rows, cnt.sum_cents "
   "FROM ag LEFT JOIN cnt USING (agence_id)"))
def dim_agencies(spark, sf):
    cnt = mv(spark, sf).groupBy("agence_id").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("sum_cents"))
    return (model.agencies_df(spark).join(cnt, "agence_id", "left")
            .select("ordinal", "agence_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "sum_cents"))


_DOMAINS = [("produit", [*enumerate(model.PRODUCTS)]), ("pays", [*enumerate(model.COUNTRIES)])]


@register("dim_products_countries", O.with_(O.orders_movements() + [
    "dim AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {i}, '{v}')" for k, vs in _DOMAINS for i, v in vs) + ") AS t(kind, ordinal, label))",
    "cnt AS (SELECT 'produit' AS kind, produit AS label, count(*) AS n FROM mv GROUP BY 2 UNION ALL SELECT 'pays', pays, count(*) FROM mv GROUP BY 2)",
], "SELECT kind, CAST(ordinal AS BIGINT) AS ordinal, label, coalesce(n, 0) AS n_rows FROM dim LEFT JOIN cnt USING (kind, label)"))
def dim_products_countries(spark, sf):
    def counted(kind, dim):
        cnt = mv(spark, sf).groupBy(F.col(kind).alias("label")).agg(F.count("*").alias("n"))
        dim = dim.select("ordinal", F.col(kind).alias("label"))
        return dim.join(cnt, "label", "left").select(F.lit(kind).alias("kind"), "ordinal", "label", F.coalesce("n", F.lit(0)).alias("n_rows"))
    return counted("produit", model.products_df(spark)).unionByName(counted("pays", model.countries_df(spark)))


@register("dim_rules", O.with_(O.orders_movements() + [O.rules_cte(),
    "st AS (SELECT type_op, count(*) AS n_rows, min(cents) AS min_cents, max(cents) AS max_cents FROM mv GROUP BY type_op)",
], "SELECT r.type_ord, r.type_op, r.type_op_accented, r.lo_cents, r.hi_cents, coalesce(st.n_rows, 0) AS n_rows, "
   "st.min_cents, st.max_cents, (st.min_cents >= r.lo_cents AND st.max_cents <= r.hi_cents) AS in_bounds "
   "FROM rules r LEFT JOIN st USING (type_op)"))
def dim_rules(spark, sf):
    st = mv(spark, sf).groupBy("type_op").agg(
        F.count("*").alias("n_rows"), F.min("cents").alias("min_cents"), F.max("cents").alias("max_cents"))
    return (model.rules_df(spark).join(st, "type_op", "left")
            .select("type_ord", "type_op", "type_op_accented", "lo_cents", "hi_cents",
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "min_cents", "max_cents",
                    ((F.col("min_cents") >= F.col("lo_cents")) & (F.col("max_cents") <= F.col("hi_cents"))).alias("in_bounds")))


# --- P6 P7: amount rule incl. the else branch ---------------------------------
UNKNOWN_LABEL = "inconnu"
UNKNOWN_SHARE = 0.05


@register("amount_rule_default", O.with_(O.orders_movements(extra_draws=(D.C_PLANT, D.C_AMOUNT)) + [O.rules_cte(),
    f"lb AS (SELECT *, CASE WHEN {D.sql_below('h10', UNKNOWN_SHARE)} THEN '{UNKNOWN_LABEL}' ELSE type_op END AS label FROM mv)",
    "bd AS (SELECT lb.*, coalesce(r.lo_cents, 1000) AS lo, coalesce(r.hi_cents, 100000) AS hi "
    "FROM lb LEFT JOIN rules r ON r.type_op = lb.label)",
], f"SELECT mouvement_no, label AS type_op, lo AS lo_cents, hi AS hi_cents, lo + {D.sql_pick('h4', '(hi - lo + 1)')} AS cents, "
   f"CAST(lo + {D.sql_pick('h4', '(hi - lo + 1)')} AS DOUBLE) / 100.0 AS montant FROM bd"))
def amount_rule_default(spark, sf):
    g = mv(spark, sf, extra_draws=(D.C_PLANT, D.C_AMOUNT))
    label = F.when(D.below("h10", UNKNOWN_SHARE), F.lit(UNKNOWN_LABEL)).otherwise(F.col("type_op"))
    b = g.select("mouvement_no", "h4", label.alias("type_op")).withColumns(
        {"lo_cents": Q.rule_lo(F.col("type_op")), "hi_cents": Q.rule_hi(F.col("type_op"))})
    cents = F.col("lo_cents") + D.pick("h4", F.col("hi_cents") - F.col("lo_cents") + 1)
    return b.select("mouvement_no", "type_op", "lo_cents", "hi_cents", cents.alias("cents"),
                    (cents / F.lit(100.0)).alias("montant"))


# --- P11 R5 H1 H2: ids across the 7/8-digit boundary ---------------------------
ID_OFFSET = 9_999_000


@register("id_boundary", f"""
SELECT o_orderkey + {ID_OFFSET + 1} AS mouvement_no, printf('M%07d', o_orderkey + {ID_OFFSET + 1}) AS id_mouvement,
       CAST(substr(printf('M%07d', o_orderkey + {ID_OFFSET + 1}), 2) AS BIGINT) AS parsed_no,
       CAST(length(printf('M%07d', o_orderkey + {ID_OFFSET + 1})) - 1 AS BIGINT) AS n_digits
FROM orders""")
def id_boundary(spark, sf):
    no = (F.col("o_orderkey") + F.lit(ID_OFFSET + 1)).alias("mouvement_no")
    ids = orders(spark, sf).select(no).withColumn("id_mouvement", format_id("mouvement_no"))
    return ids.select("mouvement_no", "id_mouvement", parse_id("id_mouvement").alias("parsed_no"),
                      (F.length("id_mouvement") - 1).cast("bigint").alias("n_digits"))


# --- S2 P16 P17 M1 M2 M3: shard layout ---------------------------------------

@register("shard_layout", f"""
WITH s AS (SELECT o_orderkey AS i, ((o_orderkey + 1) * {S_SQL} - 1) // {N_SQL} AS shard FROM orders)
SELECT shard, printf('mouvements-%05d-of-%05d.csv', shard, {S_SQL}) AS shard_name,
       printf('mouvements-%02d-of-%02d.csv', shard, {S_SQL}) AS beam_name,
       min(i) + 1 AS first_no, max(i) + 1 AS last_no, count(*) AS n_rows,
       (min(i) % ({N_SQL} // {S_SQL})) = 0 AS starts_on_boundary,
       least((shard + 1) * ({N_SQL} // {S_SQL}), {N_SQL}) - shard * ({N_SQL} // {S_SQL}) AS floor_div_rows
FROM s GROUP BY shard""")
def shard_layout(spark, sf):
    from ledgerlake.sinks.layout import shard_name, shard_of
    n = n_orders(spark, sf)
    shards = shards_of(n)
    k = n // shards
    s = orders(spark, sf).select(F.col("o_orderkey").alias("i"), shard_of("o_orderkey", n, shards).alias("shard"))
    agg = s.groupBy("shard").agg((F.min("i") + 1).alias("first_no"), (F.max("i") + 1).alias("last_no"),
                                 F.count("*").alias("n_rows"), F.min("i").alias("first_i"))
    return agg.select(
        "shard", shard_name(F.col("shard"), shards).alias("shard_name"),
        shard_name(F.col("shard"), shards, beam=True).alias("beam_name"),
        "first_no", "last_no", "n_rows",
        (F.pmod(F.col("first_i"), F.lit(k)) == 0).alias("starts_on_boundary"),
        (F.least((F.col("shard") + 1) * k, F.lit(n)) - F.col("shard") * k).cast("bigint").alias("floor_div_rows"),
    )


# --- P15 R6: accent folding ---------------------------------------------------

@register("fold_labels", O.with_(O.orders_movements(labels="accented"),
    "SELECT mouvement_no, produit AS produit_raw, type_op AS type_op_raw, "
    "strip_accents(produit) AS produit, strip_accents(type_op) AS type_op FROM mv"))
def fold_labels(spark, sf):
    g = mv(spark, sf, labels="accented")
    return g.select("mouvement_no", F.col("produit").alias("produit_raw"), F.col("type_op").alias("type_op_raw"),
                    fold_accents("produit").alias("produit"), fold_accents("type_op").alias("type_op"))


# Folding of free French text: fixed character map (one character to one
# character) plus the two ligatures.
TEXT_FOLD_FROM = "àâäçéèêëîïôöùûüÿÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸ"
TEXT_FOLD_TO = "aaaceeeeiioouuuyAAACEEEEIIOOUUUY"
LIGATURES = [("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE")]


def _sql_fold_text(col: str) -> str:
    expr = f"translate({col}, '{TEXT_FOLD_FROM}', '{TEXT_FOLD_TO}')"
    for a, b in LIGATURES:
        expr = f"replace({expr}, '{a}', '{b}')"
    return expr


@register("fold_french_text", f"""
SELECT doc_id, lang, {_sql_fold_text('text')} AS text_folded,
       CAST(length(text) - length(regexp_replace(text, '[{TEXT_FOLD_FROM}{''.join(a for a, _ in LIGATURES)}]', '', 'g')) AS BIGINT) AS n_folded
FROM documents""")
def fold_french_text(spark, sf):
    """Accent folding over whole documents (every language; non-French text
    passes through unchanged apart from the mapped characters)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    folded = F.translate("text", TEXT_FOLD_FROM, TEXT_FOLD_TO)
    for a, b in LIGATURES:
        folded = F.replace(folded, F.lit(a), F.lit(b))
    chars = TEXT_FOLD_FROM + "".join(a for a, _ in LIGATURES)
    n = F.length("text") - F.length(F.regexp_replace("text", f"[{chars}]", ""))
    return docs.select("doc_id", "lang", folded.alias("text_folded"), n.cast("bigint").alias("n_folded"))


# --- Q5: statistics, sample, preview ------------------------------------------

def _sql_mean_sd(src: str, key: str) -> str:
    return (f"SELECT {key} AS grp, count(cents) AS n_rows, min(cents) AS min_cents, max(cents) AS max_cents, "
            f"sum(cents) AS sum_cents, sum(CAST(cents AS HUGEINT) * cents) AS sum_sq_cents FROM {src} GROUP BY {key}")


# Squares around the integer quotient of sum and count, in integers; only their rounding is in doubles.
_SQL_R = "(((sum_cents % n_rows) + n_rows) % n_rows)"
_SQL_Q = f"((sum_cents - {_SQL_R}) // n_rows)"
_SQL_SD = (f"sqrt((CAST(sum_sq_cents - 2 * {_SQL_Q} * sum_cents + n_rows * {_SQL_Q} * {_SQL_Q} AS DOUBLE) "
           f"- CAST({_SQL_R} AS DOUBLE) * CAST({_SQL_R} AS DOUBLE) / CAST(n_rows AS DOUBLE)) / (CAST(n_rows AS DOUBLE) - 1.0))")
_SQL_MEAN = "(CAST(sum_cents AS DOUBLE) / CAST(n_rows AS DOUBLE))"


@register("stats_by_type", O.with_(O.orders_movements() + [
    "st AS (SELECT type_op AS grp, count(cents) AS n_rows, min(cents) AS min_cents, max(cents) AS max_cents, "
    "sum(cents) AS sum_cents, sum(CAST(cents AS HUGEINT) * cents) AS sum_sq_cents, "
    "count(DISTINCT agence_id) AS n_agencies FROM mv GROUP BY type_op)"],
    f"SELECT grp AS type_op, n_rows, min_cents, max_cents, CAST(sum_cents AS BIGINT) AS sum_cents, "
    f"{_SQL_MEAN} / 100.0 AS avg_montant, {_SQL_SD} / 100.0 AS sd_montant, n_agencies FROM st"))
def stats_by_type(spark, sf):
    return Q.stats_by_type(mv(spark, sf))


SAMPLE_FRACTION = 0.05


@register("sample_hash", O.with_(
    O.orders_movements() + D.sql_hash_ctes("sp", "mv", "mouvement_no", SEED, [D.C_SAMPLE]),
    f"SELECT {_cols(MV_COLS)} FROM sp_h WHERE {D.sql_below('h9', SAMPLE_FRACTION)}"))
def sample_hash(spark, sf):
    return Q.sample_by_hash(mv(spark, sf).select(*MV_COLS), "mouvement_no", SAMPLE_FRACTION, SEED)


PREVIEW_ROWS = 20


@register("preview", O.with_(O.orders_movements(),
    f"SELECT {_cols(MV_COLS)} FROM mv ORDER BY mouvement_no LIMIT {PREVIEW_ROWS}"))
def preview(spark, sf):
    from ledgerlake.sources.raw import head
    return head(mv(spark, sf).select(*MV_COLS), PREVIEW_ROWS)


# --- Q6 Q7: contracts and anomalies over a table with planted breaches --------
# Planted breach kinds, drawn per row from h10: 0 unknown type, 1 unknown
# product, 2 unknown agency, 3 unknown country, 4 date out of window,
# 5 amount x25, 6 id of the previous row (a duplicate and a gap).
PLANT_K = 1000


def planted(spark, sf) -> DataFrame:
    g = mv(spark, sf, extra_draws=(D.C_PLANT,))
    k = D.pick("h10", PLANT_K)
    return g.select(
        F.when(k == 6, F.greatest(F.col("mouvement_no") - 1, F.lit(1))).otherwise(F.col("mouvement_no")).alias("mouvement_no"),
        F.when(k == 4, F.date_add("date_op", 40)).otherwise(F.col("date_op")).alias("date_op"),
        F.when(k == 1, F.lit("moto")).otherwise(F.col("produit")).alias("produit"),
        F.when(k == 0, F.lit(UNKNOWN_LABEL)).otherwise(F.col("type_op")).alias("type_op"),
        F.when(k == 5, F.col("cents") * 25).otherwise(F.col("cents")).alias("cents"),
        F.when(k == 2, F.lit("AG_099")).otherwise(F.col("agence_id")).alias("agence_id"),
        F.when(k == 3, F.lit("UK")).otherwise(F.col("pays")).alias("pays"),
    )


def _planted_sql() -> list[str]:
    k = D.sql_pick("h10", PLANT_K)
    return O.orders_movements(extra_draws=(D.C_PLANT,)) + [
        f"pl AS (SELECT CASE WHEN {k} = 6 THEN greatest(mouvement_no - 1, 1) ELSE mouvement_no END AS mouvement_no, "
        f"CASE WHEN {k} = 4 THEN CAST(date_op + 40 AS DATE) ELSE date_op END AS date_op, "
        f"CASE WHEN {k} = 1 THEN 'moto' ELSE produit END AS produit, "
        f"CASE WHEN {k} = 0 THEN '{UNKNOWN_LABEL}' ELSE type_op END AS type_op, "
        f"CASE WHEN {k} = 5 THEN cents * 25 ELSE cents END AS cents, "
        f"CASE WHEN {k} = 2 THEN 'AG_099' ELSE agence_id END AS agence_id, "
        f"CASE WHEN {k} = 3 THEN 'UK' ELSE pays END AS pays FROM mv)",
        O.rules_cte(),
        "plb AS (SELECT pl.*, coalesce(r.lo_cents, 1000) AS lo_cents, coalesce(r.hi_cents, 100000) AS hi_cents "
        "FROM pl LEFT JOIN rules r USING (type_op))",
    ]


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_CONTRACT_SQL = O.with_(_planted_sql() + [
    "ids AS (SELECT mouvement_no, count(*) AS n FROM plb GROUP BY mouvement_no)",
    f"""tot AS (SELECT (SELECT count(*) FROM plb) AS n_checked,
        (SELECT coalesce(sum(n), 0) FROM ids WHERE mouvement_no IS NULL) AS id_parse,
        (SELECT coalesce(sum(n - 1), 0) FROM ids WHERE mouvement_no IS NOT NULL) AS id_unique,
        (SELECT max(mouvement_no) - min(mouvement_no) + 1 - count(mouvement_no) FROM ids) AS id_gaps,
        (SELECT count(*) FILTER (WHERE NOT coalesce(produit IN {_in(model.PRODUCTS)}, false)) FROM plb) AS produit_domain,
        (SELECT count(*) FILTER (WHERE NOT coalesce(type_op IN {_in(model.OPERATION_TYPES)}, false)) FROM plb) AS type_op_domain,
        (SELECT count(*) FILTER (WHERE NOT coalesce(agence_id IN {_in(model.AGENCIES)}, false)) FROM plb) AS agence_domain,
        (SELECT count(*) FILTER (WHERE NOT coalesce(pays IN {_in(model.COUNTRIES)}, false)) FROM plb) AS pays_domain,
        (SELECT count(*) FILTER (WHERE NOT coalesce(date_op BETWEEN DATE '2025-06-01' AND DATE '2025-06-30', false)) FROM plb) AS date_window,
        (SELECT count(*) FILTER (WHERE NOT coalesce(cents BETWEEN lo_cents AND hi_cents, false)) FROM plb) AS amount_bounds)""",
], """SELECT CAST(n_checked AS BIGINT) AS n_checked, rule, CAST(n_breaches AS BIGINT) AS n_breaches FROM tot
UNPIVOT (n_breaches FOR rule IN (id_parse, id_unique, id_gaps, produit_domain, type_op_domain, agence_domain,
         pays_domain, date_window, amount_bounds))""")


@register("contract_report", _CONTRACT_SQL)
def contract_report(spark, sf):
    return Q.contract_report(planted(spark, sf))


@register("anomaly_bounds", O.with_(_planted_sql(),
    "SELECT mouvement_no, type_op, cents, lo_cents, hi_cents FROM plb WHERE NOT (cents BETWEEN lo_cents AND hi_cents)"))
def anomaly_bounds(spark, sf):
    return Q.anomalies_bounds(planted(spark, sf)).select("mouvement_no", "type_op", "cents", "lo_cents", "hi_cents")


Z_THRESHOLD = 3.0


@register("anomaly_zscore", O.with_(_planted_sql() + [
    f"g AS (SELECT *, CASE WHEN type_op IN {_in(model.OPERATION_TYPES)} THEN type_op ELSE '{Q.OTHER}' END AS grp FROM plb)",
    f"st AS ({_sql_mean_sd('g', 'grp')})",
    f"z AS (SELECT g.mouvement_no, g.type_op, g.cents, (CAST(g.cents AS DOUBLE) - {_SQL_MEAN}) / {_SQL_SD} AS z "
    "FROM g JOIN st USING (grp))",
], f"SELECT * FROM z WHERE abs(z) > {Z_THRESHOLD}"))
def anomaly_zscore(spark, sf):
    return Q.anomalies_zscore(planted(spark, sf), Z_THRESHOLD).select("mouvement_no", "type_op", "cents", "z")
