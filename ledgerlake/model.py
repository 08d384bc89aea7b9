"""Schemas, domains and the amount-rule table of the ``mouvements`` fact table.

Everything here is a small constant. Dimensions are built as SQL ``VALUES``
relations so Catalyst knows their size and broadcasts them on its own; the
row counts are fixed by this module, which is the proven size bound that makes
broadcasting them safe at any data scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values (must equal the reference's for identical output) --------
# Column order of the landed CSV.
COLUMNS = ["id_mouvement", "date_op", "produit", "type_op", "montant", "agence_id", "pays"]
# Products, ASCII spelling then accented spelling, in the reference's list order.
PRODUCTS = ["auto", "sante", "habitation", "vie"]
PRODUCTS_ACCENTED = ["auto", "santé", "habitation", "vie"]
# Operation types, ASCII spelling, in the reference's list order.
OPERATION_TYPES = [
    "cotisation", "remboursement", "commission", "retrocession",
    "ajustement_cotisation", "ajustement_remboursement", "regularisation",
    "reajustement_prime", "penalite_retard", "penalite_resiliation",
    "correction_comptable", "annulation_operation", "virement_interne",
    "provision_sinistre", "liberation_provision", "taxe_assurance",
    "frais_gestion", "prime_exceptionnelle", "bonus_malus",
]
# Operation types, accented spelling (older landings), same order.
OPERATION_TYPES_ACCENTED = [
    "cotisation", "remboursement", "commission", "rétrocession",
    "ajustement_cotisation", "ajustement_remboursement", "régularisation",
    "réajustement_prime", "pénalité_retard", "pénalité_résiliation",
    "correction_comptable", "annulation_opération", "virement_interne",
    "provision_sinistre", "libération_provision", "taxe_assurance",
    "frais_gestion", "prime_exceptionnelle", "bonus_malus",
]
# Amount bounds in cents (low, high), inclusive, one pair per operation type,
# same order as OPERATION_TYPES.
AMOUNT_BOUNDS_CENTS = [
    (5000, 250000), (-500000, -10000), (2500, 50000), (10000, 100000),
    (-20000, 20000), (-20000, 20000), (-20000, 20000), (-20000, 20000),
    (1500, 30000), (1500, 30000), (-50000, 50000), (-50000, 50000),
    (10000, 1000000), (50000, 1500000), (-1500000, -50000), (500, 10000),
    (2500, 50000), (5000, 250000), (-15000, 15000),
]
# Bounds for any label not in the table (the rule's "else" branch).
DEFAULT_BOUNDS_CENTS = (1000, 100000)
# Countries in the reference's list order.
COUNTRIES = ["FR", "ES", "IT", "DE", "BE"]
# Agencies AG_001 .. AG_020.
AGENCY_COUNT = 20
AGENCY_FORMAT = "AG_%03d"
# Id format: "M" + index zero-padded to a *minimum* of 7 digits.
ID_FORMAT = "M%07d"
ID_PREFIX = "M"
# Date window: start date plus 0..29 days inclusive.
START_DATE = "2025-06-01"
DATE_RANGE_DAYS = 30
# Shard file names of the current and of the Beam landing.
SHARD_NAME_FORMAT = "mouvements-%05d-of-%05d.csv"
BEAM_SHARD_NAME_FORMAT = "mouvements-%02d-of-%02d.csv"
DEFAULT_SHARDS = 5
# Rows per landed file at the reference's scale: 10 M rows in 5 files.
ROWS_PER_SHARD = 2_000_000
# Accent folding of labels: each character of the first string maps to the
# character at the same position of the second.
FOLD_FROM = "éèêàâîôûç"
FOLD_TO = "eeeaaiouc"
# --- end of fixed values ----------------------------------------------------

AGENCIES = [AGENCY_FORMAT % n for n in range(1, AGENCY_COUNT + 1)]


def shard_count(n_rows: int, rows_per_file: int = ROWS_PER_SHARD) -> int:
    """Files of a landing of ``n_rows``: one per ``rows_per_file`` (the reference's 10 M rows make
    its 5 files), so writer tasks stay the same size as the data grows."""
    return max(1, -(-n_rows // rows_per_file))


RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in COLUMNS])

STAGED_SCHEMA = T.StructType([
    T.StructField("id_mouvement", T.StringType(), False),
    T.StructField("mouvement_no", T.LongType(), False),
    T.StructField("date_op", T.DateType(), False),
    T.StructField("produit", T.StringType(), False),
    T.StructField("type_op", T.StringType(), False),
    T.StructField("montant", T.DecimalType(12, 2), False),
    T.StructField("agence_id", T.StringType(), False),
    T.StructField("pays", T.StringType(), False),
])


@dataclass(frozen=True)
class LakePaths:
    """Zone layout of a lake rooted at ``base`` (any Hadoop URI)."""

    base: str

    @property
    def raw(self) -> str:
        return f"{self.base}/raw/mouvements"

    @property
    def staging(self) -> str:
        return f"{self.base}/staging/mouvements"

    @property
    def tables(self) -> str:
        return f"{self.base}/delta/mouvements"

    @property
    def metrics(self) -> str:
        return f"{self.base}/quality_metrics"

    @property
    def manifest(self) -> str:
        return f"{self.base}/manifest"

    @property
    def ledger(self) -> str:
        return f"{self.base}/_ledger"

    @property
    def checkpoints(self) -> str:
        return f"{self.base}/_checkpoints"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values_sql(rows: list[tuple], names: list[str]) -> str:
    """A ``VALUES`` relation; Spark and DuckDB parse the same text."""
    body = ", ".join(
        "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    )
    return f"(VALUES {body}) AS t({', '.join(names)})"


def rule_rows() -> list[tuple]:
    return [
        (i, OPERATION_TYPES[i], OPERATION_TYPES_ACCENTED[i], lo, hi)
        for i, (lo, hi) in enumerate(AMOUNT_BOUNDS_CENTS)
    ]


RULE_COLUMNS = ["type_ord", "type_op", "type_op_accented", "lo_cents", "hi_cents"]


def rules_df(spark: SparkSession) -> DataFrame:
    """19-row amount-rule dimension (B2). Size fixed by this module."""
    return spark.sql(
        "SELECT CAST(type_ord AS BIGINT) AS type_ord, type_op, type_op_accented, "
        "CAST(lo_cents AS BIGINT) AS lo_cents, CAST(hi_cents AS BIGINT) AS hi_cents "
        f"FROM {values_sql(rule_rows(), RULE_COLUMNS)}"
    )


def products_df(spark: SparkSession) -> DataFrame:
    rows = [(i, p, a) for i, (p, a) in enumerate(zip(PRODUCTS, PRODUCTS_ACCENTED))]
    return spark.sql(
        "SELECT CAST(ordinal AS BIGINT) AS ordinal, produit, produit_accented "
        f"FROM {values_sql(rows, ['ordinal', 'produit', 'produit_accented'])}"
    )


def agencies_df(spark: SparkSession) -> DataFrame:
    """Agency dimension derived from a rule (S10), 20 rows."""
    return spark.range(1, AGENCY_COUNT + 1, 1, 1).selectExpr(
        "id - 1 AS ordinal", f"format_string('{AGENCY_FORMAT}', id) AS agence_id"
    )


def countries_df(spark: SparkSession) -> DataFrame:
    rows = [(i, c) for i, c in enumerate(COUNTRIES)]
    return spark.sql(
        f"SELECT CAST(ordinal AS BIGINT) AS ordinal, pays FROM {values_sql(rows, ['ordinal', 'pays'])}"
    )
