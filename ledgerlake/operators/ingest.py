"""Ingestion of the raw zone: typing, repair, quarantine.

Everything is row-local (no shuffle) except the per-file reports, which are
partial hash aggregates keyed by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import model
from ledgerlake.functions.columns import field_count, fold_accents, parse_date_strict, parse_id, repair_mojibake
from ledgerlake.sources.headers import REFUSED
from ledgerlake.sources.raw import EXTRA, LINE, SHAPE

OK = "ok"
REASONS = ("foreign_header", "short_row", "long_row", "bad_id", "bad_date", "bad_number", "empty_field")


def normalise_labels(df: DataFrame, cols=("produit", "type_op")) -> DataFrame:
    """Repair mojibake, then fold accents (R6): every landing spells labels in ASCII."""
    return df.withColumns({c: fold_accents(repair_mojibake(F.col(c))) for c in cols})


def type_movements(raw: DataFrame) -> DataFrame:
    """Typed parse of all-string rows (R1, R5) plus a ``reason`` column (R2).

    Uses the ``try_`` forms so a bad value becomes NULL instead of failing
    the job under ANSI mode (H16). ``cents`` is the exact amount in cents;
    ``montant`` the staged DECIMAL(12,2). ``raw_line`` of a bad row is the line as
    read (``_line``); rows that come without one have their fields joined.
    """
    long_row = F.col(EXTRA).isNotNull() if EXTRA in raw.columns else F.lit(False)
    # An empty country is not a missing one: the line tells, where there is one.
    short_row = F.col("pays").isNull()
    if SHAPE in raw.columns:
        short_row, long_row = F.col(SHAPE) < 0, F.col(SHAPE) > 0
    elif LINE in raw.columns:
        short_row = short_row & (field_count(LINE) < len(model.COLUMNS))
    empty = F.col("produit").isNull() | F.col("type_op").isNull() | F.col("agence_id").isNull() | F.col("pays").isNull()
    refused = F.col(REFUSED) if REFUSED in raw.columns else F.lit(False)
    exact = F.col("montant").try_cast("decimal(38,18)")
    montant = F.when(exact == F.round(exact, 2), F.col("montant").try_cast("decimal(12,2)"))  # nothing is rounded silently
    line = F.array_join(F.array(*[F.col(c) for c in (*model.COLUMNS, EXTRA) if c in raw.columns]), ",", "")
    if LINE in raw.columns:
        line = F.col(LINE)
    elif EXTRA in raw.columns:
        line = F.when(F.col(EXTRA).isNull(), F.regexp_replace(line, r",\z", "")).otherwise(line)
    typed = normalise_labels(raw.withColumns({"__line": line, "__empty": empty})).select(
        *[c for c in raw.columns if c not in (*model.COLUMNS, EXTRA, LINE, SHAPE, REFUSED)],
        F.col("id_mouvement"),
        parse_id("id_mouvement").alias("mouvement_no"),
        parse_date_strict("date_op").alias("date_op"),
        "produit",
        "type_op",
        montant.alias("montant"),
        (montant * F.lit(100)).cast("bigint").alias("cents"),
        "agence_id",
        "pays",
        short_row.alias("__short"),
        long_row.alias("__long"),
        refused.alias("__refused"),
        "__empty",
        "__line",
    )
    reason = (
        F.when(F.col("__refused"), F.lit("foreign_header"))
        .when(F.col("__short"), F.lit("short_row"))
        .when(F.col("__long"), F.lit("long_row"))
        .when(F.col("mouvement_no").isNull(), F.lit("bad_id"))
        .when(F.col("date_op").isNull(), F.lit("bad_date"))
        .when(F.col("cents").isNull(), F.lit("bad_number"))
        .when(F.col("__empty"), F.lit("empty_field"))
        .otherwise(F.lit(OK))
    )
    # Quarantined rows keep the text they came with.
    return typed.withColumn("reason", reason).withColumn("raw_line", F.when(F.col("reason") != OK, F.col("__line"))).drop("__short", "__long", "__refused", "__empty", "__line")


def split_quarantine(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows (R2). Both are lazy filters of one input;
    cache or write the input once before using both."""
    return typed.filter(F.col("reason") == OK), typed.filter(F.col("reason") != OK)


def drop_repeated_headers(lines: DataFrame, header_prefix: str = model.COLUMNS[0]) -> DataFrame:
    """Drop header lines met inside a body (F1)."""
    return lines.filter(~F.col("value").startswith(header_prefix))


def split_line(lines: DataFrame) -> DataFrame:
    """All-string columns from a comma-joined line (inverse of P14)."""
    parts = F.split(F.col("value"), ",", -1)
    return lines.select(*[parts[k].alias(c) for k, c in enumerate(model.COLUMNS)])


def utf8_report(lines: DataFrame, key: tuple[str, ...] = ("file_name",), **counts: Column) -> DataFrame:
    """Per-file encoding guard (R7) over a *text* scan.

    The text source keeps the raw bytes of each line, so ``is_valid_utf8``
    sees bad bytes (the CSV reader would already have replaced them by
    U+FFFD). One partial aggregate per file; scales with split files. ``counts``
    are further conditions on a line, counted in the same pass.
    """
    return lines.groupBy(*key).agg(
        F.count("*").alias("n_lines"),
        F.count_if(~F.is_valid_utf8(F.col("value"))).alias("n_invalid_lines"),
        *[F.count_if(c).alias(name) for name, c in counts.items()],
    )
