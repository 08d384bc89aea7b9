"""Scalar column helpers: ids, labels, amounts, dates. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake import model

TEN_MILLION = 10_000_000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_id(no: Column | str) -> Column:
    """``M`` + number zero-padded to a minimum of 7 digits.

    ``lpad`` alone would truncate 10,000,000 to 7 characters, so it is only
    used below 10**7; wider numbers keep all their digits. Same output as
    ``format_string('M%07d', no)`` for non-negative numbers, without the
    per-row format-string parse.
    """
    s = _c(no).cast("string")
    return F.concat(
        F.lit(model.ID_PREFIX),
        F.when(_c(no) < F.lit(TEN_MILLION), F.lpad(s, 7, "0")).otherwise(s),
    )


def parse_id(id_col: Column | str) -> Column:
    """Numeric id from the text id (R5, H2); NULL when it does not parse."""
    c = _c(id_col)
    return F.when(c.rlike(f"^{model.ID_PREFIX}[0-9]+\\z"), F.substring(c, F.lit(2), F.length(c)).try_cast("bigint"))


def parse_date_strict(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text to DATE, NULL otherwise.

    The shape test (10 characters, dashes at 5 and 8, leading digit) plus the
    built-in string-to-date cast is as strict as a ``yyyy-MM-dd`` formatter
    (``2025-06-31`` and ``2025-6-1`` are NULL) and avoids the per-row
    formatter.
    """
    d = _c(c)
    shape = ((F.length(d) == 10) & (F.substring(d, 5, 1) == "-") & (F.substring(d, 8, 1) == "-")
             & F.substring(d, 1, 1).between("0", "9"))
    return F.when(shape, d.try_cast("date"))


def is_ascii(c: Column | str) -> Column:
    """True when every character is one byte: no folding or repair needed."""
    return F.octet_length(_c(c)) == F.length(_c(c))


def fold_accents(c: Column | str) -> Column:
    """Accent folding of labels (P15, R6): fixed one-to-one character map.

    ASCII values (almost all of them) skip the translation.
    """
    c = _c(c)
    return F.when(is_ascii(c), c).otherwise(F.translate(c, model.FOLD_FROM, model.FOLD_TO))


def repair_mojibake(c: Column | str) -> Column:
    """UTF-8 text that was decoded as ISO-8859-1 (``santÃ©``) back to UTF-8.

    Such text holds U+00C3 or U+00C2 (the UTF-8 lead bytes of Latin-1
    letters read one byte at a time); anything else is returned untouched.
    """
    c = _c(c)
    suspect = ~is_ascii(c) & ((F.instr(c, "Ã") > 0) | (F.instr(c, "Â") > 0)) & c.rlike(r"^[\x{0}-\x{FF}]*\z")
    # Only bytes that are UTF-8 again were mojibake; ``SÃO`` is a name and stays.
    back = F.when(suspect, F.encode(c, "ISO-8859-1")).cast("string")
    return F.when(F.is_valid_utf8(back), back).otherwise(c)


def has_replacement_char(c: Column | str) -> Column:
    """Parsed text that came from invalid UTF-8 bytes holds U+FFFD."""
    return F.instr(_c(c), "�") > 0


def field_count(line: Column | str) -> Column:
    """Fields of a CSV line: commas outside quoted fields (quotes in them doubled or escaped), and one."""
    line = _c(line)
    bare = F.when(F.instr(line, '"') > 0, F.regexp_replace(line, r'(^|,)"(?:[^"\\]|\\.|"")*"(?=,|\z)', "$1")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def pick_from(values: list[str], idx: Column) -> Column:
    """``values[idx]`` for a 0-based integer index column."""
    return F.array(*[F.lit(v) for v in values])[idx.cast("int")]


def pick_int(values: list[int], idx: Column) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])[idx.cast("int")]


def cents_to_amount(cents: Column | str) -> Column:
    """Integer cents → DOUBLE euros; ``-0.0`` cannot arise."""
    return _c(cents) / F.lit(100.0)
