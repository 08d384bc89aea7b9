"""File-based catalogue queries: landings, readers, repair, layout, stream.

Each query writes under a fresh folder of the shared checkpoint directory
(never into the read-only input folder) and returns a DataFrame that reads
what was written, so the source/sink pair is what gets verified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import files as small
from ledgerlake import model
from ledgerlake.functions import draws as D
from ledgerlake.functions.columns import has_replacement_char, parse_id
from ledgerlake.operators import ingest as I
from ledgerlake.operators import quality as Q
from ledgerlake.operators.dedupe import keep_first, keep_first_by_zones, union_landings
from ledgerlake.operators.incremental import ingest_new
from ledgerlake.plans import oracle as O
from ledgerlake.plans.catalogue import (
    FILES_PER_TASK, MV_COLS, N_SQL, S_SQL, ROWS_PER_CHUNK, ROWS_PER_FILE, SEED, _cols, dealt_index, mv, n_orders, orders, register, shards_of,
)
from ledgerlake.session import scratch_path
from ledgerlake.sinks import layout as L
from ledgerlake.sources.generate import movements, raw_columns
from ledgerlake.sources.headers import read_by_header
from ledgerlake.sources.raw import CSV_FILES, inventory, listing, read_lines, read_raw, select_parts, with_source_file

TYPED_COLS = ["id_mouvement", "mouvement_no", "date_op", "produit", "type_op", "montant", "cents",
              "agence_id", "pays"]
_TYPED_SQL = ("id_mouvement, mouvement_no, date_op, produit, type_op, montant, cents, agence_id, pays")
_RAW_SQL = ("id_mouvement, CAST(date_op AS VARCHAR) AS date_op, produit, type_op, "
            "CAST(montant AS VARCHAR) AS montant, agence_id, pays")


def typed_out(df: DataFrame, *extra: str) -> DataFrame:
    """Typed rows with the staged DECIMAL amount shown as DOUBLE."""
    return df.select(*[F.col(c).cast("double").alias(c) if c == "montant" else F.col(c) for c in TYPED_COLS], *extra)


def _land_rows(spark, sf, path, n, start=0, lo=None, hi=None, **kw) -> None:
    shards = shards_of(n)
    L.land_movements(spark, path, n, shards, index=dealt_index(spark, sf, n, shards, start, lo, hi), **kw)


def _land_several(spark, sf, path, n, start=0, lo=None, hi=None, **kw) -> None:
    """The rows of ``_land_rows`` in order, in files of ``ROWS_PER_FILE`` of which a task writes several."""
    index = dealt_index(spark, sf, n, shards_of(n), start, lo, hi, per_task=FILES_PER_TASK)
    L.land_movements(spark, path, n, index=index, file_rows=ROWS_PER_FILE, **kw)


def _land(spark, sf, name, **kw) -> str:
    path = scratch_path(spark, name)
    n = n_orders(spark, sf)
    _land_rows(spark, sf, path, n, seed=kw.pop("seed", SEED), **kw)
    return path


# --- K1 K2 P13 S4 R3: CSV landing read back as all-string rows ---------------

@register("csv_round_trip_raw", O.with_(O.orders_movements(), f"SELECT {_RAW_SQL} FROM mv"))
def csv_round_trip_raw(spark, sf):
    return read_raw(spark, _land(spark, sf, "raw_csv"))


# --- R1 R5: typed parse -------------------------------------------------------

@register("csv_typed", O.with_(O.orders_movements(), f"SELECT {_TYPED_SQL}, 'ok' AS reason FROM mv"))
def csv_typed(spark, sf):
    typed = I.type_movements(read_raw(spark, _land(spark, sf, "raw_typed"), shape=True, recursive=True))
    return typed_out(typed, "reason")


# --- R2: quarantine of rows that do not parse ---------------------------------
SPOIL_K = 97  # kinds 0 bad date, 1 bad number, 2 short row; the rest are clean


@register("quarantine", O.with_(O.orders_movements(extra_draws=(D.C_SPOIL,)) + [
    f"k AS (SELECT *, {D.sql_pick('h7', SPOIL_K)} AS kind FROM mv)"],
    "SELECT CASE kind WHEN 0 THEN 'bad_date' WHEN 1 THEN 'bad_number' WHEN 2 THEN 'short_row' ELSE 'ok' END AS reason, "
    "count(*) AS n_rows, CAST(sum(CASE WHEN kind = 1 THEN NULL ELSE cents END) AS BIGINT) AS sum_cents "
    "FROM k GROUP BY 1"))
def quarantine(spark, sf):
    n = n_orders(spark, sf)
    g = movements(dealt_index(spark, sf, n, shards_of(n)), seed=SEED, extra_draws=(D.C_SPOIL,))
    kind = D.pick("h7", SPOIL_K)
    date = F.when(kind == 0, F.lit("2025-06-31")).otherwise(F.date_format("date_op", "yyyy-MM-dd"))
    amount = F.when(kind == 1, F.lit("x")).otherwise(F.col("montant").cast("string"))
    fields = [F.col("id_mouvement"), date, F.col("produit"), F.col("type_op"), amount, F.col("agence_id")]
    line = F.when(kind == 2, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, F.col("pays")))
    raw_path, out_path = scratch_path(spark, "raw_spoiled"), scratch_path(spark, "typed_by_reason")
    L.write_lines(g.select(line.alias("value")), raw_path)
    typed = I.type_movements(read_raw(spark, raw_path, header=False, shape=True, recursive=True))
    # One write splits good and quarantined rows (R2): partition by reason.
    typed.write.partitionBy("reason").parquet(out_path)
    back = spark.read.parquet(out_path)
    return back.groupBy("reason").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("sum_cents"))


# --- R1 R2 R5 R9 F5 K9: dirty rows in two places, one of them compressed ---------
# Kinds by key modulo 13: bad date, bad number, short row, long row, equal rows without an
# id, an amount with three decimals, an id of 70 digits, an empty country; the rest are clean.

@register("dirty_ingest", O.with_(O.orders_movements() + [
    """k AS (SELECT *, (mouvement_no - 1) % 13 AS kind, CAST(date_op AS VARCHAR) AS d, CAST(montant AS VARCHAR) AS m FROM mv)""",
    """l AS (SELECT CASE kind WHEN 0 THEN 'bad_date' WHEN 1 THEN 'bad_number' WHEN 2 THEN 'short_row' WHEN 3 THEN 'long_row'
              WHEN 4 THEN 'bad_id' WHEN 5 THEN 'bad_number' WHEN 6 THEN 'bad_id' WHEN 7 THEN 'empty_field' ELSE 'ok' END AS reason,
              CASE kind WHEN 0 THEN concat_ws(',', id_mouvement, '2025-06-31', produit, type_op, m, agence_id, pays)
                        WHEN 1 THEN concat_ws(',', id_mouvement, d, produit, type_op, 'x', agence_id, pays)
                        WHEN 2 THEN concat_ws(',', id_mouvement, d, produit, type_op, m, agence_id) || ','
                        WHEN 3 THEN concat_ws(',', id_mouvement, d, produit, type_op, m, agence_id, pays, 'more')
                        WHEN 4 THEN 'M-5,2025-06-01,auto,cotisation,60.5,AG_001,FR'
                        WHEN 5 THEN concat_ws(',', id_mouvement, d, produit, type_op, '60.129', agence_id, pays)
                        WHEN 6 THEN concat_ws(',', 'M' || repeat('9', 70), d, produit, type_op, m, agence_id, pays)
                        WHEN 7 THEN concat_ws(',', id_mouvement, d, produit, type_op, m, agence_id) || ',' END AS line,
              CASE WHEN kind > 7 THEN cents END AS cents FROM k)"""],
    "SELECT reason, count(*) AS n_rows, CAST(sum(length(line)) AS BIGINT) AS kept_chars, min(line) AS first_line, "
    "max(line) AS last_line, CAST(sum(CASE WHEN reason = 'ok' THEN cents END) AS BIGINT) AS sum_cents FROM l GROUP BY reason"))
def dirty_ingest(spark, sf):
    g = mv(spark, sf)
    kind = F.pmod(F.col("mouvement_no") - 1, F.lit(13))
    at = lambda k, bad, good: F.when(kind == k, F.lit(bad)).otherwise(good)
    fields = [at(6, "M" + "9" * 70, F.col("id_mouvement")), at(0, "2025-06-31", F.date_format("date_op", "yyyy-MM-dd")), F.col("produit"), F.col("type_op"),
              at(5, "60.129", at(1, "x", F.col("montant").cast("string"))), F.col("agence_id")]
    line = (F.when(kind == 2, F.concat_ws(",", *fields)).when(kind == 3, F.concat_ws(",", *fields, "pays", F.lit("more")))
            .when(kind == 7, F.concat_ws(",", *fields, F.lit("")))
            .when(kind == 4, F.lit("M-5,2025-06-01,auto,cotisation,60.5,AG_001,FR")).otherwise(F.concat_ws(",", *fields, "pays")))
    root = scratch_path(spark, "raw_dirty")
    rows = g.select("mouvement_no", line.alias("value"))
    even = F.pmod("mouvement_no", F.lit(2)) == 0
    L.write_lines(rows.filter(even).select("value"), f"{root}/current")
    L.write_lines(rows.filter(~even).select("value"), f"{root}/mouvements", "gzip")
    typed = I.type_movements(read_raw(spark, root, header=False, shape=True, recursive=True))
    one = keep_first(typed, "mouvement_no", ["reason"])
    # The SQL spells short rows with the commas of seven fields; quarantined_text holds lines as they are.
    lacking = F.repeat(F.lit(","), F.lit(len(model.COLUMNS)) - F.size(F.split("raw_line", ",", -1)))
    one = one.withColumn("raw_line", F.when(F.col("reason") == "short_row", F.concat("raw_line", lacking)).otherwise(F.col("raw_line")))
    return one.groupBy("reason").agg(
        F.count("*").alias("n_rows"), F.sum(F.length("raw_line")).cast("bigint").alias("kept_chars"),
        F.min("raw_line").alias("first_line"), F.max("raw_line").alias("last_line"),
        F.sum(F.when(F.col("reason") == I.OK, F.col("cents"))).alias("sum_cents"))


# --- R2: the text of quarantined rows, as it was written --------------------------
# Kinds by key modulo 9: rows of 9, 11, 3 and 6 fields, one with quoted fields, one of quoted
# and too many fields, one of 8 fields with blanks; the rest are clean.

@register("quarantined_text", O.with_(O.orders_movements() + [
    """k AS (SELECT *, (mouvement_no - 1) % 9 AS kind, concat_ws(',', id_mouvement, CAST(date_op AS VARCHAR), produit, type_op, CAST(montant AS VARCHAR), agence_id, pays) AS whole FROM mv)"""],
    """SELECT id_mouvement, CASE WHEN kind IN (0, 1, 5, 6) THEN 'long_row' WHEN kind IN (2, 3) THEN 'short_row' WHEN kind = 4 THEN 'bad_date' ELSE 'ok' END AS reason,
       CASE kind WHEN 0 THEN whole || ',eight,nine' WHEN 1 THEN whole || ',8,,10,"11"' WHEN 2 THEN concat_ws(',', id_mouvement, '2025-06-01', 'auto')
                 WHEN 3 THEN concat_ws(',', id_mouvement, '2025-06-01', 'auto', 'cotisation', '60.5', 'AG_001')
                 WHEN 4 THEN concat_ws(',', id_mouvement, '"1 June, 2025"', '"auto"', 'cotisation', '60.5', 'AG_001', 'FR')
                 WHEN 5 THEN '"' || id_mouvement || '"' || substr(whole, length(id_mouvement) + 1) || ',"a ""b"", c",d,e' WHEN 6 THEN whole || ', 8 ' END AS raw_line FROM k"""))
def quarantined_text(spark, sf):
    g = mv(spark, sf)
    kind = F.pmod(F.col("mouvement_no") - 1, F.lit(9))
    no = F.col("id_mouvement")
    rest = F.concat_ws(",", F.date_format("date_op", "yyyy-MM-dd"), "produit", "type_op", F.col("montant").cast("string"), "agence_id", "pays")
    whole = F.concat_ws(",", no, rest)
    line = (F.when(kind == 0, F.concat(whole, F.lit(",eight,nine"))).when(kind == 1, F.concat(whole, F.lit(',8,,10,"11"')))
            .when(kind == 2, F.concat(no, F.lit(",2025-06-01,auto"))).when(kind == 3, F.concat(no, F.lit(",2025-06-01,auto,cotisation,60.5,AG_001")))
            .when(kind == 4, F.concat(no, F.lit(',"1 June, 2025","auto",cotisation,60.5,AG_001,FR')))
            .when(kind == 5, F.concat(F.lit('"'), no, F.lit('",'), rest, F.lit(',"a ""b"", c",d,e')))
            .when(kind == 6, F.concat(whole, F.lit(", 8 "))).otherwise(whole))
    root = scratch_path(spark, "raw_kept_text")
    L.write_lines(g.select(line.alias("value")), root)
    typed = I.type_movements(read_raw(spark, root, header=False, shape=True, recursive=True))
    return typed.select("id_mouvement", "reason", "raw_line")


# --- S7 F1 K3: headers met inside consolidated bodies --------------------------

@register("header_filter", O.with_(O.orders_movements(), f"SELECT {_RAW_SQL} FROM mv"))
def header_filter(spark, sf):
    n = n_orders(spark, sf)
    chunks, merged = scratch_path(spark, "chunks"), scratch_path(spark, "merged_text")
    # One CSV per chunk, each with its own header (the superseded chunked writer).
    k, shards = ROWS_PER_CHUNK, shards_of(n)
    n_chunks = max(1, -(-n // k))
    L.write_csv(raw_columns(movements(dealt_index(spark, sf, n, n_chunks), seed=SEED)), chunks)
    lines = read_lines(spark, chunks)
    shard = F.floor(L.part_number(F.col("file_name")) * shards / n_chunks).cast("int")
    # Text-level consolidation: header lines of every chunk end up inside the shard body.
    L.write_lines(lines.repartitionById(shards, shard).select("value"), merged)
    return I.split_line(I.drop_repeated_headers(read_lines(spark, merged)))


# --- R7: encoding guard, mojibake repair ---------------------------------------

def _landing_report(lines: DataFrame) -> DataFrame:
    """Counters per landing from one text scan: each line is judged as its bytes, as the
    UTF-8 reader shows it and as the ISO-8859-1 reader shows it after repair."""
    produit, type_op = model.COLUMNS.index("produit"), model.COLUMNS.index("type_op")
    seen = F.split(F.make_valid_utf8("value"), ",", -1)
    other = F.split(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), ",", -1)
    lines = lines.select("landing", "file_name", "value", (~F.col("value").startswith(model.COLUMNS[0])).alias("row"),
                         has_replacement_char(seen[produit]).alias("lost_produit"), has_replacement_char(seen[type_op]).alias("lost_type"),
                         other[produit].alias("produit"), other[type_op].alias("type_op"))
    lines = I.normalise_labels(lines)
    known = F.col("produit").isin(*model.PRODUCTS) & F.col("type_op").isin(*model.OPERATION_TYPES)
    row = F.col("row")
    files = I.utf8_report(lines, ("landing", "file_name"), n_rows=row, n_rows_fffd=row & (F.col("lost_produit") | F.col("lost_type")), n_rows_ok_after_repair=row & known)
    sums = [F.sum(c).alias(c) for c in ("n_lines", "n_invalid_lines", "n_rows", "n_rows_fffd", "n_rows_ok_after_repair")]
    return files.groupBy("landing").agg(F.count("*").alias("n_files"), F.count_if(F.col("n_invalid_lines") > 0).alias("n_invalid_files"), *sums)


_ACCENTED_ROW = "(produit <> strip_accents(produit) OR type_op <> strip_accents(type_op))"


@register("encoding_guard", O.with_(O.orders_movements(labels="accented") + [
    f"s AS (SELECT *, ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard, {_ACCENTED_ROW} AS acc FROM mv)",
    f"l AS (SELECT 'utf8' AS landing, false AS bad FROM (SELECT 1) UNION ALL SELECT 'latin1', true)"],
    f"""SELECT l.landing, CAST({S_SQL} AS BIGINT) AS n_files,
       CAST(CASE WHEN bad THEN (SELECT count(DISTINCT shard) FROM s WHERE acc) ELSE 0 END AS BIGINT) AS n_invalid_files,
       CAST((SELECT count(*) FROM s) + {S_SQL} AS BIGINT) AS n_lines,
       CAST(CASE WHEN bad THEN (SELECT count(*) FROM s WHERE acc) ELSE 0 END AS BIGINT) AS n_invalid_lines,
       CAST((SELECT count(*) FROM s) AS BIGINT) AS n_rows,
       CAST(CASE WHEN bad THEN (SELECT count(*) FROM s WHERE acc) ELSE 0 END AS BIGINT) AS n_rows_fffd,
       CAST((SELECT count(*) FROM s) AS BIGINT) AS n_rows_ok_after_repair
FROM l"""))
def encoding_guard(spark, sf):
    utf8 = _land(spark, sf, "raw_utf8", labels="accented")
    latin1 = _land(spark, sf, "raw_latin1", labels="accented", encoding="ISO-8859-1")
    lines = [read_lines(spark, path).withColumn("landing", F.lit(name)) for name, path in (("utf8", utf8), ("latin1", latin1))]
    return _landing_report(lines[0].unionByName(lines[1]))


# --- R4 R9 H12: two overlapping landings, one row per id ----------------------

def _two_landings_sql() -> list[str]:
    return (O.movements_ctes("ma", "(SELECT o_orderkey AS i FROM orders)", seed=1)
            + O.movements_ctes("mb", f"(SELECT o_orderkey + {N_SQL} // 2 AS i FROM orders)", seed=2, labels="accented"))


@register("union_landings_dedupe", O.with_(_two_landings_sql() + [
    "u AS (SELECT *, 'current' AS landing, 1 AS prio FROM ma UNION ALL "
    "SELECT * REPLACE (strip_accents(produit) AS produit, strip_accents(type_op) AS type_op), 'beam', 2 FROM mb)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY mouvement_no ORDER BY prio) AS rn FROM u)"],
    "SELECT mouvement_no, id_mouvement, landing, date_op, produit, type_op, montant, agence_id, pays FROM r WHERE rn = 1"))
def union_landings_dedupe(spark, sf):
    n = n_orders(spark, sf)
    a, b = scratch_path(spark, "raw_current"), scratch_path(spark, "raw_beam")
    _land_rows(spark, sf, a, n, seed=1)
    _land_rows(spark, sf, b, n, seed=2, labels="accented", start=n // 2)
    ra = with_source_file(read_raw(spark, a, shape=True, recursive=True)).withColumns({"landing": F.lit("current"), "prio": F.lit(1)})
    rb = with_source_file(read_raw(spark, b, shape=True, recursive=True)).withColumns({"landing": F.lit("beam"), "prio": F.lit(2)})
    staged = scratch_path(spark, "staged_union")
    I.type_movements(union_landings(ra, rb)).withColumn("bad", F.col("reason") != I.OK).write.parquet(staged)
    one = keep_first_by_zones(spark.read.parquet(staged), "mouvement_no", ["bad", "prio", "landing"])
    return one.select("mouvement_no", "id_mouvement", "landing", "date_op", "produit", "type_op",
                      F.col("montant").cast("double").alias("montant"), "agence_id", "pays")


# --- S6 F2 F4 K3 O2: compaction of chunk parts into one file per shard --------

@register("compact_parts", O.with_(O.orders_movements() + [
    f"s AS (SELECT *, ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard FROM mv)"],
    "SELECT shard, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, min(mouvement_no) AS first_no, "
    "max(mouvement_no) AS last_no, CAST(1 AS BIGINT) AS n_files FROM s GROUP BY shard"))
def compact_parts(spark, sf):
    n = n_orders(spark, sf)
    parts, out = scratch_path(spark, "parts"), scratch_path(spark, "compacted")
    shards = shards_of(n)
    g = movements(dealt_index(spark, sf, n, max(1, -(-n // ROWS_PER_CHUNK)), per_task=FILES_PER_TASK), seed=SEED).withColumn(
        "shard", L.shard_of(F.col("mouvement_no") - 1, n, shards))
    L.write_csv(g.sortWithinPartitions("shard", "mouvement_no").select(*model.COLUMNS, "shard"), parts, by="shard", file_rows=ROWS_PER_CHUNK)
    read = lambda paths: read_raw(spark, paths).withColumn("mouvement_no", parse_id("id_mouvement"))
    write = lambda df: L.write_csv(df.select(*model.COLUMNS), out, mode="append")
    listed = inventory(spark, parts, glob=CSV_FILES)
    n_files = L.compact_files(listed, read, write, "mouvement_no", order=F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int"))
    back = with_source_file(read_raw(spark, out))
    n_out, n_back = back.agg(F.count_distinct("file_name"), F.count("*")).first()
    if n_out != n_files or read_raw(spark, parts).count() != n_back:
        raise RuntimeError(f"compaction lost rows or files: {n_files} groups, {n_out} files")
    t = I.type_movements(back)
    return t.groupBy(L.shard_of(F.col("mouvement_no") - 1, n, shards).alias("shard")).agg(
        F.count("*").alias("n_rows"), F.sum("cents").alias("sum_cents"),
        F.min("mouvement_no").alias("first_no"), F.max("mouvement_no").alias("last_no"),
        F.count_distinct("file_name").alias("n_files"))


# --- Q1 A1 A2: rows per file and in total ------------------------------------

@register("rows_per_file", f"""
WITH s AS (SELECT ((o_orderkey + 1) * {S_SQL} - 1) // {N_SQL} AS shard FROM orders)
SELECT shard, count(*) AS n_rows FROM s GROUP BY ROLLUP (shard)""")
def rows_per_file(spark, sf):
    df = with_source_file(read_raw(spark, _land(spark, sf, "raw_counted")))
    return Q.rows_per_file(df.withColumn("shard", L.part_number(F.col("file_name"))), "shard")


# --- S5 F5 Q3 Q4: zone inventory ----------------------------------------------
_HEADER_BYTES = len(",".join(model.COLUMNS)) + 1


@register("zone_inventory", O.with_(O.orders_movements() + O.movements_ctes(
    "mb", "(SELECT o_orderkey AS i FROM orders)", seed=2, labels="accented"),
    f"""SELECT zone, CAST({S_SQL} AS BIGINT) AS n_files, CAST(bytes + {S_SQL} * {_HEADER_BYTES} AS BIGINT) AS n_bytes FROM (
  SELECT 'raw_current' AS zone, sum(strlen(concat_ws(',', {_RAW_SQL.replace(' AS date_op', '').replace(' AS montant', '')})) + 1) AS bytes FROM mv
  UNION ALL
  SELECT 'raw_beam', sum(strlen(concat_ws(',', {_RAW_SQL.replace(' AS date_op', '').replace(' AS montant', '')})) + 1) FROM mb)"""))
def zone_inventory(spark, sf):
    root = scratch_path(spark, "lake")
    n = n_orders(spark, sf)
    _land_rows(spark, sf, f"{root}/raw_current", n, seed=SEED)
    _land_rows(spark, sf, f"{root}/raw_beam", n, seed=2, labels="accented")
    inv = inventory(spark, root, glob=CSV_FILES)
    zone = F.regexp_extract("path", r"/(raw_[a-z]+)/", 1)
    return inv.groupBy(zone.alias("zone")).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


# --- P16 P17 K2 K4: files with the documented names -----------------------------
# Landed twice under the same names; what is there is the second landing.

@register("named_shards", O.with_(O.orders_movements() + [
    f"s AS (SELECT *, ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard FROM mv)"],
    f"""SELECT printf('mouvements-%05d-of-%05d.csv', shard, {S_SQL}) AS file_name, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, min(mouvement_no) AS min_no, max(mouvement_no) AS max_no,
       CAST(sum(strlen(concat_ws(',', {_RAW_SQL.replace(' AS date_op', '').replace(' AS montant', '')})) + 1) + {_HEADER_BYTES} AS BIGINT) AS n_bytes FROM s GROUP BY shard"""))
def named_shards(spark, sf):
    from ledgerlake.sinks.named import land_named
    n, path = n_orders(spark, sf), scratch_path(spark, "raw_named")
    shards = shards_of(n)
    for seed in (1, SEED):
        land_named(raw_columns(movements(dealt_index(spark, sf, n, shards), seed=seed)), path, shards)
    sizes = inventory(spark, path, glob=CSV_FILES).select(F.element_at(F.split("path", "/"), -1).alias("_name"), F.col("length").alias("n_bytes"))
    rows = I.type_movements(with_source_file(read_raw(spark, path, shape=True, glob=CSV_FILES)))
    got = rows.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("sum_cents"), F.min("mouvement_no").alias("min_no"), F.max("mouvement_no").alias("max_no"))
    return got.join(sizes, F.col("file_name") == F.col("_name"), "full").drop("_name")


# --- R8: only files not yet ingested ------------------------------------------

_RUN_SQL = (f"CAST({S_SQL} AS BIGINT) AS n_new_files, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, "
            "min(mouvement_no) AS min_no, max(mouvement_no) AS max_no")


@register("new_files_only", O.with_(
    O.movements_ctes("ma", "(SELECT o_orderkey AS i FROM orders)", seed=1)
    + O.movements_ctes("mb", f"(SELECT o_orderkey + {N_SQL} AS i FROM orders)", seed=2, labels="accented")
    + O.movements_ctes("mc", f"(SELECT o_orderkey AS i FROM orders WHERE ((o_orderkey + 1) * {S_SQL} - 1) // {N_SQL} = 0)", seed=3),
    f"SELECT CAST(1 AS BIGINT) AS run, {_RUN_SQL} FROM ma UNION ALL SELECT CAST(2 AS BIGINT), {_RUN_SQL} FROM mb "
    "UNION ALL SELECT CAST(3 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) "
    f"UNION ALL SELECT CAST(4 AS BIGINT), {_RUN_SQL.replace(S_SQL, '1', 1)} FROM mc"))
def new_files_only(spark, sf):
    """Four runs: no manifest yet, a second landing, nothing new, one file replaced under its name."""
    n = n_orders(spark, sf)
    raw, manifest = scratch_path(spark, "raw_incr"), scratch_path(spark, "manifest")
    landings = {1: {"seed": 1}, 2: {"seed": 2, "labels": "accented", "start": n}}
    runs = None
    for run in (1, 2, 3, 4):
        if run in landings:
            _land_rows(spark, sf, f"{raw}/landing_{run}", n, **landings[run])
        if run == 4:
            _replace_first_file(spark, sf, n, f"{raw}/landing_1")
        out = scratch_path(spark, f"ingested_{run}")
        is_new = ingest_new(spark, raw, manifest, out)
        files = spark.read.parquet(f"{out}/files")
        typed = spark.read.parquet(f"{out}/rows") if is_new else files.select(F.lit(0).cast("bigint").alias("cents"), F.lit(0).cast("bigint").alias("mouvement_no"))
        zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
        got = typed.agg(F.count("*").alias("n_rows"), zero(F.sum("cents")).alias("sum_cents"), zero(F.min("mouvement_no")).alias("min_no"), zero(F.max("mouvement_no")).alias("max_no"))
        got = got.select(F.lit(run).cast("bigint").alias("run"), F.lit(files.count()).cast("bigint").alias("n_new_files"), "*")
        runs = got if runs is None else runs.unionByName(got)
    return runs


def _replace_first_file(spark, sf, n: int, folder: str) -> None:
    """The same shard of another draw, under the name of the folder's first file; of that draw, only this shard is landed."""
    other, shards = scratch_path(spark, "raw_other"), shards_of(n)
    first_rows = n // shards  # the keys below are those that are dealt to shard 0, if there are others
    _land_rows(spark, sf, other, first_rows, seed=3, hi=first_rows if shards > 1 else None)
    first = lambda path: next(x for x in small.names(spark, path) if x.startswith("part-00000"))
    small.move(spark, f"{other}/{first(other)}", f"{folder}/{first(folder)}")


# --- R3 S4: every file by its own header ------------------------------------------
# Four landings by key modulo 4: the documented header; columns turned round, with one more; no
# header; the header of something else, which is refused as a whole (its header lines too).

@register("mixed_headers", O.with_(O.orders_movements() + [
    f"k AS (SELECT *, (mouvement_no - 1) % 4 AS kind, ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard FROM mv)"],
    "SELECT CASE kind WHEN 0 THEN 'documented' WHEN 1 THEN 'turned' WHEN 2 THEN 'bare' ELSE 'foreign' END AS landing, CASE WHEN kind = 3 THEN 'foreign_header' ELSE 'ok' END AS reason, "
    "count(*) + CASE WHEN kind = 3 THEN count(DISTINCT shard) ELSE 0 END AS n_rows, CAST(sum(CASE WHEN kind < 3 THEN cents END) AS BIGINT) AS sum_cents, "
    "min(CASE WHEN kind < 3 THEN mouvement_no END) AS min_no, max(CASE WHEN kind < 3 THEN mouvement_no END) AS max_no, "
    "CAST(sum(CASE WHEN kind = 3 THEN length(concat_ws(',', id_mouvement, CAST(date_op AS VARCHAR), produit, type_op, CAST(montant AS VARCHAR), agence_id, pays)) END) "
    f"+ CASE WHEN kind = 3 THEN count(DISTINCT shard) * {len('ref,jour,gamme,code,valeur,bureau,zone')} ELSE 0 END AS BIGINT) AS kept_chars FROM k GROUP BY kind"))
def mixed_headers(spark, sf):
    n, root = n_orders(spark, sf), scratch_path(spark, "raw_mixed")
    shards = shards_of(n)
    g = movements(dealt_index(spark, sf, n, shards, per_task=FILES_PER_TASK), seed=SEED)
    kind = F.pmod(F.col("mouvement_no") - 1, F.lit(4))
    shard = F.least(L.shard_of(F.col("mouvement_no") - 1, max(n, 1), shards), F.lit(shards - 1))
    part = lambda k: g.filter(kind == k).withColumn("shard", shard).sortWithinPartitions("shard", "mouvement_no").select(*model.COLUMNS, "shard")
    # A file per shard in a folder of its own, so that a task can write several.
    L.write_csv(part(0), f"{root}/documented", by="shard")
    turned = ["pays", *[c for c in reversed(model.COLUMNS) if c != "pays"]]
    L.write_csv(part(1).select(*turned, F.lit('vu, "ok"').alias("commentaire"), "shard"), f"{root}/turned", by="shard")
    L.write_csv(part(2), f"{root}/bare", header=False, by="shard")
    L.write_csv(part(3).toDF("ref", "jour", "gamme", "code", "valeur", "bureau", "zone", "shard"), f"{root}/foreign", by="shard")
    typed = I.type_movements(read_by_header(spark, root))
    landing = F.regexp_extract("file_path", r"/([a-z]+)/shard=[0-9]+/[^/]*\z", 1)
    good = lambda c: F.when(F.col("reason") == I.OK, F.col(c))
    return typed.groupBy(landing.alias("landing"), "reason").agg(
        F.count("*").alias("n_rows"), F.sum(good("cents")).alias("sum_cents"), F.min(good("mouvement_no")).alias("min_no"),
        F.max(good("mouvement_no")).alias("max_no"), F.sum(F.length("raw_line")).cast("bigint").alias("kept_chars"))


# --- K5 K7: partitioned published table ---------------------------------------

def _staged(g: DataFrame) -> DataFrame:
    return g.select("id_mouvement", "mouvement_no", "date_op", "produit", "type_op",
                    (F.col("cents").cast("decimal(14,0)") / 100).cast("decimal(12,2)").alias("montant"),
                    "agence_id", "pays")


@register("partition_read", O.with_(O.orders_movements(),
    "SELECT pays, produit, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, "
    "min(mouvement_no) AS min_no, max(mouvement_no) AS max_no FROM mv GROUP BY pays, produit"))
def partition_read(spark, sf):
    path = scratch_path(spark, "published")
    L.publish_partitioned(_staged(mv(spark, sf)), path, ["pays", "produit"], sort_col="mouvement_no")
    t = spark.read.parquet(path)
    return t.groupBy("pays", "produit").agg(
        F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"),
        F.min("mouvement_no").alias("min_no"), F.max("mouvement_no").alias("max_no"))


@register("partition_filter", O.with_(O.orders_movements(),
    "SELECT produit, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents FROM mv WHERE pays = 'FR' GROUP BY produit"))
def partition_filter(spark, sf):
    path = scratch_path(spark, "published_fr")
    L.publish_partitioned(_staged(mv(spark, sf)), path, ["pays", "produit"], sort_col="mouvement_no")
    t = spark.read.parquet(path).filter(F.col("pays") == "FR")  # prunes the other countries' folders
    return t.groupBy("produit").agg(F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"))


# --- O1 O3 S6 F4: sorted, limited listing; parts selected by name ----------------

@register("listed_parts", O.with_(O.orders_movements() + [
    f"s AS (SELECT ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard FROM mv)"],
    "SELECT shard, CASE WHEN shard = 1 THEN count(*) END AS n_rows FROM s WHERE shard < 3 GROUP BY shard"))
def listed_parts(spark, sf):
    raw = _land(spark, sf, "raw_listed")
    names = listing(spark, raw, 3, glob=CSV_FILES).select(L.part_number(F.col("path")).alias("shard"))
    rows = with_source_file(select_parts(read_raw(spark, raw), "part-00001")).groupBy(L.part_number(F.col("file_name")).alias("shard"))
    return names.join(rows.agg(F.count("*").alias("n_rows")), "shard", "left")


# --- O2 P14: rows in id order inside each file, lines joined without quoting ------

@register("order_in_files", O.with_(O.orders_movements() + [
    f"s AS (SELECT ((mouvement_no * {S_SQL} - 1) // {N_SQL}) AS shard FROM mv)"],
    "SELECT shard, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_descents FROM s GROUP BY shard"))
def order_in_files(spark, sf):
    n, out = n_orders(spark, sf), scratch_path(spark, "ordered")
    shards = shards_of(n)
    g = mv(spark, sf).withColumn("shard", L.shard_of(F.col("mouvement_no") - 1, n, shards))
    merged = L.compact(g, "shard", shards, "mouvement_no")
    L.write_lines(merged.select(L.csv_line(merged, list(model.COLUMNS)).alias("value")), out)
    lines = read_lines(spark, out).withColumn("at", F.monotonically_increasing_id())
    rows = lines.select("file_name", "at", parse_id(F.substring_index("value", ",", 1)).alias("no"))
    before = F.lag("no").over(Window.partitionBy("file_name").orderBy("at"))
    return (rows.withColumn("down", before > F.col("no")).groupBy(L.part_number(F.col("file_name")).alias("shard"))
            .agg(F.count("*").alias("n_rows"), F.count_if("down").alias("n_descents")))


# --- K10 K6 fallback: replace one month, keep the others -----------------------

@register("replace_month", O.with_(
    O.movements_ctes("jun", "(SELECT o_orderkey AS i FROM orders)", seed=2)
    + O.movements_ctes("jul", "(SELECT o_orderkey AS i FROM orders)", seed=1, start_date="2025-07-01", days=31,
                       id_offset=0),
    f"""SELECT mois, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, min(mouvement_no) AS min_no,
       max(mouvement_no) AS max_no FROM (
  SELECT strftime(date_op, '%Y-%m') AS mois, cents, mouvement_no FROM jun
  UNION ALL SELECT strftime(date_op, '%Y-%m'), cents, mouvement_no + {N_SQL} FROM jul) GROUP BY mois"""))
def replace_month(spark, sf):
    n = n_orders(spark, sf)
    idx = orders(spark, sf).select(F.col("o_orderkey").alias("i"))
    path = scratch_path(spark, "monthly")

    def month(seed, start, days, offset):
        g = movements(idx, seed=seed, start_date=start, days=days, id_offset=offset)
        return _staged(g).withColumn("mois", F.date_format("date_op", "yyyy-MM"))

    first = month(1, "2025-06-01", 30, 0).unionByName(month(1, "2025-07-01", 31, n))
    L.publish_partitioned(first, path, ["mois"], sort_col="mouvement_no")
    L.publish_partitioned(month(2, "2025-06-01", 30, 0), path, ["mois"], sort_col="mouvement_no", dynamic=True)
    t = spark.read.parquet(path)
    return t.groupBy("mois").agg(
        F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"),
        F.min("mouvement_no").alias("min_no"), F.max("mouvement_no").alias("max_no"))


# --- K8 K9: other formats, compression -----------------------------------------
FORMATS = [("orc", "orc", None), ("json", "json", None), ("csv_gzip", "csv", "gzip")]


@register("format_round_trip", O.with_(O.orders_movements(),
    "SELECT fmt, n_rows, sum_cents, min_no, max_no FROM (SELECT count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents, "
    "min(mouvement_no) AS min_no, max(mouvement_no) AS max_no FROM mv), "
    f"(VALUES {', '.join(f'({chr(39)}{f}{chr(39)})' for f, _, _ in FORMATS)}) AS t(fmt)"))
def format_round_trip(spark, sf):
    from pyspark.sql import types as T
    staged = _staged(mv(spark, sf))
    schema = T.StructType([f for f in model.STAGED_SCHEMA.fields])
    out = None
    for name, fmt, comp in FORMATS:
        path = scratch_path(spark, f"fmt_{name}")
        L.write_format(staged, path, fmt, comp)
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.option("header", True)
        back = r.schema(schema).load(path)
        agg = back.agg(F.count("*").alias("n_rows"), (F.sum("montant") * 100).cast("bigint").alias("sum_cents"),
                       F.min("mouvement_no").alias("min_no"), F.max("mouvement_no").alias("max_no"))
        agg = agg.select(F.lit(name).alias("fmt"), "*")
        out = agg if out is None else out.unionByName(agg)
    return out


# --- X4: incremental file stream raw -> staging --------------------------------

@register("stream_landing", O.with_(O.orders_movements(), f"SELECT {_TYPED_SQL} FROM mv"))
def stream_landing(spark, sf):
    from ledgerlake.streaming.landing import good_rows, ingest_available
    n = n_orders(spark, sf)
    raw, staging, ckpt = scratch_path(spark, "raw_stream"), scratch_path(spark, "staging"), scratch_path(spark, "ckpt")
    half = n // 2
    _land_rows(spark, sf, raw, half, seed=SEED, hi=half)
    ingest_available(spark, raw, staging, ckpt)
    _land_rows(spark, sf, raw, n - half, seed=SEED, lo=half, mode="append")
    ingest_available(spark, raw, staging, ckpt)  # picks up only the second landing
    return typed_out(good_rows(spark, staging))


# --- X4 R9: one row per id inside the stream ------------------------------------
# The older landing is there first; the current one, which has priority, comes in parts and late.

@register("stream_dedupe", O.with_(_two_landings_sql() + [
    "u AS (SELECT *, 'current' AS landing, 1 AS prio FROM ma UNION ALL "
    "SELECT * REPLACE (strip_accents(produit) AS produit, strip_accents(type_op) AS type_op), 'beam', 2 FROM mb)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY mouvement_no ORDER BY prio) AS rn FROM u)"],
    "SELECT mouvement_no, id_mouvement, landing, date_op, produit, type_op, montant, agence_id, pays FROM r WHERE rn = 1"))
def stream_dedupe(spark, sf):
    from ledgerlake.streaming.dedupe import PRIORITY, current_rows, dedupe_available
    n = n_orders(spark, sf)
    raw, out, ckpt = scratch_path(spark, "raw_dedupe"), scratch_path(spark, "changes"), scratch_path(spark, "ckpt")
    prio = F.when(F.col("source_file").contains("/current/"), 1).otherwise(2)
    _land_several(spark, sf, f"{raw}/beam", n, seed=2, labels="accented", start=n // 2)
    dedupe_available(spark, raw, out, ckpt, prio)
    for lo, hi in ((n // 3, None), (None, n // 3)):
        _land_several(spark, sf, f"{raw}/current/{lo or 0}", n // 3 if hi else n - n // 3, seed=1, lo=lo, hi=hi)
        dedupe_available(spark, raw, out, ckpt, prio)
    one = current_rows(spark, out)
    return one.select("mouvement_no", "id_mouvement", F.when(F.col(PRIORITY) == 1, "current").otherwise("beam").alias("landing"), "date_op", "produit", "type_op",
                      F.col("montant").cast("double").alias("montant"), "agence_id", "pays")


# --- X1: a user's own row function through Arrow batches -------------------------

@register("user_row_function", O.with_(O.orders_movements(), f"SELECT {_cols(MV_COLS)} FROM mv"))
def user_row_function(spark, sf):
    from ledgerlake.functions.rowfn import apply_row_function, movements_batch, MOVEMENT_BATCH_SCHEMA
    idx = orders(spark, sf).select(F.col("o_orderkey").alias("i"))
    out = apply_row_function(idx, lambda pdf: movements_batch(pdf["i"].to_numpy(), SEED), MOVEMENT_BATCH_SCHEMA)
    return out.select(*[F.to_date("date_op").alias("date_op") if c == "date_op" else F.col(c) for c in MV_COLS])


# --- X3 Q2 Q8 A3 P18 P19: the whole job with its metrics (clock values: no oracle)

@register("run_metrics")
def run_metrics(spark, sf):
    from ledgerlake.plans.run import JobConfig, run_job
    cfg = JobConfig(base=scratch_path(spark, "lake_run"), n_rows=n_orders(spark, sf), seed=SEED, rows_per_file=ROWS_PER_FILE)
    return run_job(spark, cfg, dealt_index(spark, sf, cfg.n_rows, cfg.shards))


@register("run_counts", f"""SELECT stage, n_rows, timed, zone, true AS labelled FROM (VALUES
  ('land_raw', {N_SQL}, true, 'raw/mouvements/<run>'), ('parse_typed', {N_SQL}, true, 'staging/mouvements/<run>'), ('quarantined', 0, false, 'staging/mouvements/<run>/reason=*'),
  ('publish', {N_SQL}, true, 'delta/mouvements'), ('contract_report', 9, true, 'quality_metrics/run_id=<run>')
) AS t(stage, n_rows, timed, zone)""")
def run_counts(spark, sf):
    """The job's counts, zones and label, and whether each stage has a throughput (clock values stay in its table)."""
    zone = F.regexp_replace(F.replace("zone", F.col("run_id"), F.lit("<run>")), r"^.*/lake_run-[0-9a-f]+/", "")
    return run_metrics(spark, sf).select("stage", "n_rows", F.coalesce(F.col("rows_per_sec") > 0, F.lit(False)).alias("timed"), zone.alias("zone"),
                                         F.col("run_id").rlike(r"^mouvements-[0-9]{8}-[0-9]{6}\z").alias("labelled"))
