"""Dirty inputs (FIXTURES.md D) through the raw readers and ingestion operators."""

from pyspark.sql import functions as F

from ledgerlake.functions.columns import has_replacement_char
from ledgerlake.operators import ingest as I
from ledgerlake.operators.dedupe import keep_first, union_landings
from ledgerlake.operators import quality as Q
from ledgerlake.sources.raw import inventory, read_lines, read_raw, with_source_file

HEADER = "id_mouvement,date_op,produit,type_op,montant,agence_id,pays"
GOOD = "M0000001,2025-06-06,auto,provision_sinistre,8944.6,AG_007,FR"


def write(path, name, text, mode="w", encoding="utf-8"):
    path.mkdir(parents=True, exist_ok=True)
    p = path / name
    if isinstance(text, bytes):
        p.write_bytes(text)
    else:
        with open(p, mode, encoding=encoding, newline="") as f:
            f.write(text)
    return str(path)


def typed(spark, d, **kw):
    return I.type_movements(read_raw(spark, d, shape=True, **kw))


def reasons(df):
    return {r.id_mouvement: r.reason for r in df.collect()}


def test_short_bad_date_bad_number(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", "\n".join([
        HEADER, GOOD,
        "M0000002,2025-06-15,sante,cotisation,1250.75,AG_012",
        "M0000003,2025-06-31,sante,cotisation,1250.75,AG_012,ES",
        "M0000004,2025-06-15,sante,cotisation,x,AG_012,ES",
    ]) + "\n")
    got = reasons(typed(spark, d))
    assert got == {"M0000001": "ok", "M0000002": "short_row", "M0000003": "bad_date", "M0000004": "bad_number"}
    good, bad = I.split_quarantine(typed(spark, d))
    assert good.count() == 1 and bad.count() == 3


def test_crlf_reads_clean(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", HEADER + "\r\n" + GOOD + "\r\n")
    r = typed(spark, d).first()
    assert r.reason == "ok" and r.pays == "FR" and r.cents == 894460


def test_repeated_header_dropped(spark, tmp_path):
    d = write(tmp_path / "z", "a.txt", "\n".join([HEADER, GOOD, HEADER, GOOD.replace("M0000001", "M0000002")]) + "\n")
    lines = read_lines(spark, d)
    kept = I.drop_repeated_headers(lines)
    assert lines.count() == 4 and kept.count() == 2
    assert [r.id_mouvement for r in I.split_line(kept).orderBy("id_mouvement").collect()] == ["M0000001", "M0000002"]


def test_bad_bytes_flagged(spark, tmp_path):
    body = (HEADER + "\n" + GOOD + "\n").encode() + b"M0000002,2025-06-15,sant\xe9,cotisation,1.0,AG_001,FR\n" \
        + b"M0000003,2025-06-15,sant\xc3,cotisation,1.0,AG_001,FR\n"
    d = write(tmp_path / "z", "a.csv", body)
    rep = I.utf8_report(read_lines(spark, d)).first()
    assert rep.n_lines == 4 and rep.n_invalid_lines == 2
    parsed = read_raw(spark, d)
    assert parsed.filter(has_replacement_char("produit")).count() == 2


def test_mojibake_repaired(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", HEADER + "\nM0000001,2025-06-06,santÃ©,rÃ©gularisation,1.5,AG_001,FR\n")
    r = typed(spark, d).first()
    assert (r.produit, r.type_op) == ("sante", "regularisation")


def test_accents_folded(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", HEADER + "\nM0000001,2025-06-06,santé,pénalité_résiliation,15.0,AG_001,FR\n")
    r = typed(spark, d).first()
    assert (r.produit, r.type_op) == ("sante", "penalite_resiliation")


def test_unknown_label_and_out_of_bounds(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", "\n".join([
        HEADER,
        "M0000001,2025-06-06,auto,inconnu,50.0,AG_001,FR",      # default rule 10..1000: in bounds
        "M0000002,2025-06-06,auto,cotisation,9999.99,AG_001,FR",  # 50..2500: breach
        "M0000003,2025-06-06,auto,inconnu,5.0,AG_001,FR",       # default rule: breach
    ]) + "\n")
    t = typed(spark, d)
    flagged = sorted(r.mouvement_no for r in Q.anomalies_bounds(t).collect())
    assert flagged == [2, 3]
    rep = {r.rule: r.n_breaches for r in Q.contract_report(t).collect()}
    assert rep["type_op_domain"] == 2 and rep["amount_bounds"] == 2 and rep["id_unique"] == 0


def test_id_width_numeric_order(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", "\n".join([HEADER] + [
        f"{i},2025-06-06,auto,cotisation,50.0,AG_001,FR" for i in ["M10000001", "M9999999", "M10000000"]]) + "\n")
    t = typed(spark, d)
    assert [r.mouvement_no for r in t.orderBy("mouvement_no").collect()] == [9999999, 10000000, 10000001]
    assert {r.rule: r.n_breaches for r in Q.contract_report(t).collect()}["id_gaps"] == 0


def test_double_landing_priority(spark, tmp_path):
    a = write(tmp_path / "a", "a.csv", HEADER + "\nM0000001,2025-06-06,sante,retrocession,100.0,AG_001,FR\n")
    b = write(tmp_path / "b", "b.csv", HEADER + "\nM0000001,2025-06-07,santé,rétrocession,200.0,AG_002,ES\n"
              "M0000002,2025-06-07,vie,cotisation,60.0,AG_002,ES\n")
    ra = with_source_file(read_raw(spark, a)).withColumn("prio", F.lit(1))
    rb = with_source_file(read_raw(spark, b)).withColumn("prio", F.lit(2))
    one = keep_first(I.type_movements(union_landings(ra, rb)), "mouvement_no", ["prio", "file_name"])
    got = {r.mouvement_no: (r.cents, r.produit, r.type_op) for r in one.collect()}
    assert got == {1: (10000, "sante", "retrocession"), 2: (6000, "vie", "cotisation")}


def test_gitkeep_ignored(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", HEADER + "\n" + GOOD + "\n")
    write(tmp_path / "z", ".gitkeep", "")
    assert read_raw(spark, d).count() == 1
    assert inventory(spark, d).count() == 1


def test_dedupe_keeps_rows_without_id(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", "\n".join([
        HEADER, GOOD, GOOD,
        "X1,2025-06-06,auto,cotisation,50.0,AG_001,FR",
        "X2,2025-06-06,auto,cotisation,60.0,AG_001,FR",
    ]) + "\n")
    t = with_source_file(read_raw(spark, d))
    one = keep_first(I.type_movements(t), "mouvement_no", ["file_name"])
    assert one.count() == 3  # the two unparseable ids both survive; the duplicate id collapses


def test_domain_anti_join_equals_in_list(spark):
    from ledgerlake import model
    from ledgerlake.plans import catalogue as C
    from tests.conftest import SF0001
    t = C.planted(spark, SF0001)
    rep = {r.rule: r.n_breaches for r in Q.contract_report(t).collect()}
    assert t.join(model.products_df(spark), "produit", "left_anti").count() == rep["produit_domain"]
    assert t.join(model.countries_df(spark), "pays", "left_anti").count() == rep["pays_domain"]
    assert t.join(model.agencies_df(spark), "agence_id", "left_anti").count() == rep["agence_domain"]
    assert rep["produit_domain"] > 0


def test_cut_lineage_reliable_checkpoint(spark):
    from ledgerlake.plans import catalogue as C
    from ledgerlake.session import cut_lineage
    from tests.conftest import SF0001
    df = C.gen_movements(spark, SF0001)
    cut = cut_lineage(df)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))
    assert "Scan parquet" not in cut._jdf.queryExecution().executedPlan().toString()


def test_long_row_quarantined(spark, tmp_path):
    d = write(tmp_path / "z", "a.csv", "\n".join([HEADER, GOOD + ",EXTRA", GOOD.replace("M0000001", "M0000002")]) + "\n")
    assert reasons(typed(spark, d)) == {"M0000001": "long_row", "M0000002": "ok"}


def test_quarantine_keeps_the_line_as_read(spark, tmp_path):
    from ledgerlake.streaming.landing import ingest_available, quarantined
    bad = [GOOD + ",8,9,10", GOOD + ",,9", "M0000001,2025-06-06,auto", "M0000001", "M0000001,2025-06-06,auto,cotisation", "M0000001,2025-06-06,auto,cotisation,1.0",
           'M0000001,"6 June, 2025","au""to",cotisation,1.0,AG_001,FR', '"M0000001",2025-06-06,"a,b",cotisation, x ,AG_001,FR', GOOD + ',"8, ""q""",9',
           "M0000001,2025-06-06,a\x01b,cotisation,x,AG_001,FR", "M0000001,2025-06-06,santé,cotisation,x,AG_001,FR"]
    good = ['"M0000002",2025-06-06,"auto",cotisation,1.0,"AG,,,,,,,_001",FR,', GOOD]
    d = write(tmp_path / "z", "a.csv", "\r\n".join([HEADER, *bad[:5], "", *good, *bad[5:]]) + "\r\n")
    latin = write(tmp_path / "l", "a.csv", "\n".join([HEADER, *bad, *good]).encode("latin-1"))
    for df in (typed(spark, d), typed(spark, d, recursive=True), typed(spark, latin, encoding="ISO-8859-1")):
        rows = df.collect()
        assert sorted(r.raw_line for r in rows if r.reason != "ok") == sorted(bad)
        assert [(r.mouvement_no, r.produit, r.pays, r.raw_line) for r in sorted((r for r in rows if r.reason == "ok"), key=lambda r: r.mouvement_no)] == [(1, "auto", "FR", None), (2, "auto", "FR", None)]
    staging = str(tmp_path / "staging")
    ingest_available(spark, d, staging, str(tmp_path / "ckpt"))
    assert sorted(r.raw_line for r in quarantined(spark, staging).collect()) == sorted(bad)


def test_strict_date_parse(spark):
    from ledgerlake.functions.columns import parse_date_strict
    vals = ["2025-06-01", "2025-06-31", "2025-6-01", "2025-06-1", "2025-06-01x", " 2025-06-1", "+025-06-01",
            "2025-13-01", "2025/06/01", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r.p for r in df.select(parse_date_strict("d").alias("p")).collect()]
    assert str(got[0]) == "2025-06-01" and all(g is None for g in got[1:])
    ref = [r.p for r in df.select(F.try_to_date("d", "yyyy-MM-dd").alias("p")).collect()]
    assert got == ref
