"""Files read by their own headers, refused as a whole, never cut."""

import pytest

from ledgerlake import model
from ledgerlake.functions.columns import field_count
from ledgerlake.operators import ingest as I
from ledgerlake.operators.incremental import new_files, read_manifest, record_manifest
from ledgerlake.sources import headers as H
from ledgerlake.sources.raw import CSV_FILES, inventory

HEADER = ",".join(model.COLUMNS)
ROW = "M0000001,2025-06-01,auto,cotisation,60.5,AG_001,FR"


def read(spark, tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    rows = I.type_movements(H.read_by_header(spark, str(tmp_path)))
    return {name: sorted((r.reason, r.id_mouvement if r.reason == "ok" else None, r.pays if r.reason == "ok" else None, r.raw_line) for r in rows.collect() if r.file_name == f"{name}.csv") for name in files}


def test_headers_of_all_kinds(spark, tmp_path):
    ok = ("ok", "M0000001", "FR", None)
    turned = "pays,agence_id,montant,type_op,produit,date_op,id_mouvement"
    back = ",".join(reversed(ROW.split(",")))
    got = read(spark, tmp_path, plain=f"{HEADER}\n{ROW}\n{HEADER}\n{ROW}\n", spelled=f'﻿"ID_Mouvement", {HEADER.split(",", 1)[1].upper()}\n{ROW}\n', turned=f"{turned}\n{back}\n{turned}\n", bare=f"{ROW}\n{ROW}\n",
               wide=f"note,{turned}\n\"a, b\",{back}\n,{back}\nx,{back},y\nx\n", foreign=f"ref,jour\nM0000001,2025-06-01\n", part=f"{HEADER.rsplit(',', 1)[0]}\n{ROW.rsplit(',', 1)[0]}\n",
               twice=f"{HEADER},pays\n{ROW},FR\n", empty="", only=f"{HEADER}\n", blank=f"\n\n{ROW}\n")
    assert got["plain"] == [ok, ok] and got["spelled"] == [ok] and got["turned"] == [ok] and got["bare"] == [ok, ok] and got["blank"] == [ok]
    assert got["wide"] == sorted([("long_row", None, None, f"x,{back},y"), ok, ok, ("short_row", None, None, "x")], key=str) or sorted(map(str, got["wide"])) == sorted(map(str, [("long_row", None, None, f"x,{back},y"), ok, ok, ("short_row", None, None, "x")]))
    assert [(r, line) for r, *_, line in got["foreign"]] == [("foreign_header", "M0000001,2025-06-01"), ("foreign_header", "ref,jour")]
    assert {r for r, *_ in got["part"]} == {r for r, *_ in got["twice"]} == {"foreign_header"} and len(got["part"]) == len(got["twice"]) == 2
    assert got["empty"] == got["only"] == []


def test_a_file_of_many_splits_has_one_header(spark, tmp_path):
    turned = "pays,agence_id,montant,type_op,produit,date_op,id_mouvement"
    back = ",".join(reversed(ROW.split(",")))
    (tmp_path / "a.csv").write_text(turned + "\n" + f"{back}\n" * 4000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        rows = I.type_movements(H.read_by_header(spark, str(tmp_path)))
        assert rows.rdd.getNumPartitions() > 5 and rows.filter("reason = 'ok' and pays = 'FR'").count() == rows.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_exceptions_join_without_a_hint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "FEW", 1)
    got = read(spark, tmp_path, a=f"{ROW}\n", b=f"{ROW}\n", c=f"{HEADER}\n{ROW}\n", d="x\n")
    assert [[r for r, *_ in got[k]] for k in "abcd"] == [["ok"], ["ok"], ["ok"], ["foreign_header"]]


def test_an_empty_field_is_not_a_missing_one(spark, tmp_path):
    cut = ROW.rsplit(",", 1)[0]
    got = read(spark, tmp_path, a=f"{HEADER}\n{cut},\n{cut}\n{ROW.replace('auto', '')}\n{ROW},\n")
    assert [(r, line) for r, *_, line in got["a"]] == [("empty_field", ROW.replace("auto", "")), ("empty_field", f"{cut},"), ("long_row", f"{ROW},"), ("short_row", cut)]


@pytest.mark.parametrize("line, n", [("a,b", 2), ("", 1), (",", 2), ('"a,b",c', 2), ('a,"b ""x, y""",c', 3), ('a"b,c"', 2), ('"a,b', 2), ('"",""', 2), (r'"a, \"b\", c",d', 2)])
def test_field_count(spark, line, n):
    assert spark.createDataFrame([(line,)], "l string").select(field_count("l")).first()[0] == n


def test_other_files_and_replaced_ones(spark, tmp_path):
    for name in ("a.csv", "b.csv.gz", "c.csv.bak", "d.csv~", "e.csvx"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r.path.rsplit("/", 1)[1] for r in inventory(spark, str(tmp_path), glob=CSV_FILES).collect()) == ["a.csv", "b.csv.gz"]
    manifest = str(tmp_path / "manifest")
    record_manifest(spark, new_files(spark, str(tmp_path), read_manifest(spark, manifest)), manifest)
    assert new_files(spark, str(tmp_path), read_manifest(spark, manifest)).count() == 0
    (tmp_path / "a.csv").write_bytes(b"yy")
    assert [r.path.rsplit("/", 1)[1] for r in new_files(spark, str(tmp_path), read_manifest(spark, manifest)).collect()] == ["a.csv"]
