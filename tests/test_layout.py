"""Sinks and layout: shards, compaction, partitioned publish, month replacement, formats."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.sinks import layout as L
from ledgerlake.sources.generate import index_range, movements
from ledgerlake.sources.raw import read_raw, with_source_file
from tests.conftest import plan_text


def files_of(path, ext=".csv"):
    return sorted(f for f in os.listdir(path.replace("file:", "")) if f.endswith(ext))


def test_uneven_shards_keep_remainder(spark):
    p = scratch_path(spark, "t_uneven")
    L.land_movements(spark, p, 11, 5)
    df = with_source_file(read_raw(spark, p)).withColumn("shard", L.part_number(F.col("file_name")))
    sizes = sorted((r.shard, r["count"]) for r in df.groupBy("shard").count().collect())
    assert [s for _, s in sizes] == [2, 2, 2, 2, 3]
    assert len(files_of(p)) == 5
    # the formula used by the oracle agrees with the physical layout
    calc = index_range(spark, 11, 1).select(L.shard_of("i", 11, 5).alias("s")).groupBy("s").count()
    assert sorted(r["count"] for r in calc.collect()) == [2, 2, 2, 2, 3]


def test_landing_plan_has_no_shuffle(spark):
    gen = movements(index_range(spark, 1000, 5))
    assert "Exchange" not in plan_text(gen)
    assert "WholeStageCodegen" in plan_text(gen) or "*(" in gen._jdf.queryExecution().executedPlan().treeString()


def test_compaction_one_file_per_shard(spark):
    n = 5000
    parts, out = scratch_path(spark, "t_parts"), scratch_path(spark, "t_comp")
    g = movements(index_range(spark, n, 20)).withColumn("shard", L.shard_of(F.col("mouvement_no") - 1, n, 5))
    g.write.partitionBy("shard").option("header", True).csv(parts)
    src = read_raw(spark, parts)
    L.write_csv(L.compact(src, "shard", 5).drop("shard"), out)
    assert len(files_of(out)) == 5
    assert read_raw(spark, out).count() == n


def test_partition_pruning(spark):
    p = scratch_path(spark, "t_pub")
    g = movements(index_range(spark, 4000, 4)).select("mouvement_no", "cents", "pays", "produit")
    L.publish_partitioned(g, p, ["pays", "produit"], sort_col="mouvement_no")
    q = spark.read.parquet(p).filter((F.col("pays") == "FR") & (F.col("produit") == "auto")).select("cents")
    plan = plan_text(q)
    assert "PartitionFilters: [isnotnull(pays" in plan and "ReadSchema: struct<cents:bigint>" in plan
    assert q.count() == g.filter("pays = 'FR' AND produit = 'auto'").count()


def test_dynamic_overwrite_replaces_one_partition(spark):
    p = scratch_path(spark, "t_dyn")
    g = movements(index_range(spark, 2000, 4)).select("mouvement_no", "cents", "pays")
    L.publish_partitioned(g, p, ["pays"])
    fr = g.filter("pays = 'FR'").withColumn("cents", F.lit(0).cast("bigint"))
    L.publish_partitioned(fr, p, ["pays"], dynamic=True)
    back = spark.read.parquet(p)
    assert back.count() == 2000
    assert back.filter("pays = 'FR'").agg(F.sum("cents")).first()[0] == 0
    assert back.filter("pays = 'ES'").agg(F.sum("cents")).first()[0] == g.filter("pays = 'ES'").agg(F.sum("cents")).first()[0]


def test_hot_partition_is_split_between_writers(spark):
    p = scratch_path(spark, "t_hot")
    g = movements(index_range(spark, 60_000, 6)).withColumn("pays", F.when(F.col("mouvement_no") % 3 > 0, F.lit("FR")).otherwise(F.col("pays")))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        L.publish_partitioned(g.select("mouvement_no", "cents", "date_op", "pays"), p, ["pays"], sort_col="mouvement_no")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = spark.read.parquet(p)
    assert back.count() == 60_000 and back.select("mouvement_no").distinct().count() == 60_000
    assert back.filter("pays = 'FR'").select(F.input_file_name()).distinct().count() > 3


def test_unsupported_format_is_clear(spark):
    with pytest.raises(ValueError, match="avro"):
        L.write_format(movements(index_range(spark, 1, 1)), scratch_path(spark, "t_avro"), "avro")


def test_compaction_files_per_shard(spark):
    n = 4000
    parts, out = scratch_path(spark, "t_parts2"), scratch_path(spark, "t_comp2")
    g = movements(index_range(spark, n, 8)).withColumn("shard", L.shard_of(F.col("mouvement_no") - 1, n, 2))
    g.select("id_mouvement", "mouvement_no", "shard").write.partitionBy("shard").parquet(parts)
    src = spark.read.parquet(parts)
    L.compact(src, "shard", 2, "mouvement_no", files_per_shard=3).write.parquet(out)
    back = spark.read.parquet(out).withColumn("f", F.col("_metadata.file_name"))
    assert back.count() == n
    per_file = back.groupBy("f").agg(F.countDistinct("mouvement_no").alias("n"), F.min("mouvement_no").alias("lo"))
    assert per_file.count() == 6


def test_listing_select_parts_and_lines(spark):
    from ledgerlake.sources.raw import listing, select_parts
    root = scratch_path(spark, "t_zone")
    n = 600
    g = movements(index_range(spark, n, 6)).withColumn("shard", L.shard_of(F.col("mouvement_no") - 1, n, 3))
    g.select("id_mouvement", "date_op", "produit", "type_op", "montant", "agence_id", "pays", "shard") \
        .write.partitionBy("shard").option("header", True).csv(f"{root}/parts")
    top = listing(spark, root, 2, glob="*.csv").collect()
    assert len(top) == 2 and top[0].path < top[1].path
    one = select_parts(read_raw(spark, f"{root}/parts"), "shard=1/")
    assert one.count() == 200
    line = L.csv_line(g, ["id_mouvement", "pays"])
    assert g.select(line.alias("v")).orderBy("v").first().v.startswith("M0000001,")


def test_table_format_falls_back(spark):
    assert L.table_format(spark) in ("delta", "parquet")
    assert L.table_format(spark, "no_such_format_xyz") == "parquet"


def test_neighbours_are_merged_without_a_shuffle(spark):
    from ledgerlake.functions.columns import parse_id
    from ledgerlake.sources.raw import CSV_FILES, inventory
    assert list(L.neighbour_groups([("a/1", 5), ("a/2", 5), ("a/3", 1), ("a/4", 99), ("b/1", 1), ("b/2", 1)], 10)) == [["a/1", "a/2"], ["a/3"], ["a/4"], ["b/1", "b/2"]]
    parts, out = scratch_path(spark, "parts"), scratch_path(spark, "merged")
    L.land_movements(spark, parts, 3000, 30)
    read = lambda paths: read_raw(spark, paths).withColumn("no", parse_id("id_mouvement"))
    plans = []

    def write(df):
        plans.append(plan_text(df))
        L.write_csv(df.drop("no"), out, mode="append")

    files = inventory(spark, parts, glob=CSV_FILES)
    bound = 4 * max(r.length for r in files.collect())
    n = L.compact_files(files, read, write, "no", target_bytes=bound, wave=3)
    made = inventory(spark, out, glob=CSV_FILES).collect()
    assert len(made) == n == 8 and max(r.length for r in made) <= bound and len(plans) == 3 and not any("Exchange" in p for p in plans)
    back = with_source_file(read(out))
    assert back.count() == 3000 and back.groupBy("file_name").agg((F.max("no") - F.min("no") + 1).alias("w"), F.count("*").alias("n")).filter("w <> n").count() == 0
    lines = [int(r.value[1:8]) for r in spark.read.text(made[0].path).collect()[1:]]
    assert lines == sorted(lines)
    assert L.compact_files(files.limit(0), read, write, "no") == 0


def test_a_wave_of_groups_is_read_and_listed_once(spark, tmp_path):
    from ledgerlake.sources.raw import CSV_FILES, inventory
    parts, out, reads = str(tmp_path / "pa rts%20"), str(tmp_path / "out"), []
    L.land_movements(spark, parts, 600, 6)

    def read(paths):
        reads.append(paths)
        return read_raw(spark, paths)

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    files = inventory(spark, parts, glob=CSV_FILES)
    n = L.compact_files(files, read, lambda df: L.write_csv(df, out, mode="append"), "id_mouvement", target_bytes=2 * max(r.length for r in files.collect()), wave=2)
    assert n == 3 and [len(r) for r in reads] == [4, 2] and spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    assert sorted(map(tuple, read_raw(spark, out).collect())) == sorted(map(tuple, read_raw(spark, parts).collect()))
    assert inventory(spark, out, glob=CSV_FILES).count() == 3


def test_a_task_writes_the_files_of_many_shards(spark, tmp_path):
    from ledgerlake.plans.catalogue import dealt_index
    spark.range(100).select(F.col("id").alias("o_orderkey")).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    index = dealt_index(spark, str(tmp_path), 100, 10, per_task=4)
    assert [sorted(r.i for r in p) for p in index.rdd.glom().collect()] == [[*range(40)], [*range(40, 80)], [*range(80, 100)]]
    L.write_csv(index.withColumn("shard", F.floor(F.col("i") / 10)).sortWithinPartitions("shard", "i"), str(tmp_path / "out"), by="shard", file_rows=6)
    got = {}
    for f in sorted((tmp_path / "out").glob("shard=*/*.csv")):
        got.setdefault(int(f.parent.name[6:]), []).append([int(x) for x in f.read_text().split()[1:]])
    assert got == {s: [[*range(10 * s, 10 * s + 6)], [*range(10 * s + 6, 10 * s + 10)]] for s in range(10)}


def test_a_file_is_replaced_without_landing_the_others(spark, tmp_path, monkeypatch):
    from ledgerlake.plans import files as P
    landed, land = [], P._land_rows
    monkeypatch.setattr(P, "_land_rows", lambda spark, sf, path, n, **kw: (landed.append(n), land(spark, sf, path, n, **kw)))
    for n, keys in ((5000, range(0, 5000)), (900, range(0, 1800, 2))):
        sf, folder = tmp_path / f"t{n}", str(tmp_path / f"f{n}")
        spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(sf / "orders.parquet"))
        land(spark, str(sf), folder, n, seed=1)
        land(spark, str(sf), folder + "w", n, seed=3)
        P._replace_first_file(spark, str(sf), n, folder)
        first = lambda path: next(path.glob("part-00000*.csv")).read_text()
        assert first(tmp_path / f"f{n}") == first(tmp_path / f"f{n}w")
    assert landed == [1666, 900]


def test_named_files_are_there_whole_or_not_at_all(spark):
    import json
    from ledgerlake import files
    from ledgerlake.sinks.named import RECORD, land_named
    path = scratch_path(spark, "named")
    rows = movements(index_range(spark, 1000, 4)).select("id_mouvement", "pays")
    assert land_named(rows, path, 4) == [f"mouvements-{k:05d}-of-00004.csv" for k in range(4)]
    before = files.names(spark, path)
    assert json.loads(files.read_text(spark, f"{path}/{RECORD}")).keys() == {n for n in before if n != RECORD}
    dies = rows.withColumn("pays", F.when(F.col("id_mouvement") == "M0000900", F.raise_error(F.lit("lost"))).otherwise("XX").cast("string"))
    with pytest.raises(Exception, match="lost"):
        land_named(dies, path, 4)
    assert files.names(spark, path) == before and spark.read.option("header", True).csv(path).filter("pays = 'XX'").count() == 0
    with pytest.raises(ValueError, match="more tasks"):
        land_named(rows, path, 3)
    assert land_named(rows, path, 4, beam=True, compression="gzip") == [f"mouvements-{k:02d}-of-04.csv.gz" for k in range(4)]
    assert spark.read.option("header", True).option("pathGlobFilter", "*.gz").csv(path).count() == 1000
