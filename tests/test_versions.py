"""Published months: whole, atomic, one live folder each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake import files
from ledgerlake.session import scratch_path
from ledgerlake.sinks import versions as V

DAY = dt.date


def rows(spark, days, n=10):
    made = [(d, k, c) for d in days for k, c in ((i, "FR" if i % 2 else "ES") for i in range(n))]
    return spark.createDataFrame(made, "date_op date, mouvement_no long, pays string")


def publish(spark, root, days, first, last, run="r", n=10):
    return V.publish_days(rows(spark, days, n), root, first, last, run, ("pays",))


def counts(df):
    return {str(r.date_op): r.n for r in df.groupBy("date_op").agg(F.count("*").alias("n")).collect()}


def test_a_write_that_dies_leaves_the_old_month(spark):
    root = scratch_path(spark, "versions")
    june = DAY(2025, 6, 1), DAY(2025, 6, 30)
    publish(spark, root, [DAY(2025, 6, 5)], *june)
    dies = rows(spark, [DAY(2025, 6, 6)], 400).repartition(8).withColumn("mouvement_no", F.when(F.col("mouvement_no") == 399, F.raise_error(F.lit("executor lost"))).otherwise(F.col("mouvement_no")).cast("long"))
    with pytest.raises(Exception, match="executor lost"):
        V.publish_days(dies, root, *june, "dies", ("pays",))
    assert counts(V.read_months(spark, root)) == {"2025-06-05": 10} and V.versions(spark, root) == [1]
    with pytest.raises(V.OutsideWindow):
        publish(spark, root, [DAY(2025, 6, 6), DAY(2025, 7, 1)], *june)
    assert counts(V.read_months(spark, root)) == {"2025-06-05": 10}
    # The dead runs' folders go with the next clean-up; live ones stay.
    assert len(V.expire(spark, root)) >= 1 and counts(V.read_months(spark, root)) == {"2025-06-05": 10}


def test_days_outside_the_window_are_carried_over(spark):
    root = scratch_path(spark, "versions")
    publish(spark, root, [DAY(2025, 6, 5), DAY(2025, 6, 25), DAY(2025, 7, 25)], DAY(2025, 6, 1), DAY(2025, 7, 31))
    publish(spark, root, [DAY(2025, 6, 26), DAY(2025, 7, 2)], DAY(2025, 6, 20), DAY(2025, 7, 19), n=3)
    assert counts(V.read_months(spark, root)) == {"2025-06-05": 10, "2025-06-26": 3, "2025-07-02": 3, "2025-07-25": 10}
    assert counts(V.read_months(spark, root, 1)) == {"2025-06-05": 10, "2025-06-25": 10, "2025-07-25": 10}
    # A whole month replaced by nothing is empty; the other month stays, partitions are pruned by folder.
    V.publish_days(rows(spark, [DAY(2025, 6, 1)]).limit(0), root, DAY(2025, 6, 1), DAY(2025, 6, 30), "none", ("pays",))
    table = V.read_months(spark, root)
    assert counts(table) == {"2025-07-02": 3, "2025-07-25": 10} and table.columns == ["date_op", "mouvement_no", "version", "mois", "pays"]
    V.publish_days(rows(spark, [DAY(2025, 7, 1)]).limit(0), root, DAY(2025, 7, 1), DAY(2025, 7, 31), "none", ("pays",))
    assert V.read_months(spark, root).count() == 0 and V.read_months(spark, root).columns == table.columns


def test_two_runs_at_once(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    publish(spark, root, [DAY(2025, 6, 5)], DAY(2025, 6, 1), DAY(2025, 6, 30))
    plain = V.L.publish_partitioned

    def meanwhile(days, first, last):
        def write(*args, **kw):
            monkeypatch.setattr(V.L, "publish_partitioned", plain)
            publish(spark, root, days, first, last, "other", n=2)
            plain(*args, **kw)
        return write

    monkeypatch.setattr(V.L, "publish_partitioned", meanwhile([DAY(2025, 7, 5)], DAY(2025, 7, 1), DAY(2025, 7, 31)))
    publish(spark, root, [DAY(2025, 6, 6)], DAY(2025, 6, 1), DAY(2025, 6, 30), n=4)
    assert counts(V.read_months(spark, root)) == {"2025-06-06": 4, "2025-07-05": 2}
    monkeypatch.setattr(V.L, "publish_partitioned", meanwhile([DAY(2025, 6, 7)], DAY(2025, 6, 1), DAY(2025, 6, 30)))
    with pytest.raises(V.Conflict):
        publish(spark, root, [DAY(2025, 6, 8)], DAY(2025, 6, 1), DAY(2025, 6, 30))
    assert counts(V.read_months(spark, root)) == {"2025-06-07": 2, "2025-07-05": 2}


def test_records_are_put_whole_or_not_at_all(spark):
    path = f"{scratch_path(spark, 'records')}/a.json"
    assert files.read_text(spark, path) is None and files.names(spark, path) == []
    files.put_text(spark, path, "é1")
    with pytest.raises(files.Exists):
        files.put_text(spark, path, "2")
    files.put_text(spark, path, "3", replace=True)
    assert files.read_text(spark, path) == "3" and files.names(spark, path.rsplit("/", 1)[0]) == ["a.json"]
    with pytest.raises(FileNotFoundError):
        V.read_months(spark, scratch_path(spark, "nothing"))
