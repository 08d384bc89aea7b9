"""Id runs, dedupe by zone maps, mergeable statistics, robust anomalies, alerts."""

import random
import statistics
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.operators import moments as M
from ledgerlake.operators import quality as Q
from ledgerlake.operators.alerts import cusum_alerts
from ledgerlake.operators.dedupe import files_with_repeats, keep_first, keep_first_by_zones
from ledgerlake.operators.robust import anomalies_mad, double_medians
from ledgerlake.operators.runs import fold, id_rules, id_runs, task_runs
from ledgerlake.operators.scan import ordered_scan
from ledgerlake.session import scratch_path
from tests.conftest import plan_text


def brute_runs(ids):
    n, out = Counter(ids), []
    for no in range(min(n), max(n) + 1) if n else ():
        if out and out[-1][2] == n[no]:
            out[-1][1] = no
        else:
            out.append([no, no, n[no]])
    return [tuple(x) for x in out]


def test_id_runs_equal_a_count_per_id(spark):
    r = random.Random(3)
    for ids in ([], [5], [1, 2, 3, 7, 7, 8], [r.randrange(300) for _ in range(200)], [*range(1000, 3000), *range(1500, 1700), 1500, -4, 10**15]):
        df = spark.createDataFrame([(i,) for i in [*ids, None]], "mouvement_no long").repartition(5)
        if max(ids, default=0) < 10**6:
            assert sorted(map(tuple, id_runs(df).collect())) == brute_runs(ids)
        rules = id_rules(df).first()
        assert rules.n_distinct == len(set(ids)) and rules.id_unique == len(ids) - len(set(ids))
        assert rules.id_gaps == (max(ids) - min(ids) + 1 - len(set(ids)) if ids else 0)


def test_contiguous_ids_are_few_runs(spark):
    df = spark.range(0, 200_000, 1, 4).withColumnRenamed("id", "mouvement_no")
    assert task_runs(df, "mouvement_no").count() <= 4 * 2
    plan = plan_text(id_runs(df))
    assert "hashpartitioning(mouvement_no" not in plan
    assert fold(np.array([3, 1, 2, 2, 9])).tolist() == [[1, 1, 1], [2, 2, 2], [3, 3, 1], [9, 9, 1]]


def test_ordered_scan_over_many_tasks(spark):
    r = random.Random(4)
    rows = [(r.randrange(500), r.randrange(-9, 9), r.choice([None, *range(100)])) for _ in range(900)]
    got = ordered_scan(spark.createDataFrame(rows, "at long, step long, end long"), "at", sums={"total": "step"}, greatest={"reach": "end"}, following="next").collect()
    keys = sorted({a for a, *_ in rows})
    for x in got:
        assert x.total == sum(s for a, s, _ in rows if a <= x["at"])
        assert x.reach == max((e for a, _, e in rows if a <= x["at"] and e is not None), default=None)
        assert x.next == next((k for k in keys if k > x["at"]), None)
    assert len(got) == 900


def test_next_keys_come_from_frames_that_grow(spark):
    df = spark.range(100).select(F.col("id").alias("at"), F.lit(1).alias("step"))
    scanned = ordered_scan(df, "at", sums={"n": "step"}, following="next")
    assert "unboundedfollowing" not in plan_text(scanned).lower()  # such a frame is computed anew for every row
    assert sorted(map(tuple, scanned.collect())) == [(k, 1, k + 1, k + 1 if k < 99 else None) for k in range(100)]


def test_only_files_that_can_repeat_an_id_are_shuffled(spark):
    path = scratch_path(spark, "zones")
    ids = [*range(0, 4000), *range(3500, 3600), 17, None, None]  # ranges of 1000; the last file holds repeats of two of them
    rows = spark.createDataFrame([(no, k, "x", 1) for k, no in enumerate(ids)], "mouvement_no long, prio long, file_path string, __n int")
    for lo in range(0, 4000, 1000):
        rows.filter(F.col("prio").between(lo, lo + 999)).coalesce(1).write.mode("append").parquet(path)
    rows.filter("prio >= 4000").coalesce(1).write.mode("append").parquet(path)
    staged = spark.read.parquet(path)
    assert files_with_repeats(staged, "mouvement_no").count() == 3  # 0..999, 3000..3999 and the last: 1000..2999 pass
    out = keep_first_by_zones(staged, "mouvement_no", ["prio"])
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, keep_first(staged, "mouvement_no", ["prio"]).collect()), key=key) and out.count() == 4002
    plan = plan_text(out)
    assert "LeftAnti" in plan and "LeftSemi" in plan
    window = plan.split("== Initial Plan ==")[0]
    window = window[window.index("Window "):]
    assert "LeftSemi" in window and "LeftAnti" not in window  # the shuffle's input is the files that overlap


def test_deviation_does_not_cancel(spark):
    cents = [999_999_999_990 + k % 2 for k in range(40)]
    df = spark.createDataFrame([("cotisation", c, "AG_001") for c in cents] + [("commission", -c, "AG_002") for c in cents[:3]] + [("one", 5, "AG_001"), ("none", None, "AG_001")], "type_op string, cents long, agence_id string")
    got = {r.type_op: r for r in Q.stats_by_type(df).collect()}
    assert abs(got["cotisation"].sd_montant * 100 - statistics.stdev(cents)) < 1e-12
    assert abs(got["commission"].sd_montant * 100 - statistics.stdev(cents[:3])) < 1e-12 and got["one"].sd_montant is None and got["none"].avg_montant is None


def test_states_merge_in_any_grouping(spark):
    r = random.Random(6)
    rows = [(f"m{r.randrange(5)}", r.choice(["a", "b"]), r.randrange(-10**12, 10**12), f"AG_{r.randrange(30)}") for _ in range(4000)]
    df = spark.createDataFrame(rows, "mois string, type_op string, cents long, agence_id string")
    states = M.month_state(df, ["mois", "type_op"])
    half = M.merge_states(states.filter("mois < 'm2'"), ["type_op"]).unionByName(M.merge_states(states.filter("mois >= 'm2'"), ["type_op"]))
    whole, merged, nested = (sorted(map(tuple, M.report(s).drop("q25_cents", "q50_cents", "q75_cents", "n_labels").select("type_op", "n_rows", "min_cents", "max_cents", "sum_cents", "mean_cents", "sd_cents").collect()))
                             for s in (M.month_state(df, ["type_op"]), M.merge_states(states, ["type_op"]), M.merge_states(half, ["type_op"])))
    assert whole == merged == nested
    for x in M.report(M.merge_states(half, ["type_op"])).collect():
        mine = sorted(c for _, t, c, _ in rows if t == x.type_op)
        assert x.n_labels == 30 and abs(x.sd_cents / statistics.stdev(mine) - 1) < 1e-9
        for p in (25, 50, 75):
            assert abs(sum(c <= x[f"q{p}_cents"] for c in mine) / len(mine) - p / 100) < 0.03


def test_medians_are_exact(spark):
    r = random.Random(7)
    values = {"cotisation": [r.randrange(-10**12, 10**12) for _ in range(1001)], "commission": [r.choice([5, 5, 6, 10**9]) for _ in range(200)], "bonus_malus": [7], "frais_gestion": [-3, 8]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in [*vs, None]], "type_op string, cents long").repartition(4)
    got = double_medians(df, F.col("type_op"), F.col("cents"))
    assert got == {g: round(2 * statistics.median(v)) for g, v in values.items()}
    assert double_medians(df.limit(0), F.col("type_op"), F.col("cents")) == {} and anomalies_mad(df.limit(0)).count() == 0


def test_outliers_do_not_hide_each_other(spark):
    rows = [(k, "cotisation", 10_000 + k % 200) for k in range(1000)] + [(2000 + k, "cotisation", 5_000_000) for k in range(120)] + [(3000, "inconnu", 1), (3001, "inconnu", None)]
    df = spark.createDataFrame(rows, "mouvement_no long, type_op string, cents long")
    assert {x.mouvement_no for x in anomalies_mad(df).collect()} == {2000 + k for k in range(120)}
    assert Q.anomalies_zscore(df).count() == 0


def test_cusum_follows_its_recursion(spark):
    r = random.Random(9)
    rates = {"drift": [1000] * 8 + [9000] * 4, "burst": [1000] * 5 + [9000] + [1000] * 6, "noise": [r.randrange(0, 4000) for _ in range(12)]}
    rows = [(rule, k, 1_000_000, v) for rule, vs in rates.items() for k, v in enumerate(vs)] + [("burst", 12, 0, 0)]
    got = {(x.rule, x.run): x for x in cusum_alerts(spark.createDataFrame(rows, "rule string, run int, n_checked long, n_breaches long")).collect()}
    for rule, vs in rates.items():
        base, s = sum(vs[:4]) // 4, 0
        for k, v in enumerate(vs):
            s = max(0, s + v - base - 2000) if k >= 4 else 0
            assert got[rule, k].cusum == s and got[rule, k].alert == (s > 10_000)
    assert [k for k in range(12) if got["drift", k].alert] == [9, 10, 11] and not any(got["burst", k].alert for k in range(13)) and got["burst", 12].per_million is None
