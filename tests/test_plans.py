"""Physical plan shape of the operators that matter at scale."""

from ledgerlake.operators import quality as Q
from ledgerlake.operators.dedupe import keep_first
from ledgerlake.plans import catalogue as C
from tests.conftest import SF0001, plan_text


def test_generator_single_stage(spark):
    plan = plan_text(C.gen_movements(spark, SF0001))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_anomaly_join_broadcasts_bounded_side(spark):
    plan = plan_text(C.anomaly_zscore(spark, SF0001))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_stats_partial_aggregation(spark):
    plan = plan_text(C.stats_by_type(spark, SF0001))
    assert "partial_sum" in plan and "partial_count" in plan


def test_dedupe_limits_before_shuffle(spark):
    df = C.mv(spark, SF0001).select("mouvement_no", "cents")
    one = keep_first(df.unionByName(df), "mouvement_no", ["cents"])
    assert one.count() == 1500
    assert "WindowGroupLimit" in plan_text(one)


def test_contract_report_no_join(spark):
    plan = plan_text(C.contract_report(spark, SF0001))
    assert "Join" not in plan


def test_domain_checks_are_literal_sets(spark):
    plan = plan_text(Q.anomalies_bounds(C.planted(spark, SF0001)))
    assert "Join" not in plan and "Exchange" not in plan
