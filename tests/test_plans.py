"""Plan checks: no cartesian products or nested-loop joins; range conditions
stay inside an equi-join; filters and pruning reach the scan."""

import pytest

from tidalrec.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["popularity_topk_unseen", "train_rows_labeled", "two_stage_recommend",
                                  "affinity_scores", "weighted_sample", "in_batch_softmax_loss",
                                  "ranking_metrics_per_user"])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(C.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_weighted_sample_meets_no_foreign_interval(spark):
    """Draws and intervals are merged in order: no join has a range condition on them."""
    plan = _plan(C.weighted_sample(spark, SF))
    assert "Window" in plan and not any("Join" in line and "_x" in line for line in plan.split("\n"))


def test_split_pushes_filter_and_prunes_columns(spark):
    train, _ = C.split_parts(spark, SF)
    plan = _plan(train.select("o_custkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan or "ReadSchema: struct<l_orderkey:bigint," in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
