"""Plan-shape checks: the physical plans the scale notes in the README rely on."""

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filter(spark, sf_dir):
    plan = _plan(E.queries()["scan_table"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_training_set_answers_both_asof_lookups_in_one_window(spark, sf_dir):
    plan = _plan(E.queries()["training_set"](spark, sf_dir))
    windows = [ln for ln in plan.splitlines() if "Window [last(_f0" in ln]
    assert len(windows) == 1 and "last(_f1" in windows[0]


def test_top_n_uses_group_limit_before_shuffle(spark, sf_dir):
    df = E.queries()["top_n_per_group"](spark, sf_dir)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString() or \
        "WindowGroupLimit" in _plan(df)


def test_top_k_is_take_ordered(spark, sf_dir):
    assert "TakeOrderedAndProject" in _plan(E.queries()["top_k"](spark, sf_dir))


def test_no_cartesian_products_in_registered_batch_queries(spark, sf_dir):
    skip = {"knn1"}  # block-level equi-join, checked in the property tests
    qs = E.queries()
    for k in ["training_set", "interval_join", "theta_join", "gold_anomalies", "roc_pr_auc", "weibull_bayes",
              "censor_sweep", "entity_stats", "assortment", "seasonal_naive", "drift_metrics"]:
        if k in skip:
            continue
        plan = _plan(qs[k](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k
