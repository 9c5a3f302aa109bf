"""Plan shape: one join of orders and lineitem, one aggregate shuffle, no Python."""

import pytest

import __spark_entry__ as E
from medcohort.plans import catalog

from .conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.catalog.clearCache()       # a persisted equal plan would be substituted
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the at-scale shape
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["phenotype_labels", "feature_tuples"])
def test_single_join_single_aggregate_shuffle(spark, no_broadcast, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning") == 3      # two join sides + one aggregate
    assert "partial_" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark):
    spark.catalog.clearCache()
    plan = _plan(E.queries()["lab_events"](spark, SF0001))
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,N))" in plan
    assert "l_extendedprice" not in plan        # pruned: the view never reads it


def test_no_python_in_feature_plans(spark):
    for name in ["patient_vectors", "feature_zscores", "minibatch_centres", "parsed_numbers"]:
        plan = _plan(E.queries()[name](spark, SF0001))
        assert "Python" not in plan, name


# the training-data operators have plan rules of their own
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES)))
def test_no_cross_join_or_python_anywhere(spark, name):
    spark.catalog.clearCache()
    plan = _plan(E.queries()[name](spark, SF0001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["t1_med_patients", "t2_med_patients"])
def test_medication_sets_scan_orders_alone(spark, no_broadcast, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["t1_dx_patients", "related_dx_patients", "t2_without_t1_dx", "glucose_tested",
                                  "abnormal_lab_patients"])
def test_other_sets_read_the_lines_once(spark, no_broadcast, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert plan.count("FileScan") == 2 and plan.count("SortMergeJoin") == 1
    if name in ("glucose_tested", "abnormal_lab_patients"):
        assert "Not(EqualTo(l_returnflag,N))" in plan


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for name in ("feature_zscores", "patient_vectors", "cluster_report", "kmeans_clusters", "zscore_minibatch_purity"):
        E.queries()[name](spark, SF0001).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def _filter_rows(node, table):
    """Rows that each filter above a scan of ``table`` lets through, in a plan that has run."""
    found = []
    for k in range(node.children().size()):
        found += _filter_rows(node.children().apply(k), table)
    if node.nodeName() == "Filter" and "might_contain" in node.simpleString(10_000) and f"{table}" in node.toString():
        found.append(node.metrics().apply("numOutputRows").value())
    return found


def test_a_stored_patient_set_prunes_the_scans(spark, no_broadcast):
    from medcohort.sources.clinical import load_clinical_view, read_table, stored_patients
    patients = spark.createDataFrame([("7",), ("7",), ("8",), (None,), ("",), ("none",)], "patient_id string")
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    want = sorted(map(str, load_clinical_view(spark, SF0001, patients).dx.collect()))
    spark.conf.set(size, "0")   # the given tables lie under the bound from which filters pay
    try:
        got = load_clinical_view(spark, SF0001, stored_patients(patients)).dx
        run = got._jdf.queryExecution()
        assert run.toRdd().count() == len(want) > 0
        for table, key in (("orders", "o_custkey"), ("lineitem", "l_orderkey")):
            rows = _filter_rows(run.executedPlan(), key)
            every = read_table(spark, SF0001, table).count()
            assert rows and min(rows) < every / 10
        assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.unset(size)


def test_listed_lines_are_picked_below_the_join(spark, no_broadcast):
    plan = _plan(E.queries()["feature_tuples_filtered"](spark, SF0001))
    below = plan[plan.index("SortMergeJoin"):]
    picked = [x for x in below.splitlines() if "Filter" in x and "l_partkey" in x]
    assert picked and all("l_suppkey" in x for x in picked)


def test_zscore_points_join_the_events_once(spark, no_broadcast, monkeypatch):
    seen = []
    for name in ("build_vectors", "feature_moments"):
        whole = getattr(catalog.FE, name)
        monkeypatch.setattr(catalog.FE, name, lambda tuples, whole=whole: (seen.append(_plan(tuples)), whole(tuples))[1])
    catalog._zscore_points(spark, SF0001)
    assert len(seen) == 2 and not any("Join" in x for x in seen)
