"""Purity on the reference's two contingency tables, and its inverse."""

import pytest

from medcohort.operators import metrics as M


def pairs_of(spark, rows, names=("first", "second")):
    """One row per pair from ``(a, b, count)`` rows."""
    pairs = [(a, b) for a, b, n in rows for _ in range(n)]
    return spark.createDataFrame(pairs, f"{names[0]} int, {names[1]} int")


TABLE_1 = [(1, 1, 0), (1, 2, 1), (1, 3, 5), (2, 1, 1), (2, 2, 4), (2, 3, 1), (3, 1, 3), (3, 2, 0), (3, 3, 2)]
TABLE_2 = [(1, 1, 0), (1, 2, 53), (1, 3, 10), (2, 1, 0), (2, 2, 1), (2, 3, 60), (3, 1, 0), (3, 2, 16), (3, 3, 0)]


@pytest.mark.parametrize("rows,purity,inverse", [
    (TABLE_1, (5 + 4 + 3) / 17, (3 + 4 + 5) / 17),
    (TABLE_2, (53 + 60 + 16) / 140, (53 + 60) / 140),
])
def test_purity_tables(spark, rows, purity, inverse):
    pairs = pairs_of(spark, rows, ("cluster", "label"))
    assert M.purity(pairs, "cluster", "label").first().purity == pytest.approx(purity, abs=1e-3)
    assert M.purity(pairs, "label", "cluster").first().purity == pytest.approx(inverse, abs=1e-3)
    both = M.purity_pair(pairs).first()
    assert both.n == sum(r[2] for r in rows)
    assert both.purity == pytest.approx(purity) and both.inverse_purity == pytest.approx(inverse)


def test_contingency_counts(spark):
    pairs = pairs_of(spark, TABLE_1, ("cluster", "label"))
    got = {(r.label, r.cluster): r.n for r in M.contingency(pairs).collect()}
    assert got == {(lab, c): n for c, lab, n in TABLE_1 if n}


def test_single_cluster(spark):
    pairs = pairs_of(spark, [(0, 1, 3), (0, 2, 1)], ("cluster", "label"))
    assert M.purity(pairs).first().purity == pytest.approx(0.75)
    assert M.purity(pairs, "label", "cluster").first().purity == pytest.approx(1.0)


def test_unfeatured_patients_leave_purity_n(spark):
    """A labelled patient with no features has no cluster and drops out of N."""
    from medcohort.plans.study import with_labels
    assigned = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "patient_id string, cluster int")
    labels = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3)], "patient_id string, label int")
    row = M.purity_pair(with_labels(assigned, labels)).first()
    assert row.n == 3
    # by cluster: {0: a->1, b->2}, {1: c->2} -> (1 + 1) / 3; by label: {1: a}, {2: b, c} -> (1 + 1) / 3
    assert abs(row.purity - 2 / 3) < 1e-12 and abs(row.inverse_purity - 2 / 3) < 1e-12
