"""Feature construction: the reference's unit cases plus name clashes and lists."""

import datetime as dt

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from medcohort.operators import features as FE
from medcohort.sources.clinical import ClinicalFrames

NOW = dt.datetime(2024, 1, 1, 12, 0, 0)


def _dx(spark, codes):
    return spark.createDataFrame([("patient1", c, NOW) for c in codes],
                                 "patient_id string, code string, date timestamp")


def _med(spark, names):
    return spark.createDataFrame([("patient1", NOW, m) for m in names],
                                 "patient_id string, date timestamp, medicine string")


def _lab(spark, rows):
    return spark.createDataFrame([("patient1", NOW, n, v) for n, v in rows],
                                 "patient_id string, date timestamp, test_name string, value double")


def _as_map(df):
    return {(r.patient_id, r.feature): r.value for r in df.collect()}


CASES = {
    "one": (["code1"], [("code1", 42.0)]),
    "two_diff": (["code1", "code2"], [("code1", 42.0), ("code2", 24.0)]),
    "two_same": (["code1", "code1"], [("code1", 42.0), ("code1", 24.0)]),
}


@pytest.mark.parametrize("case", list(CASES))
def test_counts_and_means(spark, case):
    codes, labs = CASES[case]
    dx = _as_map(FE.dx_features(_dx(spark, codes)))
    med = _as_map(FE.med_features(_med(spark, codes)))
    lab = _as_map(FE.lab_features(_lab(spark, labs)))
    expected_counts = {("patient1", c): float(codes.count(c)) for c in set(codes)}
    assert dx == expected_counts
    assert med == expected_counts
    sums = {}
    for n, v in labs:
        sums.setdefault(n, []).append(v)
    assert lab == {("patient1", n): sum(v) / len(v) for n, v in sums.items()}


def test_three_with_duplication_and_filters(spark):
    dx = _dx(spark, ["code1", "code1", "code2"])
    med = _med(spark, ["code1", "code2", "code2"])
    lab = _lab(spark, [("code1", 42.0), ("code1", 24.0), ("code2", 7475.0)])
    assert _as_map(FE.dx_features(dx)) == {("patient1", "code1"): 2.0, ("patient1", "code2"): 1.0}
    assert _as_map(FE.med_features(med)) == {("patient1", "code1"): 1.0, ("patient1", "code2"): 2.0}
    assert _as_map(FE.lab_features(lab)) == {("patient1", "code1"): 33.0, ("patient1", "code2"): 7475.0}
    assert _as_map(FE.dx_features(dx, ["code2"])) == {("patient1", "code2"): 1.0}
    assert _as_map(FE.dx_features(dx, ["code1"])) == {("patient1", "code1"): 2.0}
    assert _as_map(FE.med_features(med, ["code2"])) == {("patient1", "code2"): 2.0}
    assert _as_map(FE.med_features(med, ["code1"])) == {("patient1", "code1"): 1.0}
    assert _as_map(FE.lab_features(lab, ["code2"])) == {("patient1", "code2"): 7475.0}
    assert _as_map(FE.lab_features(lab, ["code1"])) == {("patient1", "code1"): 33.0}
    # a list given as a DataFrame takes the semi-join path
    items = spark.createDataFrame([("code2",)], "item string")
    assert _as_map(FE.dx_features(dx, items)) == {("patient1", "code2"): 1.0}


def test_list_matching_nothing_and_case(spark):
    lab = _lab(spark, [("Glucose", 100.0), ("glucose", 80.0)])
    assert FE.lab_features(lab, ["nothing"]).count() == 0
    # case-sensitive by default: the upper-case name is dropped by a lower-case list
    assert _as_map(FE.lab_features(lab, ["glucose"])) == {("patient1", "glucose"): 80.0}
    assert _as_map(FE.lab_features(lab, ["glucose"], ignore_case=True)) == {
        ("patient1", "Glucose"): 100.0, ("patient1", "glucose"): 80.0}


def test_feature_tuples_fused_equals_generic(spark):
    from medcohort.sources.clinical import load_clinical_view
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    generic = ClinicalFrames(med=c.med, lab=c.lab, dx=c.dx)
    for kw in ({}, FE.shipped_candidate_lists()):
        a = FE.feature_tuples(c, **kw).select("patient_id", "feature", F.round("value", 6).alias("v"))
        b = FE.feature_tuples(generic, **kw).select("patient_id", "feature", F.round("value", 6).alias("v"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_same_name_in_two_domains_is_detected(spark):
    c = ClinicalFrames(med=_med(spark, ["x"]), lab=_lab(spark, [("x", 1.0)]), dx=_dx(spark, ["y"]))
    tuples = FE.feature_tuples(c)
    assert tuples.count() == 3
    with pytest.raises(ValueError):
        FE.assert_unique_features(tuples)


def _tuples(spark, rows):
    return spark.createDataFrame(rows, FE.FEATURE_SCHEMA)


def test_construct_full_row(spark):
    t = _tuples(spark, [("patient1", "code2", 42.0), ("patient1", "code1", 24.0)])
    d, v, n = FE.build_vectors(t)
    assert n == 2
    assert {r.feature: r.idx for r in d.collect()} == {"code1": 0, "code2": 1}
    assert {r.patient_id: r.features for r in v.collect()} == {"patient1": SparseVector(2, [0, 1], [24.0, 42.0])}


def test_construct_sparse(spark):
    t = _tuples(spark, [("patient1", "code0", 42.0), ("patient1", "code2", 24.0),
                        ("patient2", "code1", 12.0)])
    d, v, n = FE.build_vectors(t)
    got = {r.patient_id: r.features for r in v.collect()}
    assert all(type(v) is SparseVector for v in got.values())   # dense ones would compare equal
    assert got["patient1"] == SparseVector(3, [0, 2], [42.0, 24.0])
    assert got["patient2"] == SparseVector(3, [1], [12.0])
    long = FE.sparse_entries(FE.patient_vectors_long(t, d))
    assert {r.patient_id: (r.indices, r.values) for r in long.collect()} == {
        "patient1": ([0, 2], [42.0, 24.0]), "patient2": ([1], [12.0])}


@pytest.mark.parametrize("num_partitions", [1, 5, None])
def test_dictionary_is_dense_and_name_ordered(spark, num_partitions):
    names = [f"f{i:04d}" for i in range(300)] + ["Glucose", "glucose", "V77.1", "250.01"]
    t = _tuples(spark, [(f"p{i % 7}", n, 1.0) for i, n in enumerate(names)])
    d = {r.feature: r.idx for r in FE.feature_dictionary(t, num_partitions).collect()}
    assert [k for k, _ in sorted(d.items(), key=lambda kv: kv[1])] == sorted(names)
    assert sorted(d.values()) == list(range(len(names)))


def test_duplicate_index_fails(spark):
    t = _tuples(spark, [("p", "a", 1.0)])
    d = spark.createDataFrame([("a", 0)], "feature string, idx int")
    dup = FE.patient_vectors_long(t.unionByName(t), d)
    with pytest.raises(Exception):
        FE.sparse_entries(dup).collect()


def test_names_come_straight_from_the_events(spark):
    from medcohort.sources.clinical import load_clinical_view
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    generic = ClinicalFrames(med=c.med, lab=c.lab, dx=c.dx)
    want = {r.feature for r in FE.feature_tuples(c).select("feature").distinct().collect()}
    for frames in (c, generic):
        assert sorted(r.feature for r in FE.feature_names(frames).collect()) == sorted(want)


def test_domain_in_the_key_keeps_equal_names_apart(spark):
    c = ClinicalFrames(med=_med(spark, ["x"]), lab=_lab(spark, [("x", 1.0)]), dx=_dx(spark, ["y"]))
    tuples = FE.qualified_tuples(FE.feature_tuples_tagged(c))
    FE.assert_unique_features(tuples)
    _, vectors, width = FE.build_vectors(tuples)
    assert width == 3 and {r.feature for r in tuples.collect()} == {"dx:y", "lab:x", "med:x"} and vectors.count() == 1


def test_moments_of_large_close_values(spark):
    rows = [(str(k), "x", 1e9 + k % 2) for k in range(100)] + [(str(k), "y", 1e9) for k in range(50)]
    m = {r.feature: r.std for r in FE.feature_moments(_tuples(spark, rows)).collect()}
    import numpy as np
    assert m["x"] == pytest.approx(np.std([k % 2 for k in range(100)], ddof=1), rel=1e-6)
    assert m["y"] == pytest.approx(np.std([1e9] * 50 + [0] * 50, ddof=1), rel=1e-9)


def test_moments_and_zscores_match_numpy(spark):
    import numpy as np
    rows = [("a", "x", 1.0), ("b", "x", 3.0), ("c", "y", 5.0), ("a", "y", 2.0), ("b", "z", 7.0)]
    t = _tuples(spark, rows)
    m = {r.feature: (r.mean, r.std) for r in FE.feature_moments(t).collect()}
    dense = {"a": [1, 2, 0], "b": [3, 0, 7], "c": [0, 5, 0]}
    arr = np.array(list(dense.values()), dtype=float)
    for j, f in enumerate("xyz"):
        assert m[f][0] == pytest.approx(arr[:, j].mean())
        assert m[f][1] == pytest.approx(arr[:, j].std(ddof=1))
    z = {(r.patient_id, r.feature): r.zscore for r in FE.feature_zscores(t).collect()}
    assert z[("b", "z")] == pytest.approx((7 - arr[:, 2].mean()) / arr[:, 2].std(ddof=1))


def test_list_frames_equal_list_constants(spark):
    from medcohort.sources.clinical import load_clinical_view
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    lists = FE.shipped_candidate_lists()
    frames = {k: spark.createDataFrame([(v,) for v in vals], "item string") for k, vals in lists.items()}
    tagged = FE.feature_tuples_tagged(c)
    a = FE.restrict_tagged(tagged, **lists)
    b = FE.restrict_tagged(tagged, **frames)
    c2 = FE.feature_tuples_tagged(c, **frames)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c2).count() == 0 and c2.exceptAll(a).count() == 0
    only_dx = FE.restrict_tagged(tagged, candidate_dx=frames["candidate_dx"])
    assert only_dx.filter("kind = 'med'").count() == tagged.filter("kind = 'med'").count()
