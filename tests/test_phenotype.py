"""Phenotype truth table, set-algebra cross-check, glucose means."""

import datetime as dt

import pytest

from medcohort.operators import phenotype as P
from medcohort.sources.clinical import ClinicalFrames, load_clinical_view

T0 = dt.datetime(2020, 1, 1, 8, 0, 0)
T1 = dt.datetime(2020, 2, 1, 8, 0, 0)

# (patient, dx codes, [(medicine, time)], [(lab name, value)], expected label)
TRUTH = [
    ("case1", ["250.00"], [], [], 1),                                       # R2: no T1 medication
    ("case2", ["250.02"], [("Lantus", T0)], [], 1),                         # R3: T1 med, no T2 med
    ("case3", ["250.2"], [("METFORMIN", T0), ("lantus", T1)], [], 1),       # R4: T2 before T1
    ("tie", ["250.2"], [("metformin", T0), ("lantus", T0)], [], 3),         # R4 tie -> not a case
    ("t1_first", ["250.2"], [("lantus", T0), ("metformin", T1)], [], 3),    # T1 earlier -> other
    ("t1dx", ["250.01", "250.00"], [], [], 3),                              # T1 diagnosis excludes
    ("glucatrol_space", ["250.00"], [("lantus", T0), ("glucatrol ", T1)], [], 3),  # with space: T2 med
    ("glucatrol_nospace", ["250.00"], [("lantus", T0), ("glucatrol", T1)], [], 1),  # not a T2 med
    ("control", ["D5"], [], [("Glucose", 110.0)], 2),                      # glucose exactly 110 is normal
    ("fasting110", ["D5"], [], [("Fasting Glucose", 110.0)], 3),           # fasting 110 is abnormal
    ("urine", ["D5"], [], [("urine glucose", 500.0)], 2),                  # substring test, no rule
    ("a1c", [], [], [("glucose", 90.0), ("HbA1c", 6.0)], 3),               # HbA1c >= 6.0 abnormal
    ("a1c_ok", [], [], [("glucose", 90.0), ("HbA1c", 5.9)], 2),
    ("code250", ["250"], [], [("glucose", 90.0)], 2),                      # bare 250 is not 250.*
    ("related", ["V77.1"], [], [("glucose", 90.0)], 3),
    ("related_prefix", ["250.10"], [], [("glucose", 90.0)], 3),
    ("no_glucose", ["D1"], [], [("lab 7", 1.0)], 3),
    ("med_only", [], [("drug 5", T0)], [], 3),                             # known from one event set
]


@pytest.fixture(scope="module")
def truth_frames(spark):
    dx, med, lab = [], [], []
    for pid, codes, meds, labs, _ in TRUTH:
        dx += [(pid, c, T0) for c in codes]
        med += [(pid, t, m.lower()) for m, t in meds]
        lab += [(pid, T0, n, v) for n, v in labs]
    return ClinicalFrames(
        med=spark.createDataFrame(med, "patient_id string, date timestamp, medicine string"),
        lab=spark.createDataFrame(lab, "patient_id string, date timestamp, test_name string, value double"),
        dx=spark.createDataFrame(dx, "patient_id string, code string, date timestamp"))


def test_truth_table(truth_frames):
    got = {r.patient_id: r.label for r in P.phenotype_labels(truth_frames).collect()}
    assert got == {pid: label for pid, *_, label in TRUTH}


def test_memberships_of_the_truth_table(truth_frames):
    sets = P.member_sets(P.patient_flags(truth_frames))
    flags = {r.patient_id: r for r in P.patient_flags(truth_frames).collect()}
    got = {name: {r.patient_id for r in df.collect()} for name, df in sets.items()}
    assert got["patients"] == set(flags) and got["t1_dx"] == {p for p, r in flags.items() if r.t1_dx}
    assert got["t2_med"] == {p for p, r in flags.items() if r.t2_med_first is not None}
    assert got["t2_med_before_t1"] <= got["t1_med"] & got["t2_med"]


def test_day_precision_makes_same_day_a_tie(spark):
    later = dt.datetime(2020, 1, 1, 20, 0, 0)
    c = ClinicalFrames(
        med=spark.createDataFrame([("p", T0, "metformin"), ("p", later, "lantus")],
                                  "patient_id string, date timestamp, medicine string"),
        lab=spark.createDataFrame([], "patient_id string, date timestamp, test_name string, value double"),
        dx=spark.createDataFrame([("p", "250.2", T0)], "patient_id string, code string, date timestamp"))
    assert P.phenotype_labels(c).first().label == 1
    assert P.phenotype_labels(c, day_precision=True).first().label == 3


def test_counts_on_clinical_view(spark):
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    counts = {r.label: r["count"] for r in P.phenotype_labels(c).groupBy("label").count().collect()}
    assert counts == {1: 45, 2: 12, 3: 93}


def test_glucose_means_and_empty_label(spark, truth_frames):
    labels = P.phenotype_labels(truth_frames)
    got = {r.label: r.mean_glucose for r in P.glucose_mean_by_label(truth_frames.lab, labels).collect()}
    # case patients have no glucose rows -> 0.0; controls: 110, 90, 90; others: 90
    assert got == {1: 0.0, 2: pytest.approx((110.0 + 90 + 90) / 3), 3: pytest.approx(90.0)}
    flags = P.patient_flags(truth_frames)
    again = {r.label: r.mean_glucose for r in P.glucose_mean_from_flags(flags).collect()}
    assert again == got
