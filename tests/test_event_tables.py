"""Bucketed event tables and observed loads."""

import uuid

import pytest
from pyspark.sql import functions as F

from medcohort.operators import features as FE
from medcohort.operators import phenotype as P
from medcohort.sources import csv_tables as CT
from medcohort.sources import event_tables as ET
from medcohort.sources.clinical import ClinicalFrames, load_clinical_view

from .conftest import SF0001


@pytest.fixture()
def events(spark, tmp_path):
    c = load_clinical_view(spark, SF0001)
    names = []

    def save(frames, buckets=4):
        names.append(f"t_{uuid.uuid4().hex}")
        ET.save_event_tables(frames, names[-1], buckets)
        return ET.load_event_tables(spark, names[-1])

    yield c, save
    for name in names:
        ET.drop_event_tables(spark, name)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_no_events_are_exchanged(events):
    c, save = events
    stored = save(c)
    tuples, labels = FE.feature_tuples(stored), P.phenotype_labels(stored)
    assert "Exchange" not in plan(tuples) and "Join" not in plan(tuples) + plan(labels)
    # the label rule exchanges partial aggregates, never scanned rows
    lines = [x.strip(" :+-") for x in plan(labels).splitlines()]
    after = [lines[i + 1] for i, x in enumerate(lines) if x.startswith("Exchange")]
    assert all(x.startswith(("HashAggregate", "SortAggregate")) for x in after)
    assert same(labels, P.phenotype_labels(c))
    six = lambda df: df.select("patient_id", "feature", F.round("value", 6))
    assert same(six(tuples), six(FE.feature_tuples(c)))


def test_frames_without_fused_lines(events):
    c, save = events
    stored = save(ClinicalFrames(med=c.med, lab=c.lab, dx=c.dx))
    for name in ("dx", "lab", "med"):
        assert same(getattr(stored, name), getattr(c, name))
    assert same(P.phenotype_labels(stored), P.phenotype_labels(c))


def exports(folder, lab, med="p1,2020-01-01T00:00:00Z,Drug\n"):
    texts = {CT.ENCOUNTER_FILE: "Encounter_ID,Member_ID,Encounter_DateTime\ne1,p1,2020-01-01T00:00:00Z\ne2,,2020-01-02T00:00:00Z\n",
             CT.ENCOUNTER_DX_FILE: "Encounter_ID,Code_ID\ne1,250.00\ne1,250.02,x\ne2,250.01\n",
             CT.LAB_FILE: "Member_ID,Date_Resulted,Result_Name,Numeric_Result\n" + lab,
             CT.MED_FILE: "Member_ID,Order_Date,Drug_Name\n" + med}
    for name, text in texts.items():
        (folder / name).write_text(text)
    return str(folder)


LABS = "p1,2020-01-01T00:00:00Z,glucose,\"1,234.5\"\np1,2020-01-01T00:00:00Z,glucose,\np1,soon,glucose,7\np1,2020-01-01T00:00:00Z,glucose,high\n"


def test_observed_load_counts_every_fault(spark, tmp_path):
    folder = exports(tmp_path, LABS)
    with pytest.raises(CT.LoadFaults) as failed:
        CT.load_observed_csv(spark, folder, str(tmp_path / "store"))
    assert failed.value.counts == {
        CT.ENCOUNTER_FILE: {"rows": 2, "malformed": 0, "missing": 1, "bad_dates": 0, "bad_numbers": 0},
        CT.ENCOUNTER_DX_FILE: {"rows": 3, "malformed": 1, "missing": 0, "bad_dates": 0, "bad_numbers": 0},
        CT.LAB_FILE: {"rows": 4, "malformed": 0, "missing": 0, "bad_dates": 1, "bad_numbers": 1},
        CT.MED_FILE: {"rows": 1, "malformed": 0, "missing": 0, "bad_dates": 0, "bad_numbers": 0}}
    assert f"{CT.LAB_FILE}: 1 bad_dates, 1 bad_numbers" in str(failed.value)
    counts = {}
    c = CT.load_observed_csv(spark, folder, str(tmp_path / "store"), "drop", counts)
    assert counts == failed.value.counts
    assert [r.code for r in c.dx.collect()] == ["250.00"] and [r.value for r in c.lab.collect()] == [1234.5]
    assert [r.medicine for r in c.med.collect()] == ["drug"]


def test_observed_load_equals_the_plain_one(spark, tmp_path):
    CT.write_clinical_csv(load_clinical_view(spark, SF0001), str(tmp_path / "in"))
    plain = CT.load_clinical_csv(spark, str(tmp_path / "in"))
    seen = CT.load_observed_csv(spark, str(tmp_path / "in"), str(tmp_path / "store"))
    for name in ("dx", "lab", "med"):
        assert getattr(seen, name).columns == getattr(plain, name).columns and same(getattr(seen, name), getattr(plain, name))


def test_a_patient_set_restricts_the_encounters_before_their_join(spark):
    who = spark.createDataFrame([("7",), ("12",), ("7",), (None,), ("no one",)], "patient_id string")
    c, some = load_clinical_view(spark, SF0001), load_clinical_view(spark, SF0001, who)
    joins = [x.strip(" :+-").split(" ", 3)[1:2] + [x] for x in plan(some.lab).splitlines() if "Join" in x]
    assert len(joins) == 2 and "Inner" in joins[0][1] and "LeftSemi" in joins[1][1]  # the semi join is the inner one's input
    for name in ("dx", "lab", "med", "lines"):
        assert same(getattr(some, name), getattr(c, name).where("patient_id IN ('7', '12')"))


def test_buckets_grow_with_the_events(spark, events, monkeypatch):
    c, save = events
    monkeypatch.setattr(ET, "BUCKETS", 2)
    name = f"t_{uuid.uuid4().hex}"
    n = c.lines.count()
    try:
        ET.save_event_tables(c, name, bucket_lines=n // 5)
        for table in ET._names(name):
            described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
            assert described["Num Buckets"] == str(-(-n // (n // 5)))
        stored = ET.load_event_tables(spark, name)
        assert "Exchange" not in plan(FE.feature_tuples(stored))
        assert same(P.phenotype_labels(stored), P.phenotype_labels(c))
    finally:
        ET.drop_event_tables(spark, name)
