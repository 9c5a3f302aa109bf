"""Raw CSV loading: malformed rows, dates, numbers, code lists, criteria."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from medcohort.functions import parsing as PA
from medcohort.functions import valuesets as V
from medcohort.sources import csv_tables as CT


def _write(d, name, text, newline="\n"):
    with open(os.path.join(d, name), "w", newline="") as fh:
        fh.write(text.replace("\n", newline))


@pytest.fixture(scope="module")
def raw_dir():
    d = tempfile.mkdtemp(prefix="medcohort-csv-")
    _write(d, CT.ENCOUNTER_FILE,
           "Encounter_ID,Member_ID,Encounter_DateTime,Extra\n"
           "e1,p1,2008-01-31T06:00:00Z,x\n"
           "e2,p2,2008-02-01T06:00:00-05:00,y\n"
           "e3,p3\n"                                   # short row: dropped
           "e4,p4,2008-02-01T06:00:00Z,z,too,long\n")  # long row: dropped
    _write(d, CT.ENCOUNTER_DX_FILE, "Encounter_ID,Code_ID\ne1,250.00\ne1,V77.1\ne2,250.01\ne9,999\n")
    _write(d, CT.LAB_FILE,
           "Member_ID,Date_Resulted,Result_Name,Numeric_Result\n"
           'p1,2008-01-31T06:00:00Z,Glucose,"1,234.5"\n'
           "p1,2008-01-31T06:00:00Z,HbA1c,12abc\n"
           'p2,2008-01-31T06:00:00Z,Glucose,""\n'
           "p2,2008-01-31T06:00:00Z,Glucose,NaN\n"
           "p2,2008-01-31T06:00:00Z,glucose,95\n")
    _write(d, CT.MED_FILE, "Member_ID,Order_Date,Drug_Name\np1,2008-01-31T06:00:00Z,METFORMIN\n")
    return d


def test_infer_table_name():
    assert CT.infer_table_name("data/encounter_INPUT.csv") == "encounter_INPUT"
    assert CT.infer_table_name("a-b.csv") == "b"
    assert CT.infer_table_name("x.txt") == "txt"
    assert CT.infer_table_name("...") == "..."


def test_load_csv_drops_malformed_and_registers_view(spark, raw_dir):
    df = CT.load_csv_as_table(spark, os.path.join(raw_dir, CT.ENCOUNTER_FILE))
    assert df.count() == 2
    assert spark.table("encounter_INPUT").select("Member_ID").count() == 2


def test_load_clinical_csv(spark, raw_dir):
    c = CT.load_clinical_csv(spark, raw_dir)
    dx = sorted((r.patient_id, r.code) for r in c.dx.collect())
    assert dx == [("p1", "250.00"), ("p1", "V77.1"), ("p2", "250.01")]
    dates = {r.patient_id: r.date for r in c.dx.collect()}
    assert dates["p2"] - dates["p1"] == dt.timedelta(days=1, hours=5)
    labs = sorted((r.test_name, r.value) for r in c.lab.collect())
    assert labs == [("Glucose", 1234.5), ("HbA1c", 12.0), ("glucose", 95.0)]
    assert [r.medicine for r in c.med.collect()] == ["metformin"]


def test_unparsable_number_fails_or_drops(spark):
    df = spark.createDataFrame([("abc",), ("7",)], "s string")
    with pytest.raises(Exception):
        df.select(PA.parse_us_number(F.col("s"))).collect()
    got = [r.v for r in df.select(PA.parse_us_number(F.col("s"), "null").alias("v")).collect()]
    assert got == [None, 7.0]


def test_number_shapes(spark):
    df = spark.createDataFrame([("1,234.5",), ("-3.5",), ("1.5E3",), ("12abc",), ("0.06",)], "s string")
    got = [r.v for r in df.select(PA.parse_us_number(F.col("s")).alias("v")).collect()]
    assert got == [1234.5, -3.5, 1500.0, 12.0, 0.06]


def test_instants(spark):
    df = spark.createDataFrame([("2008-01-31T06:00:00Z",), ("2008-01-31T06:00:00-05:00",),
                                ("2008-01-31T06:00:00-05",)], "s string")
    ms = [r.v for r in df.select(PA.epoch_millis(PA.parse_instant(F.col("s"))).alias("v")).collect()]
    assert ms[1] - ms[0] == 5 * 3600 * 1000 and ms[2] == ms[1]
    with pytest.raises(Exception):
        spark.createDataFrame([("31/01/2008",)], "s string").select(PA.parse_instant(F.col("s"))).collect()


def test_code_lists_split_cr_lf_and_keep_spaces(spark):
    d = tempfile.mkdtemp(prefix="medcohort-lists-")
    _write(d, CT.MED_FILTER_FILE, "\n".join(V.MED_FILTER_LINES) + "\n", newline="\r\n")
    _write(d, CT.LAB_FILTER_FILE, "\n".join(V.LAB_FILTER_LINES), newline="\r\n")
    icd = V.ICD9_FILTER_LINES
    text = "\n".join(icd[:18]) + "\n" + "\r".join(icd[18:69]) + "\n" + "\n".join(icd[69:]) + "\n"
    _write(d, CT.DX_FILTER_FILE, text)
    med, lab, dxl = CT.load_code_lists(spark, d)
    assert sorted(r.item for r in med.collect()) == sorted(V.candidate_medications())
    assert len(V.candidate_medications()) == 39 and "glucatrol " in V.candidate_medications()
    assert sorted(r.item for r in lab.collect()) == sorted(V.candidate_labs())
    assert len(V.candidate_labs()) == 7
    assert sorted(r.item for r in dxl.collect()) == sorted(V.candidate_diagnoses())
    assert len(V.ICD9_FILTER_LINES) == 105 and len(V.candidate_diagnoses()) == 69


def test_criteria_filter_with_wildcard(spark):
    d = tempfile.mkdtemp(prefix="medcohort-crit-")
    _write(d, "DM_RELATED_DX.csv", '790.21,"Glucose, abnormal"\nV77.1,screen\n250.*,diabetes\n', newline="\r\n")
    crit = CT.load_criteria_table(spark, os.path.join(d, "DM_RELATED_DX.csv"))
    assert crit.filter(F.col("code") == "790.21").first().description == "Glucose, abnormal"
    ev = spark.createDataFrame([("a", "250.01"), ("a", "250.01"), ("b", "250"), ("c", "V77.1"),
                                ("d", "790.21"), ("e", "v77.1")], "patient_id string, code string")
    got = sorted((r.patient_id, r.code) for r in CT.criteria_filter(ev, "code", crit).collect())
    assert got == [("a", "250.01"), ("a", "250.01"), ("c", "V77.1"), ("d", "790.21")]


def test_tsv_sinks(spark, tmp_path):
    from medcohort.sources import sinks
    labels = spark.createDataFrame([("p1", 1), ("p2", 3)], "patient_id string, label int")
    sinks.write_labels_tsv(labels, str(tmp_path / "labels"))
    back = spark.read.option("sep", "\t").csv(str(tmp_path / "labels")).collect()
    assert sorted(tuple(r) for r in back) == [("p1", "1"), ("p2", "3")]


def test_null_in_used_column_fails_or_drops(spark):
    d = tempfile.mkdtemp(prefix="medcohort-null-")
    _write(d, CT.ENCOUNTER_FILE, "Encounter_ID,Member_ID,Encounter_DateTime\ne1,,2008-01-31T06:00:00Z\n"
                                 "e2,p2,2008-01-31T06:00:00Z\n")
    _write(d, CT.ENCOUNTER_DX_FILE, "Encounter_ID,Code_ID\ne1,250.00\ne2,250.01\n")
    _write(d, CT.LAB_FILE, "Member_ID,Date_Resulted,Result_Name,Numeric_Result\np1,bad-date,Glucose,5\n")
    _write(d, CT.MED_FILE, "Member_ID,Order_Date,Drug_Name\np1,2008-01-31T06:00:00Z,\n")
    with pytest.raises(Exception):
        CT.load_clinical_csv(spark, d).dx.collect()
    with pytest.raises(Exception):
        CT.load_clinical_csv(spark, d).med.collect()
    lenient = CT.load_clinical_csv(spark, d, on_error="drop")
    assert [r.patient_id for r in lenient.dx.collect()] == ["p2"]
    assert lenient.lab.count() == 0 and lenient.med.count() == 0
    bad = {r.frame: r.bad_rows for r in CT.count_invalid_rows(spark, d).collect()}
    assert bad == {"dx": 1, "lab": 1, "med": 1}


def test_source_table_name_column(spark, raw_dir):
    df = CT.load_csv_as_table(spark, os.path.join(raw_dir, CT.MED_FILE))
    assert {r.v for r in df.select(CT.source_table_name().alias("v")).collect()} == {"medication_orders_INPUT"}


def test_csv_round_trip_gives_the_same_phenotype(spark, tmp_path):
    """The clinical view written as raw CSV exports and read back labels every patient alike."""
    from medcohort.operators import phenotype as P
    from medcohort.sources.clinical import load_clinical_view
    view = load_clinical_view(spark, "/root/testdata/sf0.001")
    d = str(tmp_path)
    CT.write_clinical_csv(view, d)
    csv = CT.load_clinical_csv(spark, d)
    assert csv.dx.count() == view.dx.count() and csv.lab.count() == view.lab.count()
    a, b = P.phenotype_labels(csv), P.phenotype_labels(view)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ga = {r.label: round(r.mean_glucose, 6) for r in P.glucose_mean_by_label(csv.lab, a).collect()}
    gb = {r.label: round(r.mean_glucose, 6) for r in P.glucose_mean_by_label(view.lab, b).collect()}
    assert ga == gb


def test_loading_leaves_the_session_as_it_is(spark, raw_dir):
    key = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(key)
    CT.load_clinical_csv(spark, raw_dir)
    assert spark.conf.get(key) == before


def test_malformed_rows_are_counted(spark, raw_dir):
    got = {r.file: r.malformed_rows for r in CT.count_malformed_rows(spark, raw_dir).collect()}
    assert got == {CT.ENCOUNTER_FILE: 2, CT.ENCOUNTER_DX_FILE: 0, CT.LAB_FILE: 0, CT.MED_FILE: 0}


def test_lenient_instants(spark):
    texts = ["2008-01-31T06:00:00-05:30", "2008-01-31T06:00:00-05", "2008-13-01T25:61:61Z", "2009-01-02T02:02:01Z",
             "2008-01-31T06:00:00+0530x", "2008-01-31T06:00:00+05", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.v for r in df.select(PA.epoch_millis(PA.parse_instant(F.col("s"), "null", lenient=True)).alias("v")).collect()]
    assert got[0] == got[1] and got[2] == got[3] and got[4] == got[5] and got[6:] == [None, None] and None not in got[:6]


def test_feature_sink(spark, tmp_path):
    from medcohort.sources import sinks
    tuples = spark.createDataFrame([("p1", "250.00", 2.0)], "patient_id string, feature string, value double")
    sinks.write_feature_tuples_tsv(tuples, str(tmp_path / "f"))
    assert [tuple(r) for r in spark.read.option("sep", "\t").csv(str(tmp_path / "f")).collect()] == [("p1", "250.00", "2.0")]
