"""Type-2 diabetes phenotype: label every patient case (1), control (2) or other (3).

Spark plan (one pass, no set algebra): the three event frames are projected to
one narrow row shape carrying per-event flags, unioned, and aggregated once by
``patient_id``. Partial aggregation runs map-side inside the scan stage, so
exactly one shuffle moves at most one row per (map task, patient) however
skewed a patient is. The rule is then a ``CASE`` over the per-patient flags.

The sets that the rule is made of are also to be had one by one
(:func:`event_patients` for a predicate on one event frame), and as membership
rows (:func:`memberships`) on which set operations run without the big join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.functions import valuesets as V
from medcohort.functions.sqltext import in_list, quote
from medcohort.sources.clinical import ClinicalFrames

CASE, CONTROL, OTHER = 1, 2, 3


# ---------------------------------------------------------------------------
# Row-level predicates (pure column expressions, all codegen'd)
# ---------------------------------------------------------------------------

def _name(c: Column | str) -> str:
    if isinstance(c, str):
        return c
    raise TypeError("pass the column name; predicates are rendered as SQL text")


def is_t1_dx(code: str = "code") -> Column:
    return F.expr(in_list(_name(code), V.T1DM_DX))


def is_t2_dx(code: str = "code") -> Column:
    return F.expr(in_list(_name(code), V.T2DM_DX))


def is_related_dx(code: str = "code") -> Column:
    c = _name(code)
    return F.expr(f"({in_list(c, V.DM_RELATED_DX)}) OR startswith({c}, {quote(V.DM_RELATED_PREFIX)})")


def is_t1_med(medicine: str = "medicine") -> Column:
    return F.expr(in_list(f"lower({_name(medicine)})", V.T1DM_MED))


def is_t2_med(medicine: str = "medicine") -> Column:
    return F.expr(in_list(f"lower({_name(medicine)})", V.T2DM_MED))


def is_glucose_tested(test_name: str = "test_name") -> Column:
    return F.expr(f"contains(lower({_name(test_name)}), {quote(V.GLUCOSE_TESTED_SUBSTRING)})")


def is_abnormal_lab(test_name: str = "test_name", value: str = "value") -> Column:
    name, val = f"lower({_name(test_name)})", _name(value)
    rules = [f"({name} = {quote(t)} AND {val} {op} CAST({th} AS DOUBLE))"
             for t, op, th in V.ABNORMAL_LAB_RULES]
    return F.expr("(" + " OR ".join(rules) + ")")


def _event_time(date: Column, day_precision: bool) -> Column:
    return F.date_trunc("day", date) if day_precision else date


# ---------------------------------------------------------------------------
# One-pass per-patient flags
# ---------------------------------------------------------------------------

def patient_flags(clinical: ClinicalFrames, day_precision: bool = False) -> DataFrame:
    """One row per patient seen in any event set, with the rule's inputs.

    Columns: patient_id, t1_dx, t2_dx, related_dx, glucose_tested,
    abnormal_lab (0/1 ints), t1_med_first, t2_med_first (earliest order time or
    NULL), glucose_sum, glucose_n (row-weighted pieces of the mean of labs
    named exactly "glucose", any case).
    """
    ts_type = clinical.med.schema["date"].dataType
    null_ts = F.lit(None).cast(ts_type)
    zero, null_d = F.lit(0), F.lit(None).cast("double")
    zero_l = F.lit(0).cast("long")

    dx = clinical.dx.select(
        "patient_id",
        is_t1_dx("code").cast("int").alias("t1_dx"),
        is_t2_dx("code").cast("int").alias("t2_dx"),
        is_related_dx("code").cast("int").alias("related_dx"),
        null_ts.alias("t1_med_date"), null_ts.alias("t2_med_date"),
        zero.alias("glucose_tested"), zero.alias("abnormal_lab"),
        null_d.alias("glucose_value"), zero_l.alias("glucose_row"),
    )
    t = _event_time(F.col("date"), day_precision).cast(ts_type)
    med = clinical.med.select(
        "patient_id",
        zero.alias("t1_dx"), zero.alias("t2_dx"), zero.alias("related_dx"),
        F.when(is_t1_med("medicine"), t).alias("t1_med_date"),
        F.when(is_t2_med("medicine"), t).alias("t2_med_date"),
        zero.alias("glucose_tested"), zero.alias("abnormal_lab"),
        null_d.alias("glucose_value"), zero_l.alias("glucose_row"),
    )
    is_glucose = F.lower(F.col("test_name")) == F.lit(V.GLUCOSE_MEAN_TEST)
    lab = clinical.lab.select(
        "patient_id",
        zero.alias("t1_dx"), zero.alias("t2_dx"), zero.alias("related_dx"),
        null_ts.alias("t1_med_date"), null_ts.alias("t2_med_date"),
        is_glucose_tested("test_name").cast("int").alias("glucose_tested"),
        is_abnormal_lab("test_name", "value").cast("int").alias("abnormal_lab"),
        F.when(is_glucose, F.col("value")).alias("glucose_value"),
        is_glucose.cast("long").alias("glucose_row"),
    )
    if clinical.lines is not None:
        # diagnoses and labs share their joined rows: read them once
        ln = clinical.lines
        has_lab = F.col("test_name").isNotNull()
        dx_lab = ln.select(
            "patient_id",
            is_t1_dx("code").cast("int").alias("t1_dx"),
            is_t2_dx("code").cast("int").alias("t2_dx"),
            is_related_dx("code").cast("int").alias("related_dx"),
            null_ts.alias("t1_med_date"), null_ts.alias("t2_med_date"),
            (has_lab & is_glucose_tested("test_name")).cast("int").alias("glucose_tested"),
            (has_lab & is_abnormal_lab("test_name", "value")).cast("int").alias("abnormal_lab"),
            F.when(has_lab & is_glucose, F.col("value")).alias("glucose_value"),
            (has_lab & is_glucose).cast("long").alias("glucose_row"),
        )
        events = dx_lab.unionByName(med)
    else:
        events = dx.unionByName(med).unionByName(lab)
    return events.groupBy("patient_id").agg(
        F.max("t1_dx").alias("t1_dx"),
        F.max("t2_dx").alias("t2_dx"),
        F.max("related_dx").alias("related_dx"),
        F.min("t1_med_date").alias("t1_med_first"),
        F.min("t2_med_date").alias("t2_med_first"),
        F.max("glucose_tested").alias("glucose_tested"),
        F.max("abnormal_lab").alias("abnormal_lab"),
        F.sum("glucose_value").alias("glucose_sum"),
        F.sum("glucose_row").alias("glucose_n"),
    )


# Rule pieces over the flags frame ------------------------------------------

def case_base() -> Column:
    """A type-2 diagnosis and no type-1 diagnosis."""
    return (F.col("t2_dx") == 1) & (F.col("t1_dx") == 0)


def case_path_1() -> Column:
    """R2: base and no type-1 medication."""
    return case_base() & F.col("t1_med_first").isNull()


def case_path_2() -> Column:
    """Base, type-1 medication, no type-2 medication."""
    return case_base() & F.col("t1_med_first").isNotNull() & F.col("t2_med_first").isNull()


def case_path_3() -> Column:
    """Base, both medications, earliest type-2 strictly before earliest type-1."""
    return (case_base() & F.col("t1_med_first").isNotNull() & F.col("t2_med_first").isNotNull()
            & (F.col("t1_med_first") > F.col("t2_med_first")))


def is_case() -> Column:
    return case_path_1() | case_path_2() | case_path_3()


def is_control() -> Column:
    """Glucose tested, no abnormal lab, no diabetes-related diagnosis."""
    return ((F.col("glucose_tested") == 1) & (F.col("abnormal_lab") == 0)
            & (F.col("related_dx") == 0))


def label_column() -> Column:
    """Case 1, control 2, other 3 (the classes cannot overlap)."""
    return (F.when(is_case(), F.lit(CASE)).when(is_control(), F.lit(CONTROL))
            .otherwise(F.lit(OTHER)))


def labels_from_flags(flags: DataFrame) -> DataFrame:
    return flags.select("patient_id", label_column().alias("label"))


def phenotype_labels(clinical: ClinicalFrames, day_precision: bool = False) -> DataFrame:
    """``(patient_id string, label int)`` for every patient in any event set."""
    return labels_from_flags(patient_flags(clinical, day_precision))


def patients_where(flags: DataFrame, cond: Column) -> DataFrame:
    return flags.filter(cond).select("patient_id")


# ---------------------------------------------------------------------------
# Mean of "glucose" labs per label
# ---------------------------------------------------------------------------

def _means_for_all_labels(per_patient: DataFrame, label: Column) -> DataFrame:
    """``(label, mean_glucose)`` for labels 1, 2, 3 from per-patient (s, n) pieces.

    One global conditional aggregate (partial sums map-side, one row out),
    unpacked into three rows; an empty class reports 0.0. No join.
    """
    aggs = []
    for k in (CASE, CONTROL, OTHER):
        aggs += [F.sum(F.when(label == k, F.col("s"))).alias(f"s{k}"),
                 F.sum(F.when(label == k, F.col("n"))).alias(f"n{k}")]
    one = per_patient.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(k).alias("label"),
                              F.coalesce(F.col(f"s{k}") / F.col(f"n{k}"), F.lit(0.0)).alias("mean_glucose"))
                     for k in (CASE, CONTROL, OTHER)])
    return one.select(F.inline(rows))


def glucose_mean_by_label(lab: DataFrame, labels: DataFrame) -> DataFrame:
    """Row-weighted mean of labs named ``glucose`` (any case) per label 1/2/3.

    Labs are first reduced to (sum, count) per patient (map-side combine), so
    the join with the labels moves one row per patient, not one per lab row.
    An empty class reports 0.0.
    """
    per_patient = (lab.filter(F.lower("test_name") == F.lit(V.GLUCOSE_MEAN_TEST))
                   .groupBy("patient_id")
                   .agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n")))
    return _means_for_all_labels(per_patient.join(labels, "patient_id", "inner"), F.col("label"))


def glucose_mean_from_flags(flags: DataFrame) -> DataFrame:
    """A8 straight from :func:`patient_flags` (no second pass over the labs)."""
    pieces = flags.select(label_column().alias("label"),
                          F.col("glucose_sum").alias("s"), F.col("glucose_n").alias("n"))
    return _means_for_all_labels(pieces, F.col("label"))


# ---------------------------------------------------------------------------
# Patient sets
# ---------------------------------------------------------------------------

def event_patients(events: DataFrame, cond: Column) -> DataFrame:
    """Distinct patients with an event that meets ``cond``; reads that one event frame only."""
    return events.filter(cond).select("patient_id").distinct()


#: Set name -> condition on the flags. The first four are read off directly, the rest are the rule's pieces.
MEMBERSHIP = {
    "t1_dx": lambda: F.col("t1_dx") == 1,
    "t2_dx": lambda: F.col("t2_dx") == 1,
    "t1_med": lambda: F.col("t1_med_first").isNotNull(),
    "t2_med": lambda: F.col("t2_med_first").isNotNull(),
    "t2_med_before_t1": lambda: F.col("t1_med_first") > F.col("t2_med_first"),
    "glucose": lambda: F.col("glucose_tested") == 1,
    "abnormal": lambda: F.col("abnormal_lab") == 1,
    "related": lambda: F.col("related_dx") == 1,
}


def memberships(flags: DataFrame) -> DataFrame:
    """``(patient_id, member_of array<string>)``: the sets each patient is in."""
    names = F.array(*[F.when(cond(), F.lit(name)) for name, cond in MEMBERSHIP.items()])
    return flags.select("patient_id", F.array_compact(names).alias("member_of"))


def all_patients(clinical: ClinicalFrames) -> DataFrame:
    """Distinct patient ids across the three event sets."""
    if clinical.lines is not None:   # dx and lab rows are both lines: read the join once
        return (clinical.lines.select("patient_id")
                .unionByName(clinical.med.select("patient_id")).distinct())
    return (clinical.dx.select("patient_id")
            .unionByName(clinical.lab.select("patient_id"))
            .unionByName(clinical.med.select("patient_id"))
            .distinct())


def member_sets(flags: DataFrame) -> dict[str, DataFrame]:
    """``{set name: (patient_id)}`` over a stored membership table, with ``patients`` for all of them.

    The table is checkpointed, one narrow row a patient, so any number of set
    operations reads it and none runs the event join again.
    """
    stored = memberships(flags).checkpoint(eager=True)
    sets = {name: stored.filter(F.array_contains("member_of", name)).select("patient_id") for name in MEMBERSHIP}
    return {"patients": stored.select("patient_id"), **sets}
