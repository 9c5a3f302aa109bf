"""Value sets of the type-2 diabetes phenotype and the feature candidate lists.

All sets are small constants. In Spark they become ``isin`` predicates, which
Catalyst turns into a hashed ``InSet`` inside the scan's codegen stage, so no
join and no broadcast is needed for them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: these must equal the reference criteria exactly (order kept as
# published, duplicates kept where the published list repeats an entry).
# ---------------------------------------------------------------------------

# V1: type-1 diabetes diagnosis codes.
T1DM_DX = [
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43",
    "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93",
]

# V2: type-2 diabetes diagnosis codes.
T2DM_DX = [
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6",
    "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
]

# V3: type-1 diabetes medications (lower case).
T1DM_MED = [
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
    "insulin reg", "insulin,ultralente",
]

# V4: type-2 diabetes medications (lower case; "glucatrol " keeps its trailing space).
T2DM_MED = [
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol xl",
    "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl",
    "repaglinide", "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
    "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide",
    "avandia", "actos", "actos", "glipizide",
]

# V5: diabetes-related diagnosis codes (case-sensitive; "V77.1" upper case).
DM_RELATED_DX = [
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648.0", "648.00",
    "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
]
# V5 wildcard row "250.*": any code with this prefix is diabetes related.
DM_RELATED_PREFIX = "250."

# Substring that marks a patient as glucose-tested (lower-cased lab name).
GLUCOSE_TESTED_SUBSTRING = "glucose"
# Lab name (lower-cased, exact) whose mean is reported per label.
GLUCOSE_MEAN_TEST = "glucose"

# V7: abnormal-lab rules (lower-cased exact test name, comparison, threshold).
ABNORMAL_LAB_RULES = [
    ("hba1c", ">=", 6.0),
    ("hemoglobin a1c", ">=", 6.0),
    ("fasting glucose", ">=", 110.0),
    ("fasting blood glucose", ">=", 110.0),
    ("fasting plasma glucose", ">=", 110.0),
    ("glucose", ">", 110.0),
    ("glucose, serum", ">", 110.0),
]

# V8: candidate lists as shipped, one entry per line in file order (before
# lower-casing). Line 19 of the diagnosis list holds many codes separated by
# bare carriage returns; they are listed here already split, in order.
MED_FILTER_LINES = [
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
    "insulin reg", "insulin,ultralente", "chlorpropamide", "diabinese", "diabanase", "diabinase",
    "glipizide", "glucotrol", "glucotrol XL", "glucatrol ", "glyburide", "micronase", "glynase",
    "diabetamide", "diabeta", "glimepiride", "amaryl", "repaglinide", "prandin", "nateglinide",
    "metformin", "rosiglitazone", "pioglitazone", "acarbose", "miglitol", "sitagliptin", "exenatide",
    "tolazamide", "acetohexamide", "troglitazone", "tolbutamide", "avandia", "actos", "ACTOS", "glipizide",
]

LAB_FILTER_LINES = [
    "HbA1c", "Hemoglobin A1c", "Fasting Glucose", "Fasting blood glucose", "fasting plasma glucose",
    "Glucose", "glucose", "Glucose, Serum",
    "HbA1c", "Hemoglobin A1c", "Fasting Glucose", "Fasting blood glucose", "fasting plasma glucose",
    "Glucose", "glucose", "Glucose, Serum",
]

ICD9_FILTER_LINES = [
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648.0", "648.00",
    "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
    # line 19, split at bare CR
    "250", "250.0", "250.00", "250.01", "250.02", "250.03", "250.1", "250.10", "250.11", "250.12",
    "250.13", "250.2", "250.20", "250.21", "250.22", "250.23", "250.3", "250.30", "250.31", "250.32",
    "250.33", "250.4", "250.40", "250.41", "250.42", "250.43", "250.5", "250.50", "250.51", "250.52",
    "250.53", "250.6", "250.60", "250.61", "250.62", "250.63", "250.7", "250.70", "250.71", "250.72",
    "250.73", "250.8", "250.80", "250.81", "250.82", "250.83", "250.9", "250.90", "250.91", "250.92",
    "250.93",
    # lines 20-55
    "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43", "250.51",
    "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93", "250.32",
    "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6", "250.62",
    "250.5", "250.52", "250.4", "250.42", "250", "250.02",
]

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------


def _lower_distinct(lines: list[str]) -> list[str]:
    """Lower-case every line and keep first occurrences (the loader's set semantics)."""
    seen: dict[str, None] = {}
    for line in lines:
        seen.setdefault(line.lower(), None)
    return list(seen)


def candidate_medications() -> list[str]:
    return _lower_distinct(MED_FILTER_LINES)


def candidate_labs() -> list[str]:
    return _lower_distinct(LAB_FILTER_LINES)


def candidate_diagnoses() -> list[str]:
    return _lower_distinct(ICD9_FILTER_LINES)
