"""Clinical event frames.

Two sources produce the same three typed frames:

* :func:`clinical_view` derives them from the star-schema tables ``orders``
  and ``lineitem`` (an encounter / encounter-line shape), deterministically.
* :func:`medcohort.sources.csv_tables.load_clinical_csv` reads the raw CSV
  exports (encounters, encounter diagnoses, lab results, medication orders).

Frames:

* ``dx``  (patient_id string, code string, date timestamp)
* ``med`` (patient_id string, date timestamp, medicine string)  -- lower case
* ``lab`` (patient_id string, date timestamp, test_name string, value double)
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medcohort.functions.sqltext import case_lookup
from medcohort.session import state_dir


@dataclass(frozen=True)
class ClinicalFrames:
    """The three event frames (medication, lab, diagnosis).

    ``lines`` is optional: when diagnoses and labs come from the same joined
    rows, it holds those rows once, as ``(patient_id, code, date, lab_date,
    test_name, value)`` with the lab columns NULL on rows that are not labs.
    Operators that read both domains use it so the join runs once.
    """

    med: DataFrame
    lab: DataFrame
    dx: DataFrame
    lines: DataFrame | None = None


# ---------------------------------------------------------------------------
# FIXED VALUES of the clinical view: key remainder -> item.
# ---------------------------------------------------------------------------
DX_CODE_BY_PARTKEY_MOD_200 = {
    0: "250.01", 1: "250.13", 10: "250.00", 11: "250.02", 12: "250.42", 13: "250.6",
    14: "250.92", 20: "790.21", 21: "256.4", 22: "250.10", 23: "V77.1",
}
DX_CODE_DEFAULT_PREFIX = "D"

MED_BY_ORDERKEY_MOD_20 = {0: "Lantus", 1: "METFORMIN", 2: "glipizide", 3: "insulin aspart"}
MED_DEFAULT_PREFIX = "drug "

LAB_BY_SUPPKEY_MOD_10 = {
    0: "Glucose", 1: "glucose", 2: "HbA1c", 3: "Hemoglobin A1c", 4: "Fasting Glucose",
    5: "Glucose, Serum", 6: "fasting plasma glucose",
}
LAB_DEFAULT_PREFIX = "lab "
LAB_A1C_REMAINDERS = (2, 3)          # value = 3.05 + quantity * 0.06
LAB_A1C_BASE, LAB_A1C_SLOPE = 3.05, 0.06
LAB_OTHER_BASE = 62.0                # value = 62 + quantity
# ---------------------------------------------------------------------------


def _lookup(key_sql: str, table: dict[int, str], prefix: str) -> Column:
    """CASE key WHEN k THEN v ... ELSE prefix || key (a codegen'd CASE, no join)."""
    return F.expr(case_lookup(key_sql, table, prefix))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def encounter_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders JOIN lineitem on the order key, pruned to the columns the view uses.

    At scale this is the one large join of the workload: both sides are hash
    partitioned on the order key (sort-merge join); AQE splits a skewed order
    key and coalesces small partitions.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                         "l_returnflag", "l_shipdate")
    return o.join(li, o.o_orderkey == li.l_orderkey, "inner")


def clinical_view(orders: DataFrame, lineitem: DataFrame, patients: DataFrame | None = None) -> ClinicalFrames:
    """Derive dx / med / lab frames (and the fused ``lines``) from ``orders`` and ``lineitem``.

    ``patients (patient_id)`` restricts the frames to a set of patients (F9, J2). The semi join runs on the encounters,
    before they meet their lines, so only the set's encounters are shuffled by order key; where Spark finds the lines'
    side large enough, it also builds a runtime Bloom filter of their order keys for the scan of the lines.
    """
    if patients is not None:
        keep = patients.select(F.col("patient_id").alias("_kept"))
        orders = orders.join(keep, F.col("o_custkey").cast("string") == F.col("_kept"), "left_semi")
    lines = encounter_lines(orders, lineitem)
    patient = F.col("o_custkey").cast("string").alias("patient_id")
    code = _lookup("(l_partkey % 200)", DX_CODE_BY_PARTKEY_MOD_200, DX_CODE_DEFAULT_PREFIX)
    rem = F.col("l_suppkey") % 10
    test_name = _lookup("(l_suppkey % 10)", LAB_BY_SUPPKEY_MOD_10, LAB_DEFAULT_PREFIX)
    value = (F.when(rem.isin(*LAB_A1C_REMAINDERS),
                    F.lit(LAB_A1C_BASE) + F.col("l_quantity") * F.lit(LAB_A1C_SLOPE))
             .otherwise(F.lit(LAB_OTHER_BASE) + F.col("l_quantity")))
    is_lab = F.col("l_returnflag") != "N"

    dx = lines.select(patient, code.alias("code"), F.col("o_orderdate").alias("date"))
    med = orders.select(
        patient, F.col("o_orderdate").alias("date"),
        F.lower(_lookup("(o_orderkey % 20)", MED_BY_ORDERKEY_MOD_20, MED_DEFAULT_PREFIX)).alias("medicine"))
    # the filter on the return flag reaches the lineitem scan for lab-only plans
    lab = lines.filter(is_lab).select(
        patient, F.col("l_shipdate").alias("date"), test_name.alias("test_name"), value.alias("value"))
    fused = lines.select(
        patient, code.alias("code"), F.col("o_orderdate").alias("date"),
        F.when(is_lab, F.col("l_shipdate")).alias("lab_date"),
        F.when(is_lab, test_name).alias("test_name"),
        F.when(is_lab, value).alias("value"))
    return ClinicalFrames(med=med, lab=lab, dx=dx, lines=fused)


def load_clinical_view(spark: SparkSession, sf_dir: str, patients: DataFrame | None = None) -> ClinicalFrames:
    """Read ``orders`` and ``lineitem`` from ``sf_dir`` and derive the frames, of some ``patients`` if given."""
    return clinical_view(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"), patients)


def stored_patients(patients: DataFrame) -> DataFrame:
    """The distinct ids of ``patients``, written once below the shared checkpoint folder and read under a comparison.

    The comparison holds for every id. It marks the set as selective to the optimizer, so that, where the encounters are
    large (``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``) and the set is small
    (``...creationSideThreshold``), a Bloom filter of the ids reaches the scan of the encounters, and one of their order
    keys the scan of the lines. Null ids match nothing and go.
    """
    spark = patients.sparkSession
    path = state_dir(spark, f"patients-{uuid.uuid4().hex}")
    patients.select("patient_id").distinct().write.parquet(path)
    return spark.read.parquet(path).where(F.col("patient_id") >= "")


# DuckDB / ANSI text of the same view, used by the SQL oracles.
def _sql_case(key: str, table: dict[int, str], prefix: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in table.items())
    return f"CASE {key} {whens} ELSE '{prefix}' || CAST({key} AS VARCHAR) END"


def clinical_view_sql() -> str:
    """``WITH`` clauses defining ``dx``, ``med`` and ``lab`` over orders / lineitem."""
    dx_code = _sql_case("(l.l_partkey % 200)", DX_CODE_BY_PARTKEY_MOD_200, DX_CODE_DEFAULT_PREFIX)
    med_name = _sql_case("(o_orderkey % 20)", MED_BY_ORDERKEY_MOD_20, MED_DEFAULT_PREFIX)
    lab_name = _sql_case("(l.l_suppkey % 10)", LAB_BY_SUPPKEY_MOD_10, LAB_DEFAULT_PREFIX)
    a1c = ", ".join(str(r) for r in LAB_A1C_REMAINDERS)
    return f"""
dx AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id, {dx_code} AS code, o.o_orderdate AS date
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
),
med AS (
  SELECT CAST(o_custkey AS VARCHAR) AS patient_id, o_orderdate AS date, lower({med_name}) AS medicine
  FROM orders
),
lab AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id, l.l_shipdate AS date, {lab_name} AS test_name,
         CASE WHEN (l.l_suppkey % 10) IN ({a1c})
              THEN CAST({LAB_A1C_BASE} AS DOUBLE) + l.l_quantity * CAST({LAB_A1C_SLOPE} AS DOUBLE)
              ELSE CAST({LAB_OTHER_BASE} AS DOUBLE) + l.l_quantity END AS value
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  WHERE l.l_returnflag <> 'N'
)"""
