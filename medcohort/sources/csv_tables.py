"""Raw CSV exports, code lists and criteria tables.

The raw files are headed, comma separated and read as all-string columns with
malformed rows dropped. Each read switches CSV column pruning off for itself, so
DROPMALFORMED judges whole rows, as a reader without pruning does.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medcohort.functions.parsing import parse_instant, parse_us_number
from medcohort.sources.clinical import ClinicalFrames

# FIXED VALUES: raw file names and the views the loader registers.
ENCOUNTER_FILE, ENCOUNTER_VIEW = "encounter_INPUT.csv", "diag"
ENCOUNTER_DX_FILE, ENCOUNTER_DX_VIEW = "encounter_dx_INPUT.csv", "diag_dx"
LAB_FILE, LAB_VIEW = "lab_results_INPUT.csv", "lab"
MED_FILE, MED_VIEW = "medication_orders_INPUT.csv", "med"
MED_FILTER_FILE, LAB_FILTER_FILE, DX_FILTER_FILE = "med_filter.txt", "lab_filter.txt", "icd9_filter.txt"
_VIEW_NAME = re.compile(r"(\w+)(\.csv)?$", re.ASCII)   # Java's \w is ASCII



def infer_table_name(path: str) -> str:
    """S3: trailing word characters before an optional ``.csv``; else the path."""
    m = _VIEW_NAME.search(path)
    return m.group(1) if m else path


def load_csv_as_table(spark: SparkSession, path: str, table_name: str | None = None) -> DataFrame:
    """Headed CSV, all strings, malformed rows dropped, temp view."""
    df = (spark.read.option("header", True).option("mode", "DROPMALFORMED")
          .option("columnPruning", False).option("delimiter", ",").csv(path))
    df.createOrReplaceTempView(table_name or infer_table_name(path))
    return df


def source_table_name() -> Column:
    """C4: the view name :func:`infer_table_name` gives each row's source file."""
    return F.regexp_extract(F.input_file_name(), _VIEW_NAME.pattern, 1)


def _required(col: str, what: str, on_error: str) -> Column:
    """A used column must be non-NULL: fail the task (default) or keep NULL for dropping."""
    c = F.col(col)
    if on_error == "drop":
        return c
    return F.when(c.isNull(), F.raise_error(F.lit(f"NULL {what}"))).otherwise(c)


def _path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}"


_EXPORTS = ((ENCOUNTER_FILE, ENCOUNTER_VIEW), (ENCOUNTER_DX_FILE, ENCOUNTER_DX_VIEW), (LAB_FILE, LAB_VIEW),
            (MED_FILE, MED_VIEW))


def _register_views(spark: SparkSession, data_dir: str) -> None:
    for file, view in _EXPORTS:
        load_csv_as_table(spark, _path(data_dir, file), view)


def count_malformed_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """``(file, malformed_rows)``: rows of each export that the loader drops for a wrong number of fields."""
    parts = []
    for file, _ in _EXPORTS:
        path, record = _path(data_dir, file), "_malformed_record"
        schema = spark.read.option("header", True).csv(path).schema.add(record, "string")
        rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                .option("columnPruning", False).option("columnNameOfCorruptRecord", record).csv(path))
        whole = F.concat(record, F.coalesce(F.col(schema[0].name), F.lit("")))   # the record alone may not be read
        parts.append(rows.agg(F.count(whole).alias("malformed_rows")).select(F.lit(file).alias("file"), "malformed_rows"))
    return reduce(DataFrame.unionByName, parts)


def write_clinical_csv(clinical: ClinicalFrames, data_dir: str) -> None:
    """Write typed frames as the four raw exports, one folder of part files each.

    An encounter is a patient at a time; dates are written to the second in UTC,
    numbers with grouping commas and six decimals, drug names in upper case.
    """
    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("header", True).csv(_path(data_dir, name))

    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    encounter = F.concat_ws("-", "patient_id", stamp("date")).alias("Encounter_ID")
    dx, lab, med = clinical.dx, clinical.lab, clinical.med
    write(dx.select(encounter, F.col("patient_id").alias("Member_ID"), stamp("date").alias("Encounter_DateTime")).distinct(),
          ENCOUNTER_FILE)
    write(dx.select(encounter, F.col("code").alias("Code_ID")), ENCOUNTER_DX_FILE)
    write(lab.select(F.col("patient_id").alias("Member_ID"), stamp("date").alias("Date_Resulted"),
                     F.col("test_name").alias("Result_Name"), F.format_number("value", 6).alias("Numeric_Result")), LAB_FILE)
    write(med.select(F.col("patient_id").alias("Member_ID"), stamp("date").alias("Order_Date"),
                     F.upper("medicine").alias("Drug_Name")), MED_FILE)


def load_clinical_csv(spark: SparkSession, data_dir: str, on_error: str = "fail") -> ClinicalFrames:
    """Typed medication, lab and diagnosis frames from the raw CSV files.

    * diagnoses: encounters JOIN encounter diagnoses on Encounter_ID (J1);
    * labs: rows with an empty or NULL numeric result are dropped, numbers are
      parsed US style (grouping commas, trailing text ignored) and NaN dropped;
      the test name keeps its case;
    * medications: the drug name is lower-cased.

    A non-empty date or number that does not parse fails the job
    (``on_error="fail"``, as the reference's parser did) or drops the row
    (``on_error="drop"``).
    """
    mode = "null" if on_error == "drop" else "fail"
    _register_views(spark, data_dir)

    dx = spark.sql(
        f"SELECT d.Member_ID, x.Code_ID, d.Encounter_DateTime FROM {ENCOUNTER_VIEW} d "
        f"JOIN {ENCOUNTER_DX_VIEW} x ON d.Encounter_ID = x.Encounter_ID"
    ).select(_required("Member_ID", "Member_ID", on_error).alias("patient_id"),
             _required("Code_ID", "Code_ID", on_error).alias("code"),
             parse_instant(_required("Encounter_DateTime", "Encounter_DateTime", on_error), mode).alias("date"))

    lab = (spark.sql(f"SELECT Member_ID, Date_Resulted, Result_Name, Numeric_Result FROM {LAB_VIEW} "
                     "WHERE Numeric_Result IS NOT NULL")
           .filter(F.length("Numeric_Result") > 0)
           .select(_required("Member_ID", "Member_ID", on_error).alias("patient_id"),
                   parse_instant(_required("Date_Resulted", "Date_Resulted", on_error), mode).alias("date"),
                   _required("Result_Name", "Result_Name", on_error).alias("test_name"),
                   parse_us_number(F.col("Numeric_Result"), mode).alias("value"))
           .filter(~F.isnan("value")))

    med = spark.sql(f"SELECT Member_ID, Order_Date, Drug_Name FROM {MED_VIEW}").select(
        _required("Member_ID", "Member_ID", on_error).alias("patient_id"),
        parse_instant(_required("Order_Date", "Order_Date", on_error), mode).alias("date"),
        F.lower(_required("Drug_Name", "Drug_Name", on_error)).alias("medicine"))

    if on_error == "drop":
        dx = dx.dropna()
        lab = lab.dropna()
        med = med.dropna()
    return ClinicalFrames(med=med, lab=lab, dx=dx)


def count_invalid_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows the strict loader would fail on, counted per frame in one pass each.

    ``(frame, bad_rows)``: NULL ids, codes, names or dates, and non-empty
    dates or numbers that do not parse.
    """
    _register_views(spark, data_dir)
    checks = {
        "dx": (f"SELECT d.Member_ID AS id, x.Code_ID AS item, d.Encounter_DateTime AS t, '0' AS num "
               f"FROM {ENCOUNTER_VIEW} d JOIN {ENCOUNTER_DX_VIEW} x ON d.Encounter_ID = x.Encounter_ID"),
        "lab": (f"SELECT Member_ID AS id, Result_Name AS item, Date_Resulted AS t, Numeric_Result AS num "
                f"FROM {LAB_VIEW} WHERE Numeric_Result IS NOT NULL AND length(Numeric_Result) > 0"),
        "med": f"SELECT Member_ID AS id, Drug_Name AS item, Order_Date AS t, '0' AS num FROM {MED_VIEW}",
    }
    parts = []
    for name, sql in checks.items():
        df = spark.sql(sql)
        bad = (F.col("id").isNull() | F.col("item").isNull() | F.col("t").isNull()
               | parse_instant(F.col("t"), "null").isNull()
               | parse_us_number(F.col("num"), "null").isNull())
        parts.append(df.agg(F.sum(bad.cast("long")).alias("bad_rows"))
                     .select(F.lit(name).alias("frame"), F.coalesce("bad_rows", F.lit(0)).alias("bad_rows")))
    return reduce(DataFrame.unionByName, parts)


class LoadFaults(ValueError):
    """An observed load met rows that it may not use; ``counts`` has a row of counts for each export."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.counts = counts
        told = "; ".join(f"{file}: " + ", ".join(f"{n} {what}" for what, n in c.items() if what in FAULTS and n)
                         for file, c in counts.items() if any(c[what] for what in FAULTS))
        super().__init__(f"unusable rows, {told}")


#: Counts that fail a load; rows and malformed rows (dropped, as the reader's mode says) are only reported.
FAULTS = ("missing", "bad_dates", "bad_numbers")
#: Required columns, the date column and the number column of each export.
_CONTENT = {
    ENCOUNTER_FILE: (("Encounter_ID", "Member_ID", "Encounter_DateTime"), "Encounter_DateTime", None),
    ENCOUNTER_DX_FILE: (("Encounter_ID", "Code_ID"), None, None),
    LAB_FILE: (("Member_ID", "Date_Resulted", "Result_Name"), "Date_Resulted", "Numeric_Result"),
    MED_FILE: (("Member_ID", "Order_Date", "Drug_Name"), "Order_Date", None),
}


def _store_observed(spark: SparkSession, path: str, file: str, to: str) -> tuple[DataFrame, dict[str, int]]:
    """One pass over an export: its usable rows, parsed, written to ``to``, and the counts observed on the way."""
    required, date, number = _CONTENT[file]
    record = "_malformed_record"
    schema = spark.read.option("header", True).csv(path).schema.add(record, "string")
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnPruning", False).option("columnNameOfCorruptRecord", record).csv(path))
    true = F.lit(True)
    malformed = F.col(record).isNotNull()
    # a lab without a result is no fault, it is left out
    used = ~malformed & ((F.coalesce(F.length(number), F.lit(0)) > 0) if number else true)
    missing = used & reduce(Column.__or__, [F.col(c).isNull() for c in required])
    at = parse_instant(F.col(date), "null") if date else F.lit(None).cast("timestamp")
    value = parse_us_number(F.col(number), "null") if number else F.lit(None).cast("double")
    bad_date = used & F.col(date).isNotNull() & at.isNull() if date else ~true
    bad_number = used & value.isNull() if number else ~true
    tested = rows.select("*", malformed.alias("_malformed"), used.alias("_used"), missing.alias("_missing"),
                         bad_date.alias("_bad_date"), bad_number.alias("_bad_number"), at.alias("_at"), value.alias("_value"))
    seen = Observation()
    tested = tested.observe(
        seen, F.count("*").alias("rows"), F.count_if("_malformed").alias("malformed"), F.count_if("_missing").alias("missing"),
        F.count_if("_bad_date").alias("bad_dates"), F.count_if("_bad_number").alias("bad_numbers"))
    good = tested.where("_used AND NOT (_missing OR _bad_date OR _bad_number)")
    good.select(*[c for c in rows.columns if c in required and c != date], "_at", "_value").write.mode("overwrite").parquet(to)
    return spark.read.parquet(to), {k: int(v) for k, v in seen.get.items()}


def load_observed_csv(spark: SparkSession, data_dir: str, store_dir: str, on_error: str = "fail",
                      counts: dict | None = None) -> ClinicalFrames:
    """S6-S9 in one pass over each export, with counts: the frames of :func:`load_clinical_csv` from typed tables.

    Every export is read once; its usable rows are written as Parquet below ``store_dir`` while ``DataFrame.observe``
    counts rows, malformed rows, rows with a NULL required column, and dates and numbers that do not parse. If any of
    the last three is not 0, ``on_error="fail"`` raises :class:`LoadFaults` with the counts of all exports; "drop"
    leaves those rows out. ``counts``, if given, receives them by file.
    """
    stored, found = {}, {} if counts is None else counts
    for file in _CONTENT:
        stored[file], found[file] = _store_observed(spark, _path(data_dir, file), file, _path(store_dir, file.removesuffix(".csv")))
    if on_error == "fail" and any(c[what] for c in found.values() for what in FAULTS):
        raise LoadFaults(found)
    dx = stored[ENCOUNTER_FILE].join(stored[ENCOUNTER_DX_FILE].select("Encounter_ID", "Code_ID"), "Encounter_ID").select(
        F.col("Member_ID").alias("patient_id"), F.col("Code_ID").alias("code"), F.col("_at").alias("date"))
    lab = stored[LAB_FILE].where(~F.isnan("_value")).select(
        F.col("Member_ID").alias("patient_id"), F.col("_at").alias("date"), F.col("Result_Name").alias("test_name"),
        F.col("_value").alias("value"))
    med = stored[MED_FILE].select(F.col("Member_ID").alias("patient_id"), F.col("_at").alias("date"),
                                  F.lower("Drug_Name").alias("medicine"))
    return ClinicalFrames(med=med, lab=lab, dx=dx)


def load_code_list(spark: SparkSession, path: str) -> DataFrame:
    """One lower-cased item per line, de-duplicated, not trimmed.

    Lines may end with LF, CRLF or a bare CR. The list is a one-column frame
    ``(item string)`` for a semi join.
    """
    text = spark.read.text(path)
    items = text.select(F.explode(F.split(F.col("value"), "\r\n|\r|\n")).alias("item"))
    return items.select(F.lower("item").alias("item")).filter(F.length("item") > 0).distinct()


def load_code_lists(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Medication, lab and diagnosis candidate lists (that order)."""
    return (load_code_list(spark, _path(data_dir, MED_FILTER_FILE)),
            load_code_list(spark, _path(data_dir, LAB_FILTER_FILE)),
            load_code_list(spark, _path(data_dir, DX_FILTER_FILE)))


def load_criteria_table(spark: SparkSession, path: str, with_description: bool = True) -> DataFrame:
    """A criteria CSV ``(code[, description])``, quoted commas allowed."""
    schema = "code string, description string" if with_description else "code string"
    return spark.read.schema(schema).option("header", False).csv(path)


def criteria_filter(events: DataFrame, col: str, criteria: DataFrame) -> DataFrame:
    """Events whose ``col`` matches a criteria table; a row like ``250.*`` is a prefix rule.

    Exact codes and prefix rules are left joins against distinct keys (so every
    event row is kept once, duplicates included) that set a hit flag: exact on
    the code, prefixes on the code's leading characters, one equi join per
    distinct prefix length (a handful: bounded by the length of a code).
    """
    codes = criteria.select(F.col("code")).filter(F.col("code").isNotNull())
    exact = (codes.filter(~F.col("code").endswith("*")).distinct()
             .select(F.col("code").alias("_key"), F.lit(True).alias("_x")))
    prefix = (codes.filter(F.col("code").endswith("*"))
              .select(F.expr("substring(code, 1, length(code) - 1)").alias("prefix"))
              .withColumn("plen", F.length("prefix")).distinct())
    out = events.withColumn("_hit", F.lit(False))
    keys = [(F.col(col), exact)]
    for (plen,) in prefix.select("plen").distinct().collect():   # distinct lengths only
        p = (prefix.filter(F.col("plen") == plen)
             .select(F.col("prefix").alias("_key"), F.lit(True).alias("_x")))
        keys.append((F.substring(F.col(col), 1, plen), p))
    for key, side in keys:
        out = (out.withColumn("_probe", key).join(side, F.col("_probe") == F.col("_key"), "left")
               .withColumn("_hit", F.col("_hit") | F.coalesce(F.col("_x"), F.lit(False)))
               .drop("_probe", "_key", "_x"))
    return out.filter(F.col("_hit")).drop("_hit")
