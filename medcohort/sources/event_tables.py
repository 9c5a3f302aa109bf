"""Event tables bucketed by patient: per-patient work on them needs no shuffle of events.

The encounter join runs once, when the tables are written. Both tables are hash bucketed on the patient with the same
number of buckets and sorted within them, so the scans are already partitioned the way every per-patient aggregate asks for:
the feature tuples have no exchange at all, the label rule exchanges one partial row a patient and table. The tables
live in the session's catalog and warehouse; a later session finds them by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medcohort.sources.clinical import ClinicalFrames

#: Least number of buckets of each table: the cores that should work on them.
BUCKETS = 16
#: Lines of one bucket on average. A bucket is one task of every later query, so its memory is bounded at any size.
BUCKET_LINES = 500_000


def _names(name: str) -> tuple[str, str]:
    return f"{name}_lines", f"{name}_med"


def save_event_tables(clinical: ClinicalFrames, name: str, buckets: int | None = None,
                      bucket_lines: int = BUCKET_LINES) -> None:
    """Write the fused lines and the medications as ``{name}_lines`` and ``{name}_med``; existing ones are replaced.

    Without a number of ``buckets`` the events are counted first: there are at least ``BUCKETS``, of about
    ``bucket_lines`` events of the larger table each.
    Frames without fused lines (from CSV exports) are fused by a union: a line is then a diagnosis or a lab.
    """
    lines = clinical.lines
    if lines is None:
        none = lambda kind: F.lit(None).cast(kind)
        stamp = clinical.lab.schema["date"].dataType
        lines = clinical.dx.select("patient_id", "code", "date", none(stamp).alias("lab_date"), none("string").alias("test_name"),
                                   none("double").alias("value")).unionByName(
            clinical.lab.select("patient_id", none("string").alias("code"), none(stamp).alias("date"),
                                F.col("date").alias("lab_date"), "test_name", "value"))
    if buckets is None:
        buckets = max(BUCKETS, -(-max(lines.count(), clinical.med.count()) // bucket_lines))
    for df, table in zip((lines, clinical.med), _names(name), strict=True):
        dealt = df.repartition(buckets, "patient_id")   # one file a bucket
        dealt.write.bucketBy(buckets, "patient_id").sortBy("patient_id").mode("overwrite").format("parquet").saveAsTable(table)


def load_event_tables(spark: SparkSession, name: str) -> ClinicalFrames:
    """The frames of :func:`save_event_tables`, fused lines included."""
    lines, med = (spark.table(t) for t in _names(name))
    dx = lines.where(F.col("code").isNotNull()).select("patient_id", "code", "date")
    lab = lines.where(F.col("test_name").isNotNull()).select("patient_id", F.col("lab_date").alias("date"), "test_name", "value")
    return ClinicalFrames(med=med, lab=lab, dx=dx, lines=lines)


def drop_event_tables(spark: SparkSession, name: str) -> None:
    for table in _names(name):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
