"""Sinks: tab-separated exports of labels and feature tuples (S11, S12) and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# FIXED VALUE: the purity report line (feature set, algorithm, inverse purity),
# kept equal to the reference's printed output.
REPORT_FORMAT = "[%s feature] getPurity of %s is: %.5f"


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed TSV write (one file per partition, no header)."""
    df.write.mode(mode).option("sep", "\t").option("header", False).csv(path)


def write_labels_tsv(labels: DataFrame, path: str) -> None:
    """``patient<TAB>label`` lines."""
    write_tsv(labels.select("patient_id", F.col("label").cast("string")), path)


def write_feature_tuples_tsv(tuples: DataFrame, path: str) -> None:
    """``patient<TAB>feature<TAB>value`` lines."""
    write_tsv(tuples.select("patient_id", "feature", F.col("value").cast("string")), path)


def purity_report_lines(report: DataFrame) -> DataFrame:
    """``[<set> feature] getPurity of <algorithm> is: <x.xxxxx>`` per row."""
    return report.select(report_line().alias("line"))


def report_line():
    """The report line of one ``(feature_set, algorithm, inverse_purity)`` row."""
    return F.format_string(REPORT_FORMAT, F.col("feature_set"), F.col("algorithm"), F.col("inverse_purity"))
