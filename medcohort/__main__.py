"""Run the cohort study and print the purity report.

    python -m medcohort --tables /root/testdata/sf0.01          # clinical view over parquet tables
    python -m medcohort --csv data/ [--lists data/]             # raw CSV exports (+ candidate list files)
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from medcohort.plans.study import run_cohort_study
from medcohort.sources.clinical import load_clinical_view
from medcohort.sources.csv_tables import load_clinical_csv, load_code_lists
from medcohort.sources.sinks import purity_report_lines


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="medcohort")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with orders.parquet and lineitem.parquet")
    src.add_argument("--csv", help="folder with the raw CSV exports")
    ap.add_argument("--lists", help="folder with med_filter.txt, lab_filter.txt, icd9_filter.txt")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("medcohort").getOrCreate()   # master and settings come from spark-submit
    clinical = load_clinical_view(spark, args.tables) if args.tables else load_clinical_csv(spark, args.csv)
    lists = None
    if args.lists:
        med, lab, dx = load_code_lists(spark, args.lists)
        lists = {"candidate_dx": dx, "candidate_lab": lab, "candidate_med": med}
    report = run_cohort_study(clinical, candidate_lists=lists).orderBy("feature_set", "algorithm")
    for row in purity_report_lines(report).collect():   # six lines
        print(row.line)


if __name__ == "__main__":
    main()
