"""Contingency counts and purity of a grouping against labels.

Purity = (1/N) * sum over groups of the largest count of any other-value in
that group. Computed as two hash aggregates and one global aggregate; no pair
list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(assignments: DataFrame, row: str = "label", col: str = "cluster") -> DataFrame:
    """``(row, col, n)`` pair counts."""
    return assignments.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def purity(assignments: DataFrame, group: str = "cluster", other: str = "label") -> DataFrame:
    """One row ``(purity double)``.

    ``group="cluster", other="label"`` is purity in its textbook sense. The
    reference passes (label, cluster), i.e. ``group="label", other="cluster"``,
    which is inverse purity; :func:`purity_pair` reports both.
    """
    counts = contingency(assignments, group, other)
    best = counts.groupBy(group).agg(F.max("n").alias("best"), F.sum("n").alias("total"))
    return best.agg((F.sum("best") / F.sum("total")).cast("double").alias("purity"))


def purity_pair(assignments: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """One row ``(n, purity, inverse_purity)`` from a single set of pair counts."""
    counts = contingency(assignments, cluster, label)
    best_c = counts.groupBy(cluster).agg(F.max("n").alias("b")).agg(F.sum("b")).scalar()
    best_l = counts.groupBy(label).agg(F.max("n").alias("b")).agg(F.sum("b")).scalar()
    total = counts.agg(F.sum("n").alias("n"))
    return total.select("n", (best_c / F.col("n")).alias("purity"),
                        (best_l / F.col("n")).alias("inverse_purity"))


def purity_by(assignments: DataFrame, keys: list[str], cluster: str = "cluster",
              label: str = "label") -> DataFrame:
    """``(keys..., n, purity, inverse_purity)`` for many groupings in one job.

    ``assignments`` stacks several groupings, told apart by ``keys`` (for
    example feature set and algorithm). One aggregate gives the pair counts
    of all of them; the maxima and totals are small aggregates over those.
    """
    counts = assignments.groupBy(*keys, label, cluster).agg(F.count(F.lit(1)).alias("n"))
    by_cluster = counts.groupBy(*keys, cluster).agg(F.max("n").alias("best"), F.sum("n").alias("tot"))
    by_label = counts.groupBy(*keys, label).agg(F.max("n").alias("best"))
    p = by_cluster.groupBy(*keys).agg(F.sum("best").alias("best_c"), F.sum("tot").alias("n"))
    q = by_label.groupBy(*keys).agg(F.sum("best").alias("best_l"))
    return p.join(q, keys).select(*keys, "n", (F.col("best_c") / F.col("n")).alias("purity"),
                                  (F.col("best_l") / F.col("n")).alias("inverse_purity"))
