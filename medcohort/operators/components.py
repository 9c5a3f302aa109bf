"""Principal components of any width by block power iteration on the long form (L1-L3).

The points are sparse entries ``(patient_id, idx, value)``; the basis is a table ``(idx, b0, b1, ...)``. A round is two
joins with partial aggregates: scores of the patients on the basis, then the entries' sums of those scores by
coordinate. Only sums over pairs of basis columns (a few hundred numbers) reach the driver, so neither a
width x width matrix nor a basis vector does, however large the vocabulary. Centring is never applied to the
entries: the mean's own scores are taken off, so nothing is filled up.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.operators.features import feature_moments
from medcohort.session import state_dir

#: Columns of the basis beyond those asked for; they only speed up convergence.
OVERSAMPLE = 6
ROUNDS, TOL = 60, 1e-6


@dataclass
class Components:
    """``loadings (idx, mean, std, c0, c1, ...)`` of the scaled points, their variances, and the rounds taken."""

    loadings: DataFrame
    variances: list[float]
    rounds: int

    @property
    def k(self) -> int:
        return len(self.variances)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written below the shared folder and read back: rounds neither recompute one another nor depend on executors."""
    path = state_dir(df.sparkSession, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def indexed_moments(tuples: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(idx, mean, std)`` of each feature over all patients, absent entries counting as 0."""
    return feature_moments(tuples).join(dictionary, "feature").select("idx", "mean", "std")


def start_value(j: int) -> Column:
    """Start of basis column ``j``: a wave over the coordinates with a frequency of its own, so no two depend on each
    other, and the same in any run and layout."""
    return F.sin((F.col("idx") + 1) * ((j + 1) * 12.9898))


def _sums(table: DataFrame, names: list[str], scale: float = 1.0) -> np.ndarray:
    """Sums over all rows of the products of every two columns: len(names) squared numbers, symmetric."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = table.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    out = np.zeros((len(names), len(names)))
    for (i, j), x in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = (x or 0.0) * scale
    return out


def _turned(table: DataFrame, names: list[str], matrix: np.ndarray, to: list[str], keep: list[str]) -> DataFrame:
    """Columns ``names`` times a small matrix."""
    new = [" + ".join(f"`{n}` * {float(matrix[i, j])!r}D" for i, n in enumerate(names)) for j in range(matrix.shape[1])]
    return table.selectExpr(*keep, *[f"{e} AS {n}" for e, n in zip(new, to, strict=True)])


def scores(entries: DataFrame, basis: DataFrame, names: list[str]) -> DataFrame:
    """``(patient_id, names...)``: the centred scaled points times the basis columns ``names``."""
    offset = basis.agg(*[F.sum(F.col("mean") * F.col(n)).alias(n) for n in names]).first()
    out = entries.join(basis.drop("mean", "std"), "idx").groupBy("patient_id").agg(
        *[(F.sum(F.col("value") * F.col(n)) - F.lit(offset[n] or 0.0)).alias(n) for n in names])
    return out


def _orthonormal(table: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns made orthonormal by the Cholesky factor of their Gram matrix; dependent ones are left out."""
    gram = _sums(table, names)
    value, vector = np.linalg.eigh(gram)
    keep = value > max(value.max(initial=0.0), 1e-300) * 1e-12
    if keep.all():
        matrix = np.linalg.inv(np.linalg.cholesky(gram)).T
    else:
        matrix = vector[:, keep] / np.sqrt(value[keep])
    to = [f"b{j}" for j in range(matrix.shape[1])]
    return _turned(table, names, matrix, to, ["idx", "mean", "std"]), to


def principal_components(entries: DataFrame, moments: DataFrame, k: int, rounds: int = ROUNDS, tol: float = TOL,
                         oversample: int = OVERSAMPLE) -> Components:
    """The first ``k`` principal components of the points scaled to unit standard deviation.

    ``entries (patient_id, idx, value)`` are the present values, every patient having one at least; ``moments
    (idx, mean, std)``. Stops after ``rounds``, or when no variance asked for changes by more than ``tol`` of the
    largest. Components are ordered by variance and turned so that the largest loading (the first of equal ones)
    is positive.
    """
    spark = entries.sparkSession
    moments = stored(moments.where("std > 0").select("idx", (F.col("mean") / F.col("std")).alias("mean"), "std"), "pca-moments")
    scaled = stored(entries.join(moments.select("idx", "std"), "idx").select(
        "patient_id", "idx", (F.col("value") / F.col("std")).alias("value")), "pca-entries")
    n = entries.select("patient_id").distinct().count()
    width = moments.count()
    size = min(width, k + oversample)
    names = [f"b{j}" for j in range(size)]
    if not size or n < 2:
        return Components(spark.createDataFrame([], "idx int, mean double, std double"), [], 0)
    basis = moments.select("idx", "mean", "std", *[start_value(j).alias(f"b{j}") for j in range(size)])
    basis, names = _orthonormal(basis, names)
    basis = stored(basis, "pca-basis")
    before, taken = np.zeros(0), 0
    while True:
        points = stored(scores(scaled, basis, names), "pca-scores")
        inner = _sums(points, names, 1 / (n - 1))
        value, vector = np.linalg.eigh(inner)
        value, vector = value[::-1], vector[:, ::-1]
        now = value[:k]
        settled = len(before) == len(now) and abs(now - before).max(initial=0.0) <= tol * max(value.max(initial=0.0), 1e-300)
        if taken == rounds or settled:
            break
        before, taken = now, taken + 1
        total = points.agg(*[F.sum(x).alias(x) for x in names]).first()
        back = scaled.join(points, "patient_id").groupBy("idx").agg(*[F.sum(F.col("value") * F.col(x)).alias(x) for x in names])
        moved = moments.join(back, "idx").select(
            "idx", "mean", "std", *[(F.col(x) - F.col("mean") * F.lit(total[x])).alias(x) for x in names])
        basis, names = _orthonormal(stored(moved, "pca-moved"), names)
        basis, names = _orthonormal(stored(basis, "pca-basis"), names)  # twice: once loses digits
        basis = stored(basis, "pca-basis")
    to = [f"c{j}" for j in range(min(k, len(names)))]
    loadings = _turned(basis, names, vector[:, : len(to)], to, ["idx", "mean", "std"])
    top = loadings.agg(*[F.max_by(F.col(c), F.struct(F.abs(F.col(c)), -F.col("idx"))).alias(c) for c in to]).first()
    sign = np.diag([-1.0 if top[c] < 0 else 1.0 for c in to])
    return Components(stored(_turned(loadings, to, sign, to, ["idx", "mean", "std"]), "pca-loadings"),
                      [float(x) for x in now], taken)


def project_long(model: Components, entries: DataFrame) -> DataFrame:
    """L3: ``(patient_id, pca array<double>)`` of any patients' entries ``(patient_id, idx, value)``.

    Coordinates that the fit did not know, or that did not vary, are ignored; a patient with no other is left out.
    """
    names = [f"c{j}" for j in range(model.k)]
    scaled = entries.join(model.loadings.select("idx", "std"), "idx").select(
        "patient_id", "idx", (F.col("value") / F.col("std")).alias("value"))
    return scores(scaled, model.loadings, names).select("patient_id", F.array(*names).alias("pca"))
