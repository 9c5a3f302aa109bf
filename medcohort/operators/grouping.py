"""K-means (L4) and Gaussian mixture (L5) as DataFrame steps with starts that no layout changes.

A point is ``(patient_id, x array<double>)`` of a few coordinates. Each step is one scan of the points: a task sums its
points in numpy, batch by batch, into one row of parameter size, and Spark adds the rows of the tasks. Starts and
assignments are SQL expressions; parameters enter their plans as array literals, which are no part of the generated
code, so they share one compiled form. Only the parameters (k centres,
k covariances) reach the driver. Draws are hashes of the patient id, so a start depends on the points alone, not on
their order or partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, MAX_ITER = 3, 20
#: Rounds of the start's oversampling and candidates of each, as a multiple of k.
START_ROUNDS, START_FACTOR = 2, 2
#: Hex digits of the hash behind a draw.
DRAW_DIGITS = 13
KMEANS_TOL, MIXTURE_TOL = 1e-4, 1e-2
#: Added to each variance of a mixture, as a share of the points' own mean variance.
RIDGE = 1e-6


def draw(number: int) -> Column:
    """A number between 0 and 1 for each patient and draw, from a hash."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{number}:"), F.col("patient_id"))), 1, DRAW_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16 ** DRAW_DIGITS)


def array_sql(values) -> str:
    """An array literal."""
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def distance_sql(centre) -> str:
    """Squared distance of ``x`` to a centre."""
    return f"aggregate(zip_with(x, {array_sql(centre)}, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v)"


def nearest_sql(centres) -> str:
    """``struct(d, i)`` of the nearest centre; ties go to the lowest index."""
    each = ", ".join(f"named_struct('d', {distance_sql(c)}, 'i', {i})" for i, c in enumerate(centres))
    return f"array_min(array({each}))"


def _at(rows) -> list[list[float]]:
    return [[float(v) for v in r.x] for r in rows]


def start_centres(points: DataFrame, k: int = K, rounds: int = START_ROUNDS, factor: int = START_FACTOR) -> list[list[float]]:
    """Oversampled start: candidates drawn by squared distance, then ``k`` of them by weight and distance.

    The first candidate is the patient of the least draw. Each round takes the ``factor * k`` points with the least
    ``-log(draw) / distance**2`` to the candidates so far: a weighted draw without replacement, by one bounded top-k.
    A candidate weighs the points nearest to it. The heaviest is the first centre; then the one with the largest
    weight times squared distance to the centres chosen, ties to the earlier candidate. Fewer than ``k`` distinct points
    give fewer centres.
    """
    first = points.orderBy(draw(0), "patient_id").limit(1).collect()
    candidates = _at(first)
    for r in range(1, rounds + 1):
        if not candidates:
            break
        away = points.withColumn("d", F.expr(f"{nearest_sql(candidates)}.d")).where("d > 0")
        more = away.orderBy(-F.log(draw(r)) / F.col("d"), "patient_id").limit(factor * k).collect()  # bounded
        candidates += _at(more)
    if not candidates:
        return []
    weight = np.zeros(len(candidates))
    for row in points.groupBy(F.expr(f"{nearest_sql(candidates)}.i").alias("i")).count().collect():  # a row a candidate
        weight[row["i"]] = row["count"]
    at = np.array(candidates, float).reshape(len(candidates), -1)
    chosen = [int(weight.argmax())]
    while len(chosen) < k:
        away = ((at[:, None, :] - at[chosen][None, :, :]) ** 2).sum(axis=2).min(axis=1) * weight
        if not away.max() > 0:
            break
        chosen.append(int(away.argmax()))
    return [candidates[i] for i in chosen]


def summed(points: DataFrame, sums) -> np.ndarray:
    """``sums(x, known)``, an array of numbers for a matrix of points and where it is not null, added over all points."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).flatten()
                x = values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                part = sums(x, values.is_valid().to_numpy(zero_copy_only=False).reshape(x.shape))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    each = points.select("x").mapInArrow(run, "total array<double>").select(F.posexplode("total").alias("place", "v"))
    return np.array([r[1] for r in sorted(each.groupBy("place").agg(F.sum("v")).collect())])  # a row a number


def lloyd_step(points: DataFrame, centres: list[list[float]]) -> list[list[float]]:
    """The means of the points nearest to each centre; a centre without points stays. Null coordinates are left out."""
    at = np.array(centres, float)

    def sums(x, known):
        away = np.zeros((len(x), len(at)))
        for j in range(at.shape[1]):  # coordinate by coordinate, as in SQL, so equal distances stay equal
            away += (x[:, j, None] - at[None, :, j]) ** 2
        near = away.argmin(axis=1)  # the lowest of ties
        filled = np.where(known, x, 0.0)
        return np.array([(filled[near == i].sum(axis=0), known[near == i].sum(axis=0)) for i in range(len(at))]).ravel()

    total = summed(points, sums).reshape(-1, 2, at.shape[1])
    return [[float(v) for v in row / n] if n.any() else c for (row, n), c in zip(total, centres)] or centres


def kmeans(points: DataFrame, k: int = K, max_iter: int = MAX_ITER, tol: float = KMEANS_TOL,
           start: list[list[float]] | None = None) -> list[list[float]]:
    """L4: centres after Lloyd steps, until none moves by more than ``tol`` or ``max_iter`` steps are done."""
    centres = start_centres(points, k) if start is None else start
    for _ in range(max_iter if centres else 0):
        new = lloyd_step(points, centres)
        done = max(np.linalg.norm(np.subtract(a, b)) for a, b in zip(new, centres, strict=True)) <= tol
        centres = new
        if done:
            break
    return centres


def assign(points: DataFrame, centres: list[list[float]]) -> DataFrame:
    """``(patient_id, cluster)`` by the nearest centre, ties to the lowest."""
    return points.select("patient_id", F.expr(f"{nearest_sql(centres)}.i").alias("cluster"))


@dataclass
class Mixture:
    """Weights, means and covariances of a Gaussian mixture."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -np.inf

    def log_density(self, i: int) -> list[float]:
        """Log of the weighted density of part ``i`` as coefficients of a point's products (:data:`PRODUCTS`)."""
        factor = np.linalg.cholesky(self.covariances[i])
        inverse, dim, mean = np.linalg.inv(factor), len(factor), self.means[i]
        precision = inverse.T @ inverse
        const = np.log(max(self.weights[i], 1e-300)) - np.log(np.diag(factor)).sum() - dim / 2 * np.log(2 * np.pi)
        cross = [-precision[r, c] / (2 if r == c else 1) for r in range(dim) for c in range(r + 1)]
        return [const - mean @ precision @ mean / 2, *(precision @ mean), *cross]


#: 1, the coordinates x_i, and the products x_i x_j with j up to i.
PRODUCTS = "concat(array(1D), x, flatten(transform(x, (a, i) -> transform(slice(x, 1, i + 1), b -> a * b))))"


def mixture_start(points: DataFrame, means: list[list[float]]) -> Mixture:
    """Equal weights, the given means, and the points' own variances as every covariance."""
    row = points.agg(*[F.var_pop(F.col("x")[j]) for j in range(len(means[0]))]).first()
    variance = np.array([v or 0.0 for v in row])
    variance = variance + RIDGE * max(variance.mean(), 1e-12)
    return Mixture(np.full(len(means), 1 / len(means)), np.array(means, float), np.array([np.diag(variance)] * len(means)))


def responsibilities(points: DataFrame, model: Mixture) -> DataFrame:
    """``(..., products, log_density, share)``: per part, by log-sum-exp, so that far points do not underflow."""
    dot = "aggregate(zip_with(products, {}, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    parts = ", ".join(dot.format(array_sql(model.log_density(i))) for i in range(len(model.weights)))
    out = points.selectExpr("*", f"{PRODUCTS} AS products").selectExpr("*", f"array({parts}) AS part")
    out = out.selectExpr("*", "array_max(part) AS top").selectExpr(
        "*", "aggregate(part, 0D, (s, v) -> s + exp(v - top)) AS total")
    return out.selectExpr(*points.columns, "products", "top + ln(total) AS log_density",
                          "transform(part, v -> exp(v - top) / total) AS share")


def mixture_step(points: DataFrame, model: Mixture, ridge: float) -> Mixture:
    """One EM step: weighted counts, sums and cross products of each part, and the log-likelihood."""
    k, dim = len(model.weights), model.means.shape[1]
    lower = np.tril_indices(dim)
    density = np.array([model.log_density(i) for i in range(k)])

    def sums(x, known):
        count, x = len(x), x[known.all(axis=1)]  # a point with a null counts but has no part
        products = np.concatenate([np.ones((len(x), 1)), x, x[:, lower[0]] * x[:, lower[1]]], axis=1)  # as PRODUCTS
        part = products @ density.T
        top = part.max(axis=1, keepdims=True)
        share = np.exp(part - top)
        whole = share.sum(axis=1, keepdims=True)
        return np.concatenate([(products.T @ (share / whole)).ravel(), [(top + np.log(whole)).sum(), count]])

    found = summed(points, sums)
    total, (log_likelihood, n) = found[:-2].reshape(-1, k), found[-2:]
    weights, means, covariances = total[0] / n, model.means.copy(), model.covariances.copy()
    for part in np.flatnonzero(weights > 1e-12):  # of the others nothing is left
        mean, cross = total[1:dim + 1, part] / total[0, part], np.zeros((dim, dim))
        cross[lower] = total[dim + 1:, part] / total[0, part]
        cross = cross + np.tril(cross, -1).T
        means[part], covariances[part] = mean, cross - np.outer(mean, mean) + ridge * np.eye(dim)
    return Mixture(weights, means, covariances, float(log_likelihood))


def gaussian_mixture(points: DataFrame, k: int = K, max_iter: int = MAX_ITER, tol: float = MIXTURE_TOL,
                     means: list[list[float]] | None = None) -> Mixture | None:
    """EM from :func:`start_centres` (or ``means``) until the log-likelihood gains no more than ``tol``."""
    means = start_centres(points, k) if means is None else means
    if not means:
        return None
    model = mixture_start(points, means)
    ridge = RIDGE * max(float(np.trace(model.covariances[0])) / len(means[0]), 1e-12)
    for _ in range(max_iter):
        new = mixture_step(points, model, ridge)
        done = abs(new.log_likelihood - model.log_likelihood) <= tol
        model = new
        if done:
            break
    return model


def mixture_assign(points: DataFrame, model: Mixture) -> DataFrame:
    """``(patient_id, cluster)`` by the largest share, ties to the lowest part."""
    share = responsibilities(points, model)
    return share.select("patient_id", (F.expr("array_position(share, array_max(share))") - 1).cast("int").alias("cluster"))
