"""Quality: positive-unlabelled learning of a linear scorer by the non-negative risk, from one pass of moments."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import map_arrow, materialise, read_table, steps

#: Runs of three characters, each as its kind (lower, upper, digit, line end, other space, every other ASCII
#: character itself, other), are hashed into 2 ** BITS shares.
BITS = 8
#: Features are whole numbers from 0 to SCALE, so moments are exact sums and the model does not depend on the layout.
SCALE = 1 << 12
WIDTH = (1 << BITS) + 6
#: Trusted positives of the fit at most: those with the smallest hash of their id.
MAX_POSITIVES = 50_000
THRESHOLD, RIDGE, ROUNDS, SLOPE = 0.5, 1e-4, 100, 4.0
_LAST = 0x250
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _kind(code: int) -> int:
    c = chr(code)
    kinds = (c.islower(), c.isupper(), c.isdigit(), c == "\n", c.isspace())
    return kinds.index(True) if any(kinds) else 8 + code if code < 128 else 6


_KINDS = np.array([*map(_kind, range(_LAST)), 7], np.uint64)


def features(text: str | None) -> np.ndarray:
    """Whole-text features between 0 and 1: square roots of the shares of character-kind runs, length, share of
    distinct lines and words, mean lengths of words and lines, and a constant 1. A null text is an empty one."""
    text = text or ""
    code = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), _LAST)
    kind = _KINDS[code]
    out = np.zeros(WIDTH)
    if len(kind) > 2:
        run = (kind[:-2] * _MULTIPLIERS[0] + kind[1:-1] * _MULTIPLIERS[1] + kind[2:] * _MULTIPLIERS[2]) >> np.uint64(64 - BITS)
        out[: 1 << BITS] = np.sqrt(np.bincount(run.astype(np.int64), minlength=1 << BITS) / len(run))
    lines, words = [x for x in text.split("\n") if x.strip()], text.split()
    n_lines, n_words = max(1, len(lines)), max(1, len(words))
    out[1 << BITS:] = (min(1.0, np.log1p(len(text)) / 16), len(set(lines)) / n_lines, len(set(words)) / n_words,
                       min(1.0, len(text) / n_words / 32), min(1.0, n_words / n_lines / 64), 1.0)
    return out


def _scaled(texts: list) -> np.ndarray:
    return np.rint(np.stack([features(t) for t in texts]) * SCALE)


@dataclass
class Model:
    weights: np.ndarray
    prior: float

    def scores(self, texts: list) -> np.ndarray:
        z = (_scaled(texts) * self.weights).sum(axis=1) / SCALE
        return 1 / (1 + np.exp(-np.clip(SLOPE * z, -30, 30)))


def class_prior(unlabelled: np.ndarray, positive: np.ndarray) -> float:
    """The share of positives among the unlabelled whose density is nearest theirs (least Pearson divergence).

    With a density ratio linear in the features this is 1 / (m' A^-1 m), m the positives' mean and A the unlabelled
    second moments. At most 1.
    """
    mean = positive[-1]
    return float(min(1.0, 1 / max(1e-9, mean @ np.linalg.solve(unlabelled + RIDGE / 10 * np.eye(len(mean)), mean))))


def fit(unlabelled: np.ndarray, positive: np.ndarray) -> Model:
    """Minimise the non-negative risk of g(x) = w'x under the squared loss (1 - y g)^2 / 4, from second moments.

    risk = p E_pos[loss of +1] + max(0, E_unl[loss of -1] - p E_pos[loss of -1]) + ridge, p the estimated prior. The
    loss is quadratic, so both expectations over all texts are forms in the moments (the constant feature is the last).
    Steps are scaled by the curvature of the unclipped risk and halved until the risk falls.
    """
    prior, unit = class_prior(unlabelled, positive), np.eye(WIDTH)
    one = unit[-1]
    loss = lambda moments, v: v @ moments @ v / 4

    def risk(w):
        negative = loss(unlabelled, one + w) - prior * loss(positive, one + w)
        return prior * loss(positive, one - w) + max(0.0, negative) + RIDGE * w @ w, negative

    curvature = unlabelled / 2 + 2 * RIDGE * unit
    w = np.zeros(WIDTH)
    now, negative = risk(w)
    for _ in range(ROUNDS):
        slope = 2 * RIDGE * w - prior * positive @ (one - w) / 2
        if negative >= 0:
            slope = slope + (unlabelled - prior * positive) @ (one + w) / 2
        step, size = np.linalg.solve(curvature, slope), 1.0
        while size > 1e-6 and risk(w - size * step)[0] >= now:
            size /= 2
        if size <= 1e-6:
            break
        w = w - size * step
        now, negative = risk(w)
    return Model(w, prior)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES) -> Model:
    """Fit from trusted positives and all documents as unlabelled text, in one scan without a shuffle of texts.

    Trusted positives are ids whose labels, outside the held-out third, all say quality 1; at most ``max_positives``
    of them (least id hash) are used, all documents are the unlabelled text. The only rows that are shuffled are a
    partition's moments (``WIDTH`` (``WIDTH`` + 1) / 2 sums). Null texts, ids and labels are ignored; every repeated
    row counts. Without a positive text the weights are zero, so every score is one half.
    """
    trusted = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
               .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))
               .where("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives))
    trusted = F.broadcast(materialise(trusted.select("doc_id", F.lit(True).alias("trusted")), "trusted"))
    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text")).join(trusted, "doc_id", "left")
    upper = np.triu_indices(WIDTH)

    def moments(batches):
        total = np.zeros((2, WIDTH, WIDTH), np.int64)
        for batch in batches:
            text, chosen = batch.column(0), np.array(batch.column(1).fill_null(False))
            for a, b in steps(text):
                x = _scaled(text.slice(a, b - a).to_pylist())
                for k, some in enumerate((x, x[chosen[a:b]])):
                    total[k] += (some.T @ some).astype(np.int64)  # whole numbers under 2 ** 53: exact
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]), dtype=np.int32)), *(pa.array(t[upper]) for t in total)],
            ["place", "unlabelled", "positive"])

    summed = map_arrow(rows.select("text", "trusted"), moments, "place int, unlabelled long, positive long").groupBy(
        "place").agg(F.sum("unlabelled").alias("unlabelled"), F.sum("positive").alias("positive")).toArrow()  # one row a place
    both = np.zeros((2, WIDTH, WIDTH))
    for k in (0, 1):
        flat = np.zeros(len(upper[0]))
        flat[summed.column(0).to_numpy()] = summed.column(k + 1).to_numpy()
        both[k][upper] = flat
        both[k] += np.triu(both[k], 1).T
    if not both[1, -1, -1]:
        return Model(np.zeros(WIDTH), 0.0)
    return fit(*(m / m[-1, -1] for m in both))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score every whole text between 0 and 1; higher is likelier good. A null text scores as an empty one.

    Returns doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on); one row per input row, repeated rows
    included.
    """
    def run(batches):
        for batch in batches:
            text = batch.column(2)
            marks = [s for a, b in steps(text) for s in model.scores(text.slice(a, b - a).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text"))
    scored = map_arrow(rows, run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op12_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
