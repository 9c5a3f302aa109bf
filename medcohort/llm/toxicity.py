"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medcohort.llm.common import if_small, map_arrow, materialise, read_table, steps

#: Lengths of the character n-grams, in code points of the lower-cased text; presence counts, not frequency.
GRAMS = (4, 5)
#: n-grams are hashed into 2 ** BITS weights.
BITS = 20
#: The regression sees at most this many labelled ids of each class, those with the smallest hash of their id; the
#: log-count ratios come from all labelled texts.
MAX_ROWS_PER_CLASS = 2500
#: Bytes of known n-gram numbers of one class's sample that go to the driver at most: four times 2 ** BITS numbers.
MAX_BYTES_PER_CLASS = 16 << BITS
THRESHOLD = 0.3
#: Smoothing of the counts; least log-count ratio of a bucket that gets a weight; ridge; rounds of the fit. Held out on
#: sf0.1 (990 labelled rows, 120 toxic): ratios over 0.5 catch 98 with 7 false alarms, over 0 93 with 3, all of them 88
#: with 2: what points to clean text adds up with a text's length and hides a toxic passage in a long one.
ALPHA, LEAST_RATIO, L2, ROUNDS = 1.0, 0.5, 1e-3, 300
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every n-gram occurrence; a blank is put before and after the text."""
    code = np.frombuffer(f" {(text or '').lower()} ".replace("\n", " ").encode("utf-32-le", "surrogatepass"),
                         np.uint32).astype(np.uint64)
    out, total = [], None
    for k in range(min(GRAMS[-1], len(code))):
        part = code[k:] * _MULTIPLIERS[k]
        total = part if total is None else total[: len(part)] + part
        if k + 1 in GRAMS:
            out.append(total >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


class Presence:
    """Distinct buckets of a text without sorting: a bucket counts where it was written last."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int64)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        place = np.arange(len(found))
        self.last[found] = place
        return found[self.last[found] == place]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None, presence: Presence) -> float:
        found = buckets(text)
        found = found[self.weights[found] != 0]
        z = self.bias + float(self.weights[presence(found)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[np.ndarray], toxic: np.ndarray, share: float, known: np.ndarray, ratio: np.ndarray) -> Model:
    """Fit on the known n-grams of some texts; ``share`` is the share of toxic rows among all labelled ones.

    ``known`` are the buckets that get a weight, ``ratio`` their log-count ratios; a row lists the numbers of those it
    has. A ridge logistic regression on ratio * presence is fitted by accelerated gradient steps, half of a class's
    weight being its share and half being one half. Known buckets that are in none of ``rows`` get the mean weight of
    the others, times their ratio. With one class only, the score is that share everywhere.
    """
    weights = np.zeros(1 << BITS, np.float32)
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    n, ones, width = len(toxic), int(toxic.sum()), len(known)
    if not 0 < ones < n:
        return Model(weights, bias)
    column, row = np.concatenate(rows), np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    each = np.where(toxic == 1, (share + 0.5) / 2 / ones, (1.5 - share) / 2 / (n - ones))

    def over_rows(x):
        return np.bincount(row, (ratio * x)[column], n)

    def over_columns(x):
        return ratio * np.bincount(column, x[row], width)

    spread, steep = np.ones(width), 0.0  # the largest eigenvalue bounds the curvature
    for _ in range(15):
        spread = over_columns(each * over_rows(spread))
        steep = float(np.linalg.norm(spread)) or 1.0
        spread /= steep
    step = 1 / (0.25 * (steep + 1) + L2)
    w = ahead = np.zeros(width)
    b = b_ahead = 0.0
    for k in range(ROUNDS):
        g = each * (_sigmoid(b_ahead + over_rows(ahead)) - toxic)
        w_new = ahead - step * (over_columns(g) + L2 * ahead)
        b_new = b_ahead - step * g.sum()
        push = k / (k + 3)
        ahead, b_ahead = w_new + push * (w_new - w), b_new + push * (b_new - b)
        w, b = w_new, b_new
    met = np.bincount(column, minlength=width) > 0
    weights[known] = np.where(met, w, w[met].mean() if met.any() else 0.0) * ratio
    return Model(weights, float(b))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def log_count_ratios(summed: DataFrame, least_ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of two texts or more with a log-count ratio over ``least_ratio``, ascending, and the ratios.

    ``summed`` has, for each bucket, the labelled texts of either class with it; bucket -1 has all of them. The ratio is
    log of a bucket's smoothed share of the toxic texts over its share of the others.
    """
    total = summed.where("bucket = -1").first() or {"clean": 0, "toxic": 0}
    share = lambda k: F.log((F.col(k) + ALPHA) / (total[k] + 2 * ALPHA))
    known = summed.where("bucket >= 0 AND clean + toxic > 1").select("bucket", (share("toxic") - share("clean")).alias("ratio"))
    known = known.where(F.col("ratio") > least_ratio).toArrow()  # fewer than 2 ** BITS rows of 12 bytes
    known = known.take(pa.compute.sort_indices(known, [("bucket", "ascending")]))
    return known.column(0).to_numpy(), known.column(1).to_numpy()


def train(docs: DataFrame, labels: DataFrame, max_rows_per_class: int = MAX_ROWS_PER_CLASS,
          least_ratio: float = LEAST_RATIO) -> Model:
    """Fit from the labelled documents that are not held out.

    Buckets are counted over all their rows, at most one row a bucket for each partition in the shuffle. Of at most
    ``max_rows_per_class`` ids of each class one text (the least hash) goes to the driver, as the numbers of its known
    buckets (those with a log-count ratio over ``least_ratio``); in the order of the ids' hashes no more rows of a
    class than fit in ``MAX_BYTES_PER_CLASS``, which holds several texts that have every bucket. A document labelled
    twice counts as toxic if any label says so; null labels, null ids and null texts' labels are ignored.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = materialise(known, "toxic-labels")
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # 2 rows
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == k).orderBy(*order).limit(max_rows_per_class) for k in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])  # at most twice max_rows_per_class ids

    def count(batches):
        presence, counts, texts = Presence(), np.zeros((2, 1 << BITS), np.int64), [0, 0]
        for batch in batches:
            text, toxic = batch.column(1), batch.column(2).to_pylist()
            for a, b in steps(text):
                for t, k in zip(text.slice(a, b - a).to_pylist(), toxic[a:b], strict=True):
                    counts[k, presence(buckets(t))] += 1
                    texts[k] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(  # bucket -1: the texts
            [pa.array(np.append(at, -1).astype(np.int32)), *(pa.array(np.append(counts[k, at], texts[k])) for k in (0, 1))],
            ["bucket", "clean", "toxic"])

    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text"))
    summed = materialise(map_arrow(texts.join(if_small(known), "doc_id"), count, "bucket int, clean long, toxic long")
                         .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-counts")
    bucket, ratio = log_count_ratios(summed, least_ratio)
    marks = np.zeros(1 << BITS, bool)
    marks[bucket] = True
    packed = np.packbits(marks).tobytes()  # 128 KiB go to the executors

    def run(batches):
        mark = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        number, presence = np.cumsum(mark, dtype=np.int32) - 1, Presence()
        for batch in batches:
            text, found = batch.column(1), []
            for a, b in steps(text):
                for t in text.slice(a, b - a).to_pylist():
                    met = buckets(t)
                    found.append(number[presence(met[mark[met]])].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3),
                                              pa.array(found, pa.binary())], ["doc_id", "toxic", "hash", "found"])

    rows = texts.join(F.broadcast(sample), "doc_id").withColumn("hash", F.xxhash64("text"))
    got = map_arrow(rows, run, "doc_id long, toxic int, hash long, found binary")
    got = got.groupBy("doc_id", "toxic").agg(F.min_by("found", "hash").alias("found"))
    so_far = F.sum(F.octet_length("found")).over(Window.partitionBy("toxic").orderBy(*order))
    got = got.withColumn("so_far", so_far).where(F.col("so_far") <= MAX_BYTES_PER_CLASS).drop("so_far").toArrow()
    got = got.take(pa.compute.sort_indices(got, [("doc_id", "ascending")]))
    return fit([np.frombuffer(x, np.int32) for x in got.column(2).to_pylist()],
               got.column(1).to_numpy(zero_copy_only=False).astype(np.int64), share, bucket, ratio)


def score(docs: DataFrame, model: Model, keep_columns: bool = False) -> DataFrame:
    """Score every whole text between 0 and 1; higher is likelier toxic. A null or empty text scores as blank.

    Returns doc_id, held_out, score, predicted; one row per input row, repeated rows included. With
    ``keep_columns`` the input's columns are returned and only rows below the threshold stay.
    """
    def marks(texts: pa.Array) -> list[float]:
        presence = Presence()
        return [model.score(t, presence) for a, b in steps(texts) for t in texts.slice(a, b - a).to_pylist()]

    if keep_columns:
        place = docs.columns.index("text")

        def run(batches):
            for batch in batches:
                clean = [s < THRESHOLD for s in marks(batch.column(place))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return map_arrow(docs, run, docs.schema)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(marks(batch.column(2)), pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text"))
    scored = map_arrow(rows, run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the classifier scores below the threshold."""
    return score(docs, train(labelled_docs, labels), keep_columns=True)


def op1_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
