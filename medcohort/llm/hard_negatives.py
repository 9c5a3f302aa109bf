"""Hard negatives: the best other-label rows within a share of each positive's score, by disjoint score slots."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medcohort.llm.common import map_arrow, materialise, read_table

#: Rows that one cell scores against one block of anchors, and anchors of a block at most (fewer for long vectors).
ROWS, ANCHORS, ANCHOR_BYTES = 1 << 14, 1 << 12, 1 << 24
#: Scores of one vectorised step, and partitions that the cells are dealt over at most.
STEP_SCORES, MAX_TASKS = 1 << 22, 20_000
_LIMIT = np.iinfo(np.int64).max
FOUND = "anchor long, slot int, score long, vec_id long"


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; those beyond 64 bits take the nearest 64-bit value but the least."""
    a_top, b_top = (float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (a, b))
    if a_top * b_top * max(1, a.shape[1]) < 2**53:  # every partial sum is an exact double
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -_LIMIT, _LIMIT).astype(np.int64)


class Best:
    """The first ``k`` rows of each anchor and slot met so far: a combiner of bounded size."""

    def __init__(self, k: int):
        self.k = k
        self.owner = self.score = self.order = np.zeros(0, np.int64)
        self.vec_id = np.zeros(0, object)

    def add(self, scores: np.ndarray, wanted: np.ndarray, order: np.ndarray, vec_id: np.ndarray) -> None:
        """``scores[i, j]`` of anchor i and row j where ``wanted``; ties go by ``order``."""
        full = np.flatnonzero(np.bincount(self.owner, minlength=len(scores)) >= self.k)
        least = np.full(len(scores), -_LIMIT - 1)
        if len(full):
            worst = np.full(len(scores), _LIMIT)
            np.minimum.at(worst, self.owner, self.score)
            least[full] = worst[full]
        better = wanted & (scores >= least[:, None])
        if better.sum() > 4 * self.k * len(scores) and scores.shape[1] > self.k:
            shown = np.where(better, scores, -_LIMIT - 1)
            better &= shown >= np.partition(shown, -self.k, axis=1)[:, -self.k, None]
        i, j = np.nonzero(better)
        owner, score = np.concatenate([self.owner, i]), np.concatenate([self.score, scores[i, j]])
        place, ids = np.concatenate([self.order, order[j]]), np.concatenate([self.vec_id, vec_id[j]])
        by = np.lexsort((place, -score, owner))
        begin = np.searchsorted(owner[by], owner[by])
        by = by[np.arange(len(by)) - begin < self.k]
        self.owner, self.score, self.order, self.vec_id = owner[by], score[by], place[by], ids[by]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _best_rows(k: int, positives: bool):
    """Best rows of every anchor and slot of a cell. A cell's anchors come first, then its rows as a stream.

    For ``positives`` a row counts if it has the anchor's label and is not the anchor itself, all in slot 0. Else it
    counts if it has another label; slot s holds the scores over limit s + 1 up to limit s.
    """
    def run(batches):
        cell, anchors, best = None, [], {}

        def flush():
            if anchors and best:
                row = np.concatenate([a["row"] for a in anchors])
                for slot, b in best.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[b.owner]), pa.array(np.full(len(b.owner), slot, np.int32)), pa.array(b.score),
                         pa.array(b.vec_id.tolist(), pa.int64())], ["anchor", "slot", "score", "vec_id"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            mark = np.stack([table.column("cell").to_numpy(), table.column("side").to_numpy()])
            cuts = [0, *(np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1), table.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if mark[0, a] != cell:
                    yield from flush()
                    cell, anchors, best = mark[0, a], [], {}
                part = table.slice(a, b - a).combine_chunks()
                held = {"row": part.column("row").to_numpy(), "label": part.column("label").to_numpy(),
                        "v": _matrix(part.column("v").combine_chunks())}
                if mark[1, a] == 0:
                    limits = part.column("limits").to_pylist()
                    held["limits"] = [x or [] for x in limits]
                    held["floor"] = part.column("floor").to_numpy(zero_copy_only=False)
                    anchors.append(held)
                elif anchors:
                    ids = np.array(part.column("vec_id").to_pylist(), object)
                    order = part.column("vec_id").fill_null(_LIMIT).to_numpy()
                    _meet(anchors, held, ids, order, best, k, positives)
        yield from flush()

    return run


def _meet(anchors: list, rows: dict, ids, order, best: dict, k: int, positives: bool) -> None:
    own = np.concatenate([a["row"] for a in anchors])
    label = np.concatenate([a["label"] for a in anchors])
    v = np.concatenate([a["v"] for a in anchors])
    limits = [x for a in anchors for x in a["limits"]]
    slots = 1 if positives else max(map(len, limits))
    top = np.full((len(own), slots + 1), -_LIMIT - 1)
    for at, x in enumerate(limits):
        top[at, :len(x)] = x[:slots]
    floor = np.concatenate([a["floor"] for a in anchors])
    step = max(1, STEP_SCORES // len(own))
    for a in range(0, len(order), step):
        scores = exact_scores(v, rows["v"][a:a + step])
        same = label[:, None] == rows["label"][None, a:a + step]
        for slot in range(slots):
            if positives:
                wanted = same & (own[:, None] != rows["row"][None, a:a + step])
            else:
                wanted = ~same & (scores <= top[:, slot, None]) & (scores > top[:, slot + 1, None]) & (scores >= floor[:, None])
            best.setdefault(slot, Best(k)).add(scores, wanted, order[a:a + step], ids[a:a + step])


def _cells(rows: DataFrame, anchors: DataFrame, n: int, n_anchors: int, size: int) -> DataFrame:
    """Every block of anchors beside every part of the rows of its vector length: a grid of cells.

    Both are dealt by a hash of the row number, so no label or id makes a cell large. A row goes to each block of
    anchors, an anchor to each part.
    """
    parts = max(1, math.ceil(n / ROWS))
    blocks = max(1, math.ceil(n_anchors / max(1, min(ANCHORS, ANCHOR_BYTES // (8 * max(1, size))))))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    dealt = (anchors.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)))
             .withColumn("part", every(parts)).withColumn("side", F.lit(0)))
    others = (rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))).withColumn("block", every(blocks))
              .withColumn("side", F.lit(1)).withColumn("limits", F.lit(None).cast("array<long>"))
              .withColumn("floor", F.lit(0).cast("long")))
    both = dealt.unionByName(others).withColumn(
        "cell", (F.size("v").cast("long") * parts + F.col("part")) * blocks + F.col("block"))
    both = both.select("cell", "side", "row", "vec_id", "label", "v", "limits", "floor")
    return both.repartition(min(parts * blocks, MAX_TASKS), "cell").sortWithinPartitions("cell", "side")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot; each map task sends ``k`` at most."""
    by = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100) -> DataFrame:
    """Negatives of each anchor and positive: the first other-label rows scoring ``low`` to ``high`` percent of it.

    ``vectors`` has vec_id, an integer label and an array embedding; ``is_anchor`` is a condition on vec_id and label.
    Components x become floor(256 x), the score is the integer inner product, higher first, ties by smaller vec_id
    (null ids last). An anchor's positives are its first other rows of the same label. Their upper limits, each once
    and falling, split the scores into disjoint slots; a cell of the anchor × row grid keeps the first ``negatives``
    rows of each slot, so do the map tasks, and a window from any upper limit down is the suffix of the merged slots,
    cut at its lower limit. Both searches are exact: every anchor meets every row.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; a pair without a
    negative has no row. Rows with a null label or vector, or a null or non-finite component, take no part; empty
    vectors do (score 0). Only vectors of one length are compared. Every repeated row is a row of its own, as anchor
    too. Scaled components and scores beyond 64 bits take the nearest 64-bit value. Other columns are not read.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)))
    rows = vectors.where(F.col("label").isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = materialise(rows, "vec-scaled")
    n, n_anchors, size = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("v"))).first()
    anchors, rows = rows.where("anchor").drop("anchor"), rows.drop("anchor")
    none = anchors.withColumn("limits", F.lit(None).cast("array<long>")).withColumn("floor", F.lit(0).cast("long"))
    found = _first(map_arrow(_cells(rows, none, n, n_anchors, size or 0), _best_rows(positives, True), FOUND), positives)

    percent = lambda p: F.col("score").cast("decimal(20,0)") * F.lit(p).cast("decimal(10,0)") / F.lit(100)
    chosen = found.select("anchor", F.struct(
        F.col("vec_id").alias("id"), "score", F.ceil(percent(low)).cast("long").alias("floor"),
        F.floor(percent(high)).cast("long").alias("limit")).alias("positive")).where("positive.floor <= positive.limit")
    chosen = chosen.groupBy("anchor").agg(F.collect_list("positive").alias("positives"))  # at most `positives` a row
    chosen = chosen.withColumn("limits", F.sort_array(F.array_distinct("positives.limit"), asc=False))
    chosen = materialise(chosen.withColumn("floor", F.array_min("positives.floor"))
                         .join(anchors.withColumnRenamed("row", "anchor"), "anchor"), "vec-positives")
    asked = chosen.select(F.col("anchor").alias("row"), "vec_id", "label", "v", "limits", "floor")
    slots = _first(map_arrow(_cells(rows, asked, n, n_anchors, size or 0), _best_rows(negatives, False), FOUND), negatives)
    # at most limits x negatives of an anchor, best first: the slots from one on are a suffix
    merged = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("down"), F.col("vec_id").isNull().alias("last"), "vec_id", "slot"))).alias("merged"))
    pairs = chosen.select("anchor", F.col("vec_id").alias("anchor_id"), "limits", F.explode("positives").alias("p")).join(
        merged, "anchor")
    start = (F.array_position("limits", F.col("p.limit")) - 1).alias("start")
    pairs = pairs.select("anchor_id", "p", "merged", start)
    best = F.slice(F.filter("merged", lambda m: m["slot"] >= F.col("start")), 1, negatives)
    best = F.filter(best, lambda m: -m["down"] >= F.col("p.floor"))
    return pairs.select("anchor_id", "p", F.posexplode(best).alias("place", "m")).select(
        "anchor_id", F.col("p.id").alias("positive_id"), (F.col("place") + 1).cast("int").alias("rank"),
        F.col("m.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        (-F.col("m.down")).alias("negative_score"))


def op11_hard_negatives(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive_id ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM positives p JOIN scores s ON p.anchor = s.anchor AND NOT s.same
   AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""
