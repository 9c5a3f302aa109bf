"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.llm.blocks import groups, in_blocks, roots, sides
from medcohort.llm.common import join_hot, map_arrow, materialise, read_table
from medcohort.llm.components import components

THRESHOLD = 0.93
#: Hash tables of up to two parts, twice as many for each further part, which makes a bucket harder to share; each vector
#: also goes to its next-best buckets: a table has PROBES of them besides the best.
TABLES, PROBES = 8, 2
#: Vectors of the largest label that a bucket should hold; sets how many polytopes a table's hash joins.
BUCKET = 64


@cache
def _signs(width: int, table: int, part: int) -> np.ndarray:
    return np.random.default_rng([width, table, part]).choice([-1.0, 1.0], (3, width))


def rotate(x: np.ndarray, table: int, part: int) -> np.ndarray:
    """Three rounds of random signs and a fast Hadamard transform; the width is a power of two."""
    n, width = x.shape
    for sign in _signs(width, table, part):
        x = x * sign
        half = 1
        while half < width:
            pair = x.reshape(n, width // (2 * half), 2, half)
            x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, width)
            half *= 2
    return x


def buckets(x: np.ndarray, parts: int) -> np.ndarray:
    """Bucket numbers of unit vectors: for each table the best, then ``PROBES`` next ones (rows x all).

    A part's vertex is the axis of largest magnitude with its sign; a bucket joins the vertices of ``parts``
    rotations. The next buckets replace one part's vertex by its second best, and with one part its third.
    """
    n, size = x.shape
    width = 1 << max(1, (size - 1).bit_length())
    x = np.concatenate([x, np.zeros((n, width - size))], 1)
    out = []
    for table in range(TABLES << max(0, parts - 2)):
        top = []  # (rows, 3) vertices of each part, best first
        for part in range(parts):
            y = rotate(x, table, part)
            best = np.argsort(-np.abs(y), 1, kind="stable")[:, :3]
            best = np.concatenate([best, best[:, -1:]], 1)[:, :3]
            top.append(best * 2 + (np.take_along_axis(y, best, 1) < 0))
        picks = [[0] * parts]
        picks += [[1 if k == p % parts else 0 for k in range(parts)] if p < parts else
                  [2 if k == p % parts else 0 for k in range(parts)] for p in range(max(PROBES, parts))]
        for pick in picks:
            number = np.full(n, table, np.int64)
            for part, which in enumerate(pick):
                number = number * (2 * width) + top[part][:, which]
            out.append(number)
    return np.stack(out, 1)


def _vector_rows(batches):
    """Nodes of usable vectors: a digest of label and components. Others have none."""
    for batch in batches:
        label, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        nodes, data = [], []
        for own, v in zip(label, vectors, strict=True):
            x = np.array([math.nan if c is None else c for c in v], np.float64) if own is not None and v else np.zeros(1)
            length = np.linalg.norm(x / m) * m if np.isfinite(x).all() and (m := np.abs(x).max()) else 0.0
            usable = math.isfinite(length) and length > 0
            nodes.append(hashlib.blake2b(f"{own}|".encode() + x.tobytes(), digest_size=16).digest() if usable else None)
            data.append((x / length).tobytes() if usable else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(data, pa.binary())],
            ["vec_id", "label", "node", "unit"])


def _units(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(table.num_rows, -1)


def _links(batches):
    for table in groups(batches):
        whole, left, right = sides(table)
        x = _units(table)
        near = x[left] @ x[right].T >= THRESHOLD
        if whole:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if len(i):
            yield table, left[i], right[j]


def _edge_rows(batches):
    for table, i, j in _links(batches):
        root = roots(table.num_rows, i, j)
        moved = np.flatnonzero(root != np.arange(len(root)))
        node = table.column("node").combine_chunks()
        yield pa.RecordBatch.from_arrays([node.take(pa.array(moved)), node.take(pa.array(root[moved]))], ["a", "b"])


def _count_rows(batches):
    for table, i, j in _links(batches):
        n, copies = table.num_rows, table.column("copies").to_numpy()
        links = (np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)).astype(np.int64)
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [table.column("node").combine_chunks().take(pa.array(some)), pa.array(links[some])], ["node", "links"])


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Link vectors of one label with a cosine of 0.93 or more, in double precision.

    Equal vectors of a label are hashed once and count with their copies. Vectors that share a bucket (their best or
    a next-best one) in any table are compared in blocks; links found there give components, and all pairs within a
    component are compared in blocks for the counts. The parts of a hash grow with the logarithm of the largest label,
    so buckets keep their size. No group is held whole in a task and no list of pairs is made.

    Returns (vec_id, n_links, component_id, kept), one row per input row. Vectors that are null, empty, zero or hold
    null or non-finite components, and those without a label, link with nothing. Only vectors of one length are
    compared. Rows repeated in full are copies, linked with each other. Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"),
                          F.col("embedding").cast("array<double>"))
    signed = materialise(map_arrow(rows, _vector_rows, "vec_id long, label string, node binary, unit binary"), "vec-signed")
    nodes = materialise(signed.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("unit").alias("unit")), "vec-nodes")
    largest = nodes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    size = nodes.agg(F.max(F.octet_length("unit"))).first()[0] or 8
    parts = max(1, round(math.log(max(1, largest / BUCKET)) / math.log(size / 4)))

    def hashed(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            length = np.array([len(u) for u in table.column("unit").to_pylist()])
            for own in np.unique(length):
                part = table.filter(pa.array(length == own))
                number = buckets(_units(part), parts)
                at = np.repeat(np.arange(part.num_rows), number.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).combine_chunks().take(pa.array(at)) for c in ("label", "node")),
                     pa.array(np.full(len(at), own)), pa.array(number.ravel())], ["label", "node", "size", "number"])

    spread = map_arrow(nodes.select("label", "node", "unit"), hashed,
                       "label string, node binary, size long, number long")
    spread = materialise(spread.select("node", F.xxhash64("label", "size", "number").alias("bucket")), "vec-buckets")
    edges = map_arrow(in_blocks(spread, "bucket", nodes.select("node", "unit")), _edge_rows, "a binary, b binary")
    found = materialise(components(edges).join(nodes, "node"), "vec-found")
    counted = map_arrow(in_blocks(found, "component", found.select("node", "unit", "copies")), _count_rows,
                        "node binary, links long").groupBy("node").agg(F.sum("links").alias("links"))
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.select("node", "component").join(least, "component").join(counted, "node", "left")
    every = materialise(nodes.select("node", "least", "copies").join(found, "node", "left"), "vec-every")
    one = F.coalesce("component_id", "least", "vec_id")
    return join_hot(signed.select("vec_id", "node"), every, "node", "copies", signed.count(), "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        one.alias("component_id"), F.col("vec_id").eqNullSafe(one).alias("kept"))


def op6_embedding_near_dedup(spark, sf_dir):
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
