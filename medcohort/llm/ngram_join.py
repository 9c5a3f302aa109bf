"""N-gram Jaccard join with Bayesian candidate pruning."""

from __future__ import annotations

import hashlib
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.llm.blocks import groups, in_blocks, roots, sides
from medcohort.llm.common import (NON_ALNUM, fresh, if_small, join_hot, map_arrow, materialise, mix, read_table, rolling,
                                  steps, word_hashes, words)
from medcohort.llm.components import components

WORDS, THRESHOLD = 5, 0.8
#: MinHash values of 16 bits each, BANDS bands of ROWS values. A pair at the threshold shares no band with a
#: probability of (1 - 0.8 ** 4) ** 32, that is 5e-8.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: MinHash values compared at a time; a pair is dropped once the posterior probability (uniform prior) that its
#: similarity reaches the threshold is below TOLERANCE.
STEP, TOLERANCE = 16, 1e-6
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the runs of five words of each text, in order (fewer words: one run of all; none: empty)."""
    raw, starts, ends, first = words(texts, NON_ALNUM, lower=True)
    each = word_hashes(raw, starts, ends)
    runs = rolling(each, WORDS)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            out.append(runs[a: b - WORDS + 1])
        else:
            out.append(rolling(each[a:b], b - a) + np.uint64(b - a) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash of each non-empty set: one row of ``HASHES`` 16-bit values."""
    begin = np.cumsum([0, *map(len, sets[:-1])])
    every = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), np.uint16)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat(every * factor, begin) >> np.uint64(20)
    return out


def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 16, 32, ... values compared: the fewest matches with which a pair goes on."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m), for a uniform prior
        tail = np.cumsum([comb(n + 1, j) * threshold ** j * (1 - threshold) ** (n + 1 - j) for j in range(n + 1)])
        out.append(int(np.searchsorted(tail, tolerance)))
    return out


def surviving(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of ``left`` and ``right``; i < j if they are the ``same`` block) that are not pruned."""
    i, j = np.triu_indices(len(left), 1) if same else (x.ravel() for x in np.indices((len(left), len(right))))
    match = np.zeros(len(i), np.int64)
    for k, least in enumerate(least_matches()):
        part = slice(k * STEP, (k + 1) * STEP)
        match += (left[i, part] == right[j, part]).sum(1)
        stay = match >= least
        i, j, match = i[stay], j[stay], match[stay]
    return i, j


def _matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)


def _survivor_edges(batches):
    """A spanning star of the surviving pairs of each block pair."""
    for table in groups(batches):
        whole, left, right = sides(table)
        marks = _matrix(table)
        i, j = surviving(marks[left], marks[right], whole)
        if len(i):
            root = roots(table.num_rows, left[i], right[j])
            linked = np.flatnonzero(root != np.arange(len(root)))
            node = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays([node.take(pa.array(linked)), node.take(pa.array(root[linked]))], ["a", "b"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets of distinct hashes, exact."""
    every = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(left), len(right)), np.float64)
    edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        dense = np.zeros((len(left) + len(right), width), np.float32)
        dense[row[a:b], column[a:b] - k * width] = 1
        total += dense[: len(left)] @ dense[len(left):].T
    return total


def _verified_links(batches):
    """For each document of a block pair that has links there: how many, and the least document reached."""
    for table in groups(batches):
        whole, left, right = sides(table)
        marks = _matrix(table)
        i, j = surviving(marks[left], marks[right], whole)
        if not len(i):
            continue
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        a, b = np.unique(i), np.unique(j)
        both = overlaps([sets[left[k]] for k in a], [sets[right[k]] for k in b])
        size = np.array([len(s) for s in sets], np.float64)
        i, j, shared = left[i], right[j], both[np.searchsorted(a, i), np.searchsorted(b, j)]
        linked = shared >= THRESHOLD * (size[i] + size[j] - shared) - 1e-9
        i, j = i[linked], j[linked]
        copies = table.column("copies").to_numpy()
        n = table.num_rows
        texts = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
        rows = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        root, node, some = roots(n, i, j), table.column("node").combine_chunks(), np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays(
            [node.take(pa.array(some)), node.take(pa.array(root[some])), pa.array(texts[some].astype(np.int64)),
             pa.array(rows[some].astype(np.int64))], ["node", "root", "texts", "rows"])


def _signature_rows(batches):
    for batch in batches:
        ids, text = batch.column(0), batch.column(1)
        for a, b in steps(text):
            texts = text.slice(a, b - a).to_pylist()
            sets = shingles(texts)
            some = [k for k, s in enumerate(sets) if len(s)]
            marks = dict(zip(some, signatures([sets[k] for k in some]), strict=True)) if some else {}
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array([None if t is None else digest(t) for t in texts], pa.binary()),
                 pa.array([marks[k].tobytes() if k in marks else None for k in range(len(texts))], pa.binary()),
                 batch.column(2).slice(a, b - a)], ["doc_id", "node", "signature", "text_hash"])


def _band_rows(batches):
    for batch in batches:
        marks = _matrix(pa.Table.from_batches([batch]))
        value = np.ascontiguousarray(marks).view(np.uint64)  # four 16-bit values are one band's key
        keys = mix(value + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
        node = batch.column(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), node.take(pa.array(np.repeat(np.arange(len(node)), BANDS)))], ["band", "node"])


def near_classes(docs: DataFrame) -> DataFrame:
    """Join the documents on the Jaccard similarity of their sets of five-word shingles, at 0.8 or more.

    Words are A-Z lower-cased runs of other characters than ASCII non-alphanumerics. Equal texts are one class,
    joined once. Candidates share a band of MinHash values; their values are compared 16 at a time and a pair is
    dropped when its posterior probability falls below ``TOLERANCE``; survivors are verified on their whole sets.
    Buckets and groups of any size are done in blocks, and give counts and spanning links, never lists of pairs.

    Returns (doc_id, class_id, n_copies, n_links, n_text_links, component_id, kept), one row per input row.
    class_id: least doc_id with the same text; n_copies: rows with it; n_text_links: other texts linked; n_links:
    other rows linked, copies included; component_id: least doc_id reachable by links and copies; kept: the row is
    that document. A null text equals nothing; texts without words link with equal texts only; rows repeated in
    full are copies of each other and share their ``kept``.
    """
    return _classes(docs).drop("text_hash")


def _classes(docs: DataFrame) -> DataFrame:
    """The rows of ``near_classes`` with the hash of their text: an id may stand for several texts."""
    text_rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "text_hash", F.xxhash64("text"))
    signed = materialise(map_arrow(text_rows, _signature_rows, "doc_id long, node binary, signature binary, "
                                                               "text_hash long"), "near-signed")
    classes = materialise(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.first("signature").alias("signature"),
        F.first("text_hash").alias("text_hash")), "near-classes")
    with_words = classes.where("signature is not null").select("node", "signature")
    bands = map_arrow(with_words, _band_rows, "band long, node binary")
    again = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    shared = materialise(bands.join(again, "band", "left_semi"), "near-shared")
    marked = in_blocks(shared, "band", with_words)
    maybe = components(map_arrow(marked, _survivor_edges, "a binary, b binary"))
    maybe = materialise(maybe.join(classes.select("node", "class_id", "copies", "signature", "text_hash"), "node"), "near-maybe")

    def sets(batches):
        for batch in batches:
            text, node = batch.column(0), batch.column(1)
            for a, b in steps(text):
                texts = text.slice(a, b - a).to_pylist()
                own = [digest(t) == n for t, n in zip(texts, node.slice(a, b - a).to_pylist(), strict=True)]
                found = [np.unique(s).tobytes() for s in shingles(texts)]
                keep = [k for k, mine in enumerate(own) if mine]  # an id may stand for other texts too
                yield pa.RecordBatch.from_arrays(
                    [node.slice(a, b - a).take(pa.array(keep, pa.int64())), pa.array([found[k] for k in keep], pa.binary())],
                    ["node", "shingles"])

    places = if_small(materialise(maybe.select("class_id", F.col("text_hash").alias("hash"), "node"), "near-places"))
    here = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("hash"))
    found = map_arrow(text_rows.where("text is not null").join(places, here).select("text", "node"), sets,
                      "node binary, shingles binary").dropDuplicates(["node"])
    checked = in_blocks(maybe, "component", maybe.drop("component", "class_id", "text_hash").join(found, "node"))
    links = materialise(map_arrow(checked, _verified_links, "node binary, root binary, texts long, rows long"), "near-links")
    linked = links.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("rows"))
    parts = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    parts = parts.join(linked, "node").join(classes.select("node", "class_id"), "node")
    least = parts.groupBy("component").agg(F.min("class_id").alias("component_id"))
    parts = parts.join(least, "component").select("node", "texts", "rows", "component_id")
    every = materialise(classes.select("node", "class_id", "copies").join(parts, "node", "left"), "near-every")
    one = F.coalesce("component_id", "class_id", "doc_id")
    rows = signed.select("doc_id", "node", "text_hash")
    return join_hot(rows, every, "node", "copies", signed.count(), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("rows", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"), one.alias("component_id"),
        F.col("doc_id").eqNullSafe(one).alias("kept"), "text_hash")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the least of its component; rows without an id stay."""
    gone = _classes(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    gone = if_small(materialise(gone, "near-gone"))
    key, hidden = fresh(docs, "_key", "_hash")
    marked = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(hidden, F.xxhash64(F.col("text").cast("string")))
    same = (marked[key] == gone["_d"]) & (marked[hidden] == gone["_t"])
    return marked.join(gone, same, "left_anti").drop(key, hidden)


def op10_ngram_jaccard_join(spark, sf_dir):
    return near_classes(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
class AS (SELECT text, min(doc_id) AS class_id, count(*) AS n_copies, any_value(w) AS w FROM w GROUP BY text),
s AS (
  SELECT DISTINCT class_id, array_to_string(w[k:k + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT class_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS k FROM class WHERE len(w) > 0)),
n AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
link AS (
  SELECT a.class_id AS a, b.class_id AS b
  FROM s a JOIN s b ON a.s = b.s AND a.class_id <> b.class_id
  GROUP BY a.class_id, b.class_id
  HAVING count(*) >= 0.8 * ((SELECT n FROM n WHERE class_id = a.class_id) + (SELECT n FROM n WHERE class_id = b.class_id) - count(*))),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS class_id, least(a, min(b)) AS component_id FROM reach GROUP BY a),
cnt AS (SELECT a AS class_id, count(*) AS texts, sum(n_copies) AS n FROM link JOIN class ON link.b = class.class_id GROUP BY a)
SELECT doc_id, class_id, n_copies, n_copies - 1 + CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_links,
       coalesce(texts, 0) AS n_text_links, coalesce(component_id, class_id) AS component_id,
       doc_id = coalesce(component_id, class_id) AS kept
FROM w JOIN class USING (text) LEFT JOIN comp USING (class_id) LEFT JOIN cnt USING (class_id)
UNION ALL SELECT doc_id, doc_id, 1, 0, 0, doc_id, true FROM documents WHERE text IS NULL
"""
