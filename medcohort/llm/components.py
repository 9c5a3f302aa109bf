"""Connected components of an edge table: large stars as joins, small stars within tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.llm.blocks import roots
from medcohort.llm.common import map_arrow, materialise

#: Edges that are added to a task's stars at once.
HELD_EDGES = 1 << 20


def _stars(table: pa.Table) -> pa.Table:
    """Every node of some edges but the least of its component, with that least node."""
    coded = pa.concat_arrays([table.column(c).combine_chunks() for c in ("a", "b")]).dictionary_encode()
    nodes = coded.dictionary.take(order := pc.sort_indices(coded.dictionary))
    rank = np.empty(len(nodes), np.int64)
    rank[order.to_numpy()] = np.arange(len(nodes))
    at = rank[coded.indices.to_numpy()]
    root = roots(len(nodes), at[: table.num_rows], at[table.num_rows:])
    some = np.flatnonzero(root != np.arange(len(root)))
    return pa.table([nodes.take(pa.array(some)), nodes.take(pa.array(root[some]))], ["a", "b"])


def _star_rows(batches):
    """A spanning star of each component of a task's edges; the task holds a row a node, however many edges come."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
        if size > HELD_EDGES:
            held, size = [_stars(pa.concat_tables(held))], 0
    if held:
        yield from _stars(pa.concat_tables(held)).to_batches(1 << 16)


def _round(edges: DataFrame, up: DataFrame) -> DataFrame:
    """One large and one small star of the edges (a, b), a > b; ``up`` has the least ``b`` of each ``a``.

    Large star: whatever points to a node points to that node's least neighbour. Small star: a node and all it points
    to point to the least of them. Each task does that for its own edges first, after which a node starts at most one
    edge there, and then for all edges of its nodes. So a node's edges never meet as they are; a star's centre is a
    key of the left side of a join, which Spark splits where it is skewed.
    """
    up = up.select(F.col("a").alias("b"), F.col("b").alias("up"))
    large = edges.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"))
    return map_arrow(map_arrow(large, _star_rows, edges.schema).repartition("a"), _star_rows, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edge table ``(a, b)``; the component is its least node.

    Nodes may be of any ordered type. Each round is written out; neither edges nor labels reach the driver, which
    only compares a count and a checksum. A round never raises the least neighbour of a node. If it leaves all as they
    are, each is a least neighbour of itself, all edges of a node lead to the same one, and that is the component.
    """
    edges = materialise(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        up = materialise(edges.groupBy("a").agg(F.min("b").alias("b")), "up")
        mark = tuple(up.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == before:
            break
        before = mark
        edges = materialise(_round(edges, up), "edges")
    return up.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        up.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
