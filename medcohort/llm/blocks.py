"""All pairs within groups of rows, in bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import join_hot

#: Rows of one side of a block of pairs; a larger group is cut into blocks that are paired with each other.
BLOCK = 512


def in_blocks(rows: DataFrame, group: str, payload: DataFrame) -> DataFrame:
    """Rows of groups as a stream sorted by ``key`` and ``node``, one key for each pair of blocks of each group of two or more.

    ``rows`` is a stored narrow table (``group``, node), ``payload`` has one row a node. A group of up to ``BLOCK`` rows
    is one block. A larger one is dealt by node over blocks, and each row goes to every pair of blocks that has its
    own; only then does it get its payload. No hot group meets in one task: its size is broadcast (:func:`join_hot`).
    ``side`` says which of the two blocks, ``whole`` that both are the same.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = join_hot(rows.select(group, "node"), sizes, group, "size", rows.count())
    dealt = dealt.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("key", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")))
    dealt = dealt.withColumn("whole", F.col("own") == F.col("other")).withColumn("side", F.col("own") <= F.col("other"))
    dealt = dealt.drop("size", "blocks", "own", "other").join(payload, "node")
    return dealt.repartition("key").sortWithinPartitions("key", "node")


def groups(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[pa.Table]:
    """The runs of equal keys of a stream that is sorted by ``key``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        keys = table.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def sides(table: pa.Table) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether both sides are the same block, and the row numbers of either."""
    whole = table.column("whole")[0].as_py()
    side = table.column("side").to_numpy()
    return whole, np.flatnonzero(side), np.flatnonzero(side if whole else ~side)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index reachable from each of ``n`` by the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
