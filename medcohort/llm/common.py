"""Shared helpers: table reads, scratch tables in the shared folder, vectorised word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medcohort.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step works on (a longer text is a step of its own).
STEP_BYTES = 1 << 20
_MASK = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage and makes later stages independent of the executors
    that computed it. The folder goes when the driver's file system closes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``), for functions run in Python."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="code-")  # the driver serves the file from here until it ends
    archive = os.path.join(folder.name, f"{package.name}-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped[app] = folder


def give_back() -> None:
    """Return a Python worker's free memory to the system: workers are kept, and the next stage runs beside them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors; a worker gives its free memory back at the end."""
    ship_code(df.sparkSession)

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash (ignoring case) with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def sha256_hex(column: Column) -> Column:
    return F.sha2(F.coalesce(column, F.lit("")), 256)


# --- vectorised text ---------------------------------------------------------------------


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text is a range of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(size):
        base = size[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(size, base + limit, "right")))
        yield begin, stop
        begin = stop


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n + n // 8
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]).cumprod(dtype=np.uint64)
                for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_CHARS, _WORDS = Powers(0x9E3779B97F4A7C15), (Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F))


def rolling(values: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _WORDS[family].to(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[: n - width + 1])


def spans(values: np.ndarray, begin: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of the values, and their number, of every span ``begin:end``."""
    n = len(values)
    up, down = _WORDS[family].to(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of every run of ``width`` values, by doubling."""
    have = 1
    while have * 2 <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return best(values[: len(values) - rest], values[rest:]) if rest else values


#: Word separators: ASCII white space; or every ASCII character but letters and digits.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(texts: Sequence[str | None], separators: np.ndarray, lower: bool = False):
    """Words of some texts: ``(bytes, starts, ends, first)``; text ``k`` has words ``first[k]:first[k + 1]``."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    if lower:
        raw = LOWER[raw]
    gap = separators[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    begins = np.cumsum([1, *(len(p) + 1 for p in parts)])
    return raw, starts, ends, np.searchsorted(starts, begins)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes and length."""
    n = len(raw)
    up, down = _CHARS.to(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Bytes of a stored table's values up to which it may be broadcast.
BROADCAST_BYTES = 32 << 20


def value_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: 8 for a number, the length of a text and the elements of an array, and 16 for either."""
    total = F.lit(8)
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + 16 + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind == "array":
            total = total + 16 + 8 * F.coalesce(F.size(field.name), F.lit(0))
        else:
            total = total + 8
    return total


def if_small(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcasting if the sum of its values' bytes proves it small.

    Beyond the bound the same join runs as a shuffled one.
    """
    size = stored.agg(F.sum(value_bytes(stored).cast("long"))).first()[0] or 0
    return F.broadcast(stored) if size <= limit else stored


#: A key with more than this part of all rows is hot; there are fewer hot keys than this, at any size.
HOT_PART = 1024


def join_hot(rows: DataFrame, table: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each ``key`` and in ``size`` how many of ``rows`` have it.

    ``total`` is the number of ``rows``, at least. Keys with over 1 / ``HOT_PART`` of it are fewer than ``HOT_PART``, so
    their rows of ``table`` are broadcast and the rows of a hot key stay where they are; all other keys are shuffled.
    With ``how`` "left", rows without a key stay in place too.
    """
    bound = max(1, total // HOT_PART)
    hot = F.broadcast(table.where(F.col(size) > bound))
    met = rows.join(hot, key)
    others = rows.join(F.broadcast(table.where(F.col(size) > bound).select(key)), key, "left_anti")
    out = met.unionByName(others.where(F.col(key).isNotNull()).join(table.where(F.col(size) <= bound), key, how))
    if how == "left":
        out = out.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)
    return out


def join_counted(rows: DataFrame, stored: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with a stored table of one row a key: broadcast if proven small, else by :func:`join_hot`."""
    near = if_small(stored)
    return rows.join(near, key) if near is not stored else join_hot(rows, stored, key, size, total)
