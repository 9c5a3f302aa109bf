"""Sharding along a Hilbert curve over quantised metadata, cut into runs of equal row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from medcohort.llm.common import join_counted, materialise, read_table

SHARDS = 24
#: Bits of each quantised dimension: the curve has 2 ** (3 * BITS) cells.
BITS = 4
#: The rows of a cell are dealt over 2 ** SLICE_BITS slices by text hash, and each slice over as many parts by
#: the hash of the id, so that neither a cell nor a group of equal texts is one task.
SLICE_BITS = 4


def hilbert_cells(spark: SparkSession, bits: int = BITS) -> DataFrame:
    """Every cell ``(x, y, z)`` of the cube with its index along the Hilbert curve: 2 ** (3 * bits) rows.

    The index is computed bit plane by bit plane (undo the excess rotations, then Gray-decode) with SQL
    expressions over the bounded table of cells, never per data row.
    """
    side = 1 << bits
    cells = spark.range(side ** 3).select(
        "id", (F.col("id") % side).alias("x"), (F.col("id") / side).cast("long").alias("y"),
        F.lit(0).cast("long").alias("z"))
    cells = cells.withColumn("z", (F.col("y") / side).cast("long")).withColumn("y", F.col("y") % side)
    state = F.array("x", "y", "z")

    def turn(a: Column, axis: int, q: Column) -> Column:
        low = q - F.lit(1)
        own, first = a[axis], a[0]
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(q) != 0
        new = [F.when(flip, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))]
        new += [a[k] if k != axis else F.when(flip, own).otherwise(own.bitwiseXOR(swap)) for k in (1, 2)]
        return F.array(*new)

    def partial_turn(axis: int, q: Column):
        return lambda v: turn(v, axis, q)

    planes = F.array(*(F.lit(1 << k).cast("long") for k in range(bits - 1, 0, -1)))

    def step(a: Column, q: Column) -> Column:
        # a lambda for each axis keeps the intermediate array a bound value instead of a copied expression
        for axis in range(3):
            a = F.element_at(F.transform(F.array(a), partial_turn(axis, q)), 1)
        return a

    state = F.aggregate(planes, state, step)
    cells = cells.withColumn("t", state)
    cells = cells.select("x", "y", "z", F.col("t")[0].alias("a"),
                         F.col("t")[1].bitwiseXOR(F.col("t")[0]).alias("b"), F.col("t")[2].alias("c"))
    cells = cells.withColumn("c", F.col("c").bitwiseXOR(F.col("b")))
    fold = F.aggregate(planes, F.lit(0).cast("long"),
                       lambda t, q: F.when(F.col("c").bitwiseAND(q) != 0, t.bitwiseXOR(q - F.lit(1))).otherwise(t))
    cells = cells.withColumn("f", fold)
    index = F.lit(0).cast("long")
    for k in range(bits - 1, -1, -1):
        for axis in "abc":
            bit = F.shiftright(F.col(axis).bitwiseXOR(F.col("f")), k).bitwiseAND(F.lit(1).cast("long"))
            index = index * 2 + bit
    return cells.select("x", "y", "z", index.alias("curve"))


def ranked_cells(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """``(column, n, cell)`` of every value: its cell is where the middle of its rows lies when rows are sorted by it.

    Cells are ranges of values that hold about equal shares of the rows, whatever the values' distribution. Counts of
    values are dealt over ranges; the prefix sums are exact, so the ranges, which Spark samples, do not show.
    """
    dealt = rows.groupBy(column).agg(F.count("*").alias("n")).repartitionByRange(column)
    dealt = materialise(dealt.withColumn("range", F.spark_partition_id()), "shard-values")
    upto = Window.orderBy("range")  # one row a range
    bases = dealt.groupBy("range").agg(F.sum("n").alias("rows")).select(
        "range", (F.sum("rows").over(upto) - F.col("rows")).alias("base"), F.sum("rows").over(
            Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    inside = Window.partitionBy("range").orderBy(column)
    placed = dealt.withColumn("before", F.sum("n").over(inside) - F.col("n")).join(F.broadcast(bases), "range")
    middle = (F.col("base") + F.col("before")) * 2 + F.col("n")
    return placed.select(column, "n", F.floor(middle * (1 << bits) / (F.col("total") * 2)).cast("long").alias("cell"))


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Deal documents over ``shards`` shards whose row counts differ by at most one (law ``rows``).

    Dimensions: language, source and the text's bytes, each quantised by rank (:func:`ranked_cells`), so a cell is a
    range of values and a shard's least and greatest value of each dimension prune it. Rows are ordered by the curve
    index, then by leading bits of the text's hash and of the id's hash, and cut into runs, so a shard spans few values
    of each dimension and equal texts of one language and source lie near each other. A row's place is the rows in
    earlier cells, plus those in earlier parts of its cell, plus its rank in its part: no task gets a whole cell or a
    whole group of equal texts.

    A null text has no bytes and crc 0 of the empty text; null metadata is a value of its own, before all others.
    Repeated rows (all of id, text, metadata equal) get one place each. Other columns are not read. An empty table
    gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = materialise(docs.select(
        F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"), named("lang").alias("lang"), named("source").alias("source")), "shard-narrow")
    n = rows.count()
    for column, axis in (("lang", "x"), ("source", "y"), ("size", "z")):
        values = materialise(ranked_cells(rows, column, bits), "shard-cells").withColumnRenamed("cell", axis)
        rows = join_counted(rows, values, column, "n", n).drop("n")
    rows = rows.drop("lang", "source")
    cells = hilbert_cells(docs.sparkSession, bits)  # at most 2 ** (3 * bits) rows
    rows = materialise(
        rows.join(F.broadcast(cells), ["x", "y", "z"]).drop("x", "y", "z")
        .withColumn("slice", F.shiftrightunsigned("text_hash", 64 - SLICE_BITS))
        .withColumn("part", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - SLICE_BITS)), "shard-rows")

    run = ["curve", "slice", "part"]
    counts = rows.groupBy(*run).agg(F.count("*").alias("n"))
    per_cell = counts.groupBy("curve").agg(F.sum("n").alias("n"))
    # at most 2 ** (3 * bits) rows in this window, at most 4 ** SLICE_BITS in a cell of the next
    before = per_cell.select("curve", (F.sum("n").over(Window.orderBy("curve")) - F.col("n")).alias("cell_base"))
    inside = Window.partitionBy("curve").orderBy("slice", "part")
    base = (counts.withColumn("run_base", F.sum("n").over(inside) - F.col("n"))
            .join(before, "curve").select(*run, (F.col("cell_base") + F.col("run_base")).alias("base")))
    total = per_cell.agg(F.sum("n").alias("total")).scalar()

    order = Window.partitionBy(*run).orderBy("text_hash", "doc_id")
    placed = (rows.withColumn("rank", F.row_number().over(order) - 1)
              .join(base, run)
              .withColumn("total", total)
              .withColumn("place", F.col("base") + F.col("rank"))
              .withColumn("shard", F.expr(f"place * {shards} div total")))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("curve").alias("curve_index"))


def op8_sharding(spark, sf_dir):
    return shard(read_table(spark, sf_dir, "documents"))
