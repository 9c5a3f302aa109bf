"""Benchmark decontamination: prefix-filtered join of item-sized windows, verified word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import fresh, if_small, materialise, read_table, sha256_hex

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: Words of a shingle, the token that the join is on (shorter windows are their own shingle).
SHINGLE = 3
#: A document is contaminated if SHARE times its hit words reach its words.
SHARE = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """A-Z lower-cased, then all runs of other characters than ASCII non-alphanumerics; null has no words."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)  # there lower() changes A-Z alone
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _GAPS), "")


def count_words(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.size(F.array_remove(F.split(text, _GAPS_ANY_CASE), "")).cast("long")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, by place."""
    last = F.size(words) - size
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), last), lambda k: F.xxhash64(*(F.get(words, k + j) for j in range(size)))))


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, words, width): each distinct window of each item."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(window))
    return (items.withColumn("width", width)
            .select("item_id", "width", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("width") + 1)).alias("k"))
            .select("item_id", "width", F.array_join(F.slice("w", F.col("k"), F.col("width")), " ").alias("words"))
            .distinct())


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, starts, items): verified window occurrences of every document that has any.

    Shingles are ranked by how often they occur in the documents. A window occurs only where all its shingles do,
    so its rarest one is the necessary prefix: its occurrences, moved by its place in the window and bounded by
    the ends of the document, are the candidates, and each is compared word by word with the document.
    """
    windows = materialise(_windows(benchmark, window), "bench-windows")
    parts = F.split("words", " ")
    sizes = [r[0] for r in windows.select(F.least(F.col("width"), F.lit(SHINGLE))).distinct().collect()]  # 1 to 3
    key = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    hits = None
    for size in sizes:
        known = windows.where(F.least(F.col("width"), F.lit(SHINGLE)) == size).select(
            F.explode(_shingles(parts, size)).alias("shingle")).distinct()
        known = if_small(materialise(known, "bench-shingles"))
        found = key.select("doc_id", "text_hash", F.size("w").alias("n"),
                           F.posexplode(_shingles(F.col("w"), size)).alias("p", "shingle"))
        found = found.join(known, "shingle").withColumn("size", F.lit(size))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_hash long, starts array<struct<start:int,width:int>>, items array<string>")
    hits = materialise(hits.distinct(), "bench-hits")

    often = hits.groupBy("shingle", "size").agg(F.count("*").alias("often"))
    each = (windows.select("words", "width").distinct()
            .withColumn("size", F.least(F.col("width"), F.lit(SHINGLE))))
    each = each.select("words", "width", "size", F.posexplode(F.expr(
        "CASE " + " ".join(f"WHEN size = {s} THEN transform(sequence(0, width - {s}), k -> xxhash64("
                           + ", ".join(f"get(split(words, ' '), k + {j})" for j in range(s)) + "))" for s in (1, 2, 3))
        + " END")).alias("place", "shingle"))
    prefix = (each.join(often, ["shingle", "size"], "left").groupBy("words", "width", "size")
              .agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle", "place")).alias("least"))
              .where("least.often > 0")
              .select("words", "width", "size", F.col("least.shingle").alias("shingle"),
                      F.col("least.place").alias("place")))
    start = F.col("p") - F.col("place")
    maybe = (hits.join(prefix, ["shingle", "size"]).where((start >= 0) & (start + F.col("width") <= F.col("n")))
             .groupBy("doc_id", "text_hash")
             .agg(F.collect_set(F.struct(start.alias("start"), "width", "words")).alias("maybe")))
    maybe = materialise(maybe, "bench-maybe")

    few = if_small(maybe.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")))
    # the texts that have candidates, cut into words only after both joins
    some = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    some = some.join(few, some["doc_id"].eqNullSafe(few["d"]) & (some["text_hash"] == few["t"]), "left_semi")
    m = maybe.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "maybe")
    sure = (some.join(m, some["doc_id"].eqNullSafe(m["d"]) & (some["text_hash"] == m["t"]))
            .select("doc_id", "text_hash", "maybe", words_of(F.col("text")).alias("w"))
            .select("doc_id", "text_hash", F.filter("maybe", lambda c: F.array_join(
                F.slice("w", c["start"] + 1, c["width"]), " ") == c["words"]).alias("sure"))
            .where(F.size("sure") > 0).dropDuplicates(["doc_id", "text_hash"]))
    sure = materialise(sure, "bench-sure")
    items = (sure.select("doc_id", "text_hash", F.explode(F.array_distinct("sure.words")).alias("words"))
             .join(windows.select("item_id", "words"), "words")
             .groupBy("doc_id", "text_hash")
             .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    places = sure.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.array_distinct(F.transform(
        "sure", lambda c: F.struct(c["start"].alias("start"), c["width"].alias("width")))).alias("starts"))
    return items.join(places, items["doc_id"].eqNullSafe(places["d"]) & (items["text_hash"] == places["t"])) \
        .select("doc_id", "text_hash", "starts", "items")


def _covered(starts: Column) -> Column:
    """Words that lie in any of the intervals."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.sort_array(starts), empty, lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["width"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["width"] - F.greatest(a["end"], s["start"]))).alias("n")))["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of every document that lie in an occurrence of a window of a benchmark item.

    Returns doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated, one row per input row. A null
    text has no words; a null item or one without words has no window; null item ids are not counted. Equal items
    count each; rows that agree in doc_id and text get equal results. Other columns are not read.
    """
    hits = find_hits(docs, benchmark, window)
    found = hits.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), _covered(F.col("starts")).alias("hit"),
        F.size("items").cast("long").alias("items"), sha256_hex(F.array_join("items", ",")).alias("digest"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), count_words(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return rows.join(found, rows["doc_id"].eqNullSafe(found["d"]) & (rows["text_hash"] == found["t"]), "left").select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("digest", sha256_hex(F.lit(""))).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = contamination(docs, benchmark, window).where("contaminated").select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    bad = if_small(materialise(bad, "bench-bad"))
    (hidden,) = fresh(docs, "_hash")
    marked = docs.withColumn(hidden, F.xxhash64("text"))
    return marked.join(bad, marked["doc_id"].eqNullSafe(bad["_d"]) & (marked[hidden] == bad["_t"]),
                       "left_anti").drop(hidden)


def op5_benchmark_decontamination(spark, sf_dir):
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS width, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, width, k, array_to_string(w[k:k + width - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS k
        FROM d, (SELECT DISTINCT width FROM bw) WHERE len(w) >= width)),
hit AS (SELECT doc_id, k, dw.width, item_id FROM dw JOIN bw ON dw.words = bw.words AND dw.width = bw.width),
per_word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + width)) AS p FROM hit) GROUP BY doc_id),
per_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)
"""
