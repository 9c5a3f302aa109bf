"""Line deduplication by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from medcohort.llm.common import fresh, if_small, materialise, read_table

#: Lines of fewer words only match exactly; the edit bound of one word holds for lines of this many or more.
MIN_WORDS = 8


def _without(words: Column, k: Column) -> Column:
    """``words`` without the ``k``-th; all of them for k = 0."""
    return F.when(k == 0, words).otherwise(
        F.concat(F.slice(words, F.lit(1), k - 1), F.slice(words, k + 1, F.size(words))))


def _near_lines(distinct: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """Keys (h1, h2) of the distinct lines that have an earlier line at one word's edit distance.

    Both lines of such a pair share their first or their last ``min_words // 2`` words, for one edit cannot touch
    both. So only lines whose head or tail some other line has too need a neighbourhood; no pair is lost.
    """
    able = distinct.where(F.col("n") >= min_words)
    shared = None
    for end in ("head", "tail"):
        again = able.groupBy(end).agg(F.count("*").alias("lines")).where("lines > 1").select(end)
        again = if_small(materialise(again, "line-ends"))
        part = able.join(again, end, "left_semi").select("h1", "h2", "n", "at")
        shared = part if shared is None else shared.unionByName(part)
    shared = materialise(shared.distinct(), "line-able")

    wanted = materialise(shared.select("at.doc_id", "at.text_hash", "at.line", "h1", "h2", "n", "at"), "line-places")
    here = if_small(wanted)
    lines = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"),
                        F.posexplode(F.split("text", "\n")).alias("line", "words"))
    # one row per distinct line with its words; repeated documents give the same row again
    lines = (lines.join(here, F.col("d").eqNullSafe(here["doc_id"]) & (F.col("t") == here["text_hash"])
                        & (lines["line"] == here["line"]))
             .select("h1", "h2", "n", "at", F.split("words", " ").alias("words")))
    lines = materialise(lines.dropDuplicates(["h1", "h2"]), "line-words")

    # The hash of a word sequence is the xor of its words' hashes with their places, so the hash of a line without
    # its k-th word is the xor of the earlier words in place and of the later ones moved up by one.
    words = (lines.repartition("h1", "h2")
             .select("h1", "h2", "n", "at", F.posexplode("words").alias("p", "word"))
             .select("h1", "h2", "n", "at", (F.col("p") + 1).alias("k"),
                     F.xxhash64("word", F.col("p") + 1).alias("own"), F.xxhash64("word", "p").alias("moved")))
    so_far = Window.partitionBy("h1", "h2").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("h1", "h2")
    variants = words.select(
        "h1", "h2", "at", "k", "n",
        F.expr("bit_xor(own)").over(so_far).bitwiseXOR(F.col("own"))
        .bitwiseXOR(F.expr("bit_xor(moved)").over(so_far)).bitwiseXOR(F.expr("bit_xor(moved)").over(whole)).alias("rest"),
        F.expr("bit_xor(own)").over(whole).alias("full"))
    variants = materialise(variants, "line-variants")

    # most variants are alone with their hash: only the others go on with their lines
    full = variants.where("k = 1").select("h1", "h2", "at", F.lit(0).alias("k"), "n", F.col("full").alias("rest"))
    keyed = variants.drop("full").unionByName(full)
    met = keyed.groupBy("rest").agg(F.count("*").alias("lines")).where("lines > 1").select("rest")
    live = materialise(keyed.join(if_small(materialise(met, "line-met")), "rest", "left_semi"), "line-live")

    # one word replaced: the same rest, length and place; the earliest line of each key stands for all before it
    same, whole_lines = ["rest", "n", "k"], live.where("k = 0")
    live = live.where("k > 0")
    first = live.groupBy(*same).agg(F.min(F.struct("at", "h1", "h2")).alias("e"), F.count("*").alias("lines"))
    replaced = (live.join(first.where("lines > 1"), same).where(F.col("at") > F.col("e.at"))
                .select("h1", "h2", F.col("k").alias("k1"), F.col("e.h1").alias("g1"), F.col("e.h2").alias("g2"),
                        F.col("k").alias("k2")))
    # one word more: the rest of the longer line is the shorter line, of which there is one
    shorter = whole_lines.select("rest", (F.col("n") + 1).alias("n"), F.col("h1").alias("s1"),
                                 F.col("h2").alias("s2"), F.col("at").alias("s_at"))
    longer = live.join(shorter, ["rest", "n"])
    after = F.col("at") > F.col("s_at")
    longer = longer.select(
        *(F.when(after, F.col(a)).otherwise(F.col(b)).alias(name) for name, a, b in
          (("h1", "h1", "s1"), ("h2", "h2", "s2"), ("g1", "s1", "h1"), ("g2", "s2", "h2"))),
        F.when(after, F.col("k")).otherwise(0).alias("k1"), F.when(after, 0).otherwise(F.col("k")).alias("k2"))
    pairs = replaced.unionByName(longer)

    # verify on the words themselves
    mine = lines.select("h1", "h2", F.col("words").alias("w1"))
    theirs = lines.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("words").alias("w2"))
    checked = pairs.join(mine, ["h1", "h2"]).join(theirs, ["g1", "g2"])
    return checked.where(_without(F.col("w1"), F.col("k1")) == _without(F.col("w2"), F.col("k2"))) \
        .select("h1", "h2").distinct()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Remove every line that has an earlier equal or nearly equal one anywhere in the table.

    Lines are the pieces between line feeds, words the pieces between single blanks. Lines order by document
    (doc_id, nulls first, then a hash of the text) and place. A line goes if an earlier line equals it or, both
    having ``min_words`` words or more, differs from it by one word replaced, added or left out. Lines of blanks
    only always stay. All lines are compared as they are in the input, also with lines that go themselves.

    Returns all columns of ``docs``, ``text`` without its removed lines (null stays null, and a text may become
    empty), and ``n_lines`` (lines but blank ones) and ``n_removed``, prefixed by underscores where ``docs`` has
    such names. Rows that agree in doc_id and text are one document: each keeps the same lines.
    """
    n_lines, n_removed, hidden, bits = fresh(docs, "n_lines", "n_removed", "_hash", "_bits")
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(F.split("text", "\n")).alias("line", "words")).where(F.trim("words") != "")
    keyed = lines.select(
        F.xxhash64("words").alias("h1"), F.xxhash64(F.lit("second"), F.col("words")).alias("h2"),
        F.xxhash64(F.substring_index("words", " ", min_words // 2)).alias("head"),
        F.xxhash64(F.substring_index("words", " ", -(min_words // 2))).alias("tail"),
        (F.octet_length("words") - F.octet_length(F.replace("words", F.lit(" "), F.lit(""))) + 1).alias("n"),
        F.struct("doc_id", "text_hash", "line").alias("at"))
    distinct = materialise(keyed.groupBy("h1", "h2", "head", "tail", "n").agg(F.min("at").alias("at")), "line-distinct")
    near = _near_lines(distinct, docs, min_words)
    stay = (distinct.join(near, ["h1", "h2"], "left_anti").groupBy("at.doc_id", "at.text_hash")
            .agg(F.sort_array(F.collect_list("at.line")).alias("stay")))
    # a byte for each line up to the last that stays: 1 where it stays
    stay = stay.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.array_join(F.transform(
        "stay", lambda x, k: F.concat(F.repeat(
            F.lit("0"), x - F.when(k == 0, -1).otherwise(F.get("stay", k - 1)) - 1), F.lit("1"))), "")
        .cast("binary").alias(bits))
    stay = if_small(materialise(stay, "line-stay"))
    joined = docs.withColumn(hidden, F.xxhash64("text")).join(
        stay, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col(hidden) == F.col("_t")), "left")
    split = F.split("text", "\n")
    kept = F.filter(split, lambda x, k: (F.trim(x) == "") | F.coalesce(
        F.substring(F.col(bits), k + 1, F.lit(1)) == F.lit("1").cast("binary"), F.lit(False)))
    count = F.size(F.filter(split, lambda x: F.trim(x) != ""))
    out = joined.withColumn(n_lines, F.when(F.col("text").isNull(), 0).otherwise(count).cast("long"))
    out = out.withColumn(n_removed, F.when(F.col("text").isNull(), 0).otherwise(
        F.size(split) - F.size(kept)).cast("long"))
    columns = [F.array_join(kept, "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return out.select(*columns, n_lines, n_removed)


def op4_line_dedup(spark, sf_dir):
    return dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
firsts AS (
  SELECT line, min(struct_pack(d := doc_id, p := place)) AS spot, string_split(line, ' ') AS w
  FROM lines WHERE trim(line, ' ') <> '' GROUP BY line),
able AS (SELECT * FROM firsts WHERE len(w) >= 8),
variants AS (
  SELECT line, spot, len(w) AS n, k, array_to_string(list_concat(w[1:k-1], w[k+1:]), ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM able)),
near AS (
  SELECT a.line FROM variants a JOIN variants b ON a.rest = b.rest AND a.n = b.n AND a.k = b.k AND a.spot > b.spot
  UNION SELECT a.line FROM variants a JOIN able b ON a.rest = b.line AND a.spot > b.spot
  UNION SELECT b.line FROM variants a JOIN able b ON a.rest = b.line AND b.spot > a.spot),
marked AS (
  SELECT l.doc_id, l.place, l.line, trim(l.line, ' ') = '' AS blank,
         f.spot = struct_pack(d := l.doc_id, p := l.place) AND l.line NOT IN (SELECT line FROM near) AS stays
  FROM lines l LEFT JOIN firsts f USING (line))
SELECT doc_id, count(*) FILTER (NOT blank) AS n_lines, count(*) FILTER (NOT blank AND NOT stays) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (blank OR stays), '')) AS text_sha256
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
