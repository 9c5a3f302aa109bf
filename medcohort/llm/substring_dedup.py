"""Substring deduplication: a count-min prefilter of window anchors, then grouping of likely repeats, runs before windows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import (SPACES, fresh, if_small, join_hot, map_arrow, materialise, read_table, rolling,
                                  ship_code, sliding, spans, steps, word_hashes, words)

#: Words of a window, and of the anchors that stand for it in the sketch.
WINDOW, GRAM = 35, 8
#: Rows of the count-min sketch, and cells of each row for every anchor of the corpus (at least).
DEPTH, CELLS_PER_ANCHOR = 2, 4
#: The repeated cells go to the tasks as two bit maps while a row has at most BITMAP_CELLS cells (8 MB a map) and
#: HOT_CELLS are repeated (64 MB through the driver), and are joined to the documents' anchors beyond.
BITMAP_CELLS, HOT_CELLS = 1 << 26, 1 << 23
_SPAN = WINDOW - GRAM + 1
#: Window rows of a partition that are held to find repeats within it.
HELD_WINDOWS = 4_000_000
#: Bytes of the tables of places (anchors, spans) up to which they are broadcast.
PLACES_BYTES = 96 << 20


def _windows(texts: list[str | None], second: bool = False):
    """(first word of each text, anchor of each window, window hashes, which starts are windows, 8-word hashes, words).

    A window's anchor is the least hash of its runs of eight words: equal windows have equal anchors, and
    neighbouring windows mostly share theirs.
    """
    raw, starts, ends, first = words(texts, SPACES)
    each = word_hashes(raw, starts, ends)
    grams = rolling(each, GRAM)
    if len(grams) < _SPAN:
        none = np.zeros(0, np.uint64)
        return first, none, (none, none), np.zeros(0, bool), none, each
    anchor = sliding(grams, _SPAN)
    text = np.searchsorted(first, np.arange(len(anchor)), "right") - 1
    inside = np.arange(len(anchor)) + WINDOW <= first[text + 1]
    pair = (rolling(each, WINDOW), rolling(each, WINDOW, 1) if second else None)
    return first, anchor, pair, inside, grams, each


def _anchor_rows(batches):
    """The anchors of each text, one for each place that is the anchor of some window."""
    for batch in batches:
        text = batch.column(2)
        for a, b in steps(text):
            first, anchor, _, inside, grams, _ = _windows(text.slice(a, b - a).to_pylist())
            pad = np.zeros(_SPAN - 1, np.uint64)
            around = np.concatenate([pad, np.where(inside, anchor, np.uint64(0)), pad])
            top = sliding(around, _SPAN, np.maximum) if len(anchor) else grams
            chosen = np.flatnonzero((top == grams[: len(top)]) & (top > 0))
            cuts = np.searchsorted(chosen, first).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(grams[chosen].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), lists], ["doc_id", "text_hash", "anchors"])


def cell(anchor: Column, row: int, cells: int) -> Column:
    """The sketch cell of an anchor in one row; rows interleave, so one number names row and cell."""
    return F.xxhash64(anchor, F.lit(row)).bitwiseAND(F.lit(cells - 1)) * DEPTH + row


def repeated_cells(anchors: DataFrame, cells: int) -> DataFrame:
    """Cells with a count of two or more in the count-min sketch of all anchors.

    Every task sums the cells of its own anchors (a sparse sketch of its partition); the shuffle merges the
    partition sketches by cell.
    """
    each = anchors.select(F.explode("anchors").alias("a"))
    hit = each.select(F.explode(F.array(*(cell(F.col("a"), r, cells) for r in range(DEPTH)))).alias("cell"))
    return hit.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")


def _bitmaps(hot: DataFrame, cells: int) -> np.ndarray:
    """Both rows of the merged sketch as one bit a cell; at most 2 * BITMAP_CELLS bits."""
    bits = np.zeros(cells * DEPTH // 8, np.uint8)
    for part in hot.toArrow().column("cell").chunks:
        at = part.to_numpy()
        np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    return bits


def _asked(first: np.ndarray, anchor: np.ndarray, inside: np.ndarray, hot: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The windows whose anchor is in their text's list, and the number of the text."""
    likely = inside.copy()
    for k, (lo, hi) in enumerate(zip(first[:-1], first[1:], strict=True)):
        own = np.asarray(hot[k].values.to_numpy() if hot[k].is_valid else [], np.int64).view(np.uint64)
        likely[lo:hi] &= np.isin(anchor[lo:hi], own)
    at = np.flatnonzero(likely)
    return at, np.searchsorted(first, at, "right") - 1


def _run_rows(batches):
    """Runs of neighbouring windows of one likely repeated anchor: two hashes of all their words, and their place.

    ``n`` is the number of windows; ``twice`` says that a window may be met again within its run.
    """
    for batch in batches:
        ids, hashes, text, hot = (batch.column(k) for k in range(4))
        for a, b in steps(text):
            first, anchor, (one, _), inside, _, each = _windows(text.slice(a, b - a).to_pylist())
            at, row = _asked(first, anchor, inside, hot.slice(a, b - a))
            if not len(at):
                continue
            new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row) != 0) | (anchor[at[1:]] != anchor[at[:-1]])])
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(at)))
            run, lo, row = np.cumsum(new) - 1, at[begin], row[begin]
            order = np.lexsort((one[at], run))
            again = (np.diff(run[order]) == 0) & (np.diff(one[at][order]) == 0)
            twice = np.zeros(len(lo), bool)
            twice[run[order][1:][again]] = True
            sums = [spans(each, lo, lo + n + WINDOW - 1, family).view(np.int64) for family in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[lo].view(np.int64)), *map(pa.array, sums), ids.slice(a, b - a).take(pa.array(row)),
                 hashes.slice(a, b - a).take(pa.array(row)), pa.array((lo - first[row]).astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(twice)],
                ["a", "s1", "s2", "doc_id", "text_hash", "start", "n", "twice"])


def _candidate_rows(batches):
    """Windows whose anchor has runs that differ, grouped exactly as far as one partition goes.

    A window met twice here is known to be repeated: its places go on as such, and one row without a place tells
    the other partitions. So a window of any frequency is one row for each partition in the shuffle.
    """
    held, size = [], 0

    def flush():
        part = [np.concatenate(x) for x in zip(*held, strict=True)]
        order = np.lexsort((part[1], part[0]))
        h1, h2, doc, text_hash, start = (x[order] for x in part)
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        group = np.cumsum(new) - 1
        known = np.bincount(group)[group] > 1
        told = known & new
        # known places are spread by document, not by window
        keys = [np.concatenate([np.where(known, doc, h1), h1[told]]), np.concatenate([np.where(known, start, h2), h2[told]])]
        fill = [np.concatenate([x, np.zeros(told.sum(), x.dtype)]) for x in (doc, text_hash, start)]
        state = np.concatenate([known.astype(np.int8), np.full(told.sum(), 2, np.int8)])
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*keys, *fill, state)], ["h1", "h2", "doc_id", "text_hash", "start", "state"])

    for batch in batches:
        ids, hashes, text, hot = (batch.column(k) for k in range(4))
        for a, b in steps(text):
            first, anchor, (one, two), inside, _, _ = _windows(text.slice(a, b - a).to_pylist(), second=True)
            at, row = _asked(first, anchor, inside, hot.slice(a, b - a))
            if len(at):
                held.append((one[at].view(np.int64), two[at].view(np.int64),
                             ids.slice(a, b - a).to_numpy(zero_copy_only=False)[row].astype(np.int64),
                             hashes.slice(a, b - a).to_numpy()[row], (at - first[row]).astype(np.int64)))
                size += len(at)
            if size > HELD_WINDOWS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _repeated_rows(batches):
    """Places of the windows that are met twice in a stream sorted by window."""
    rest = None

    def settle(table):
        h1, h2, state = (table.column(c).to_numpy() for c in ("h1", "h2", "state"))
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        group = np.cumsum(new) - 1
        met = np.bincount(group, np.where(state == 2, 2, np.where(state == 1, 0, 1)))[group] > 1
        keep = ((state == 1) | met) & (state != 2)
        return table.select(["doc_id", "text_hash", "start"]).filter(pa.array(keep)).combine_chunks().to_batches()

    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        h1, h2 = (table.column(c).to_numpy() for c in ("h1", "h2"))
        change = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        cut = int(change[-1]) if len(change) else 0
        if cut:
            yield from settle(table.slice(0, cut))
        rest = table.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield from settle(rest)


_NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def _span_rows(batches):
    """Runs (start and number of windows in one number) of a text as the words they cover: begin, end, begin, end, ..."""
    for batch in batches:
        out = []
        for runs in batch.column(2):
            run = np.sort(runs.values.to_numpy())
            begin = run >> 32
            end = np.maximum.accumulate(begin + (run & 0xFFFFFFFF) + WINDOW - 1)
            new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
            out.append(np.stack([begin[new], end[np.append(new[1:], len(end)) - 1]], 1).ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))],
                                         ["doc_id", "text_hash", "spans"])


def _cut(text: str | None, covered: np.ndarray) -> tuple[int, int, str]:
    """Words, removed words and what is left of one text without the words of some spans."""
    found = _NOT_SPACE.findall(text or "")
    if not len(covered):
        return len(found), 0, " ".join(found)
    gone = int((covered[1::2] - covered[::2]).sum())
    edges = [0, *covered.tolist(), len(found)]
    return len(found), gone, " ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in found[a:b])


def repeated_spans(docs: DataFrame, bitmap_cells: int = BITMAP_CELLS) -> DataFrame:
    """(doc_id, text_hash, spans): the words of each document that repeated windows cover.

    Equal windows have equal anchors. So if all runs of an anchor have the same words, and none meets a window twice,
    all their windows are repeated or, for a single run, none is. Only the windows of other anchors are grouped one
    by one.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), F.col("text")).where("text is not null")
    anchors = materialise(map_arrow(rows, _anchor_rows, "doc_id long, text_hash long, anchors array<long>"), "sub-anchors")
    n = anchors.agg(F.sum(F.size("anchors"))).first()[0] or 0
    cells = 1 << max(16, (CELLS_PER_ANCHOR * n - 1).bit_length())
    hot = materialise(repeated_cells(anchors, cells), "sub-cells")
    each = anchors.select("doc_id", "text_hash", F.explode(F.array_distinct("anchors")).alias("a"))
    if cells <= bitmap_cells and hot.count() <= HOT_CELLS:
        bits = docs.sparkSession.sparkContext.broadcast(_bitmaps(hot, cells))

        def asked(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for r in range(DEPTH):
                    at = batch.column(3 + r).to_numpy()
                    keep &= (bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                yield batch.select([0, 1, 2]).filter(pa.array(keep))

        each = map_arrow(each.select("*", *(cell(F.col("a"), r, cells).alias(f"c{r}") for r in range(DEPTH))), asked,
                         "doc_id long, text_hash long, a long")
    else:
        for r in range(DEPTH):
            each = each.withColumn("cell", cell(F.col("a"), r, cells)).join(hot, "cell", "left_semi").drop("cell")
    likely = each.groupBy("doc_id", "text_hash").agg(F.collect_set("a").alias("hot"))
    likely = if_small(materialise(likely, "sub-likely"), PLACES_BYTES)
    found = materialise(rows.join(likely, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "hot"), "sub-found")
    runs = materialise(map_arrow(found, _run_rows, "a long, s1 long, s2 long, doc_id long, text_hash long, start int, "
                                                   "n int, twice boolean"), "sub-runs")
    kinds = runs.groupBy("a", "s1", "s2").agg(F.count("*").alias("size"), F.max("twice").alias("twice"))
    kinds = kinds.groupBy("a").agg(F.sum("size").alias("size"), (F.max("twice") | (F.count("*") > 1)).alias("open"))
    kinds = materialise(kinds.where("size > 1 or open"), "sub-kinds")
    run = F.shiftleft(F.col("start").cast("long"), 32) + F.col("n")
    placed = join_hot(runs.select("a", "doc_id", "text_hash", run.alias("run")), kinds, "a", "size", runs.count())
    placed = materialise(placed.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("open"), F.col("a"))).alias("hot"),
        F.collect_set(F.when(~F.col("open"), F.col("run"))).alias("runs")), "sub-placed")
    unsettled = if_small(materialise(placed.where("size(hot) > 0").select("doc_id", "text_hash", "hot"), "sub-open"),
                         PLACES_BYTES)
    windows = map_arrow(found.drop("hot").join(unsettled, ["doc_id", "text_hash"]).select(*found.columns), _candidate_rows,
                        "h1 long, h2 long, doc_id long, text_hash long, start long, state byte")
    dealt = windows.repartition("h1", "h2").sortWithinPartitions("h1", "h2")
    again = map_arrow(dealt, _repeated_rows, "doc_id long, text_hash long, start long")
    again = again.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.shiftleft(F.col("start"), 32) + 1).alias("runs"))
    every = again.unionByName(placed.where("size(runs) > 0").select("doc_id", "text_hash", "runs"))
    every = every.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return materialise(map_arrow(every, _span_rows, "doc_id long, text_hash long, spans array<int>"), "sub-spans")


def remove_repeats(docs: DataFrame, bitmap_cells: int = BITMAP_CELLS) -> DataFrame:
    """Remove every word covered by a window of 35 words whose word sequence also starts anywhere else.

    Words are runs of other characters than ASCII white space, unchanged. The sketch counts anchors, and a window
    that repeats has an anchor in two places, so counts are never too low and none is lost; what it lets through is
    grouped by two 64-bit hashes of its words. Windows are judged on the input.

    Returns all columns of ``docs``, ``text`` as its kept words joined by single blanks (null stays null), and
    ``n_words`` and ``n_removed``, prefixed by underscores where ``docs`` has such names. Rows that agree in
    doc_id and text are two occurrences and get the same result.
    """
    covered = repeated_spans(docs, bitmap_cells).withColumnsRenamed({"doc_id": "_d", "text_hash": "_t", "spans": "_s"})
    covered = if_small(covered, PLACES_BYTES)
    n_words, n_removed, hidden = fresh(docs, "n_words", "n_removed", "_hash")
    marked = docs.withColumn(hidden, F.xxhash64("text"))
    joined = marked.join(covered, (F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)) == F.col("_d"))
                         & (F.col(hidden) == F.col("_t")), "left").select(*docs.columns, "_s")
    place, schema = docs.columns.index("text"), docs.schema

    def run(batches):
        for batch in batches:
            done = [_cut(t, np.asarray(s or [], np.int64)) for t, s in
                    zip(batch.column(place).to_pylist(), batch.column(len(schema)).to_pylist(), strict=True)]
            left = [None if t is None else d[2] for t, d in zip(batch.column(place).to_pylist(), done, strict=True)]
            columns = [pa.array(left, pa.string()) if k == place else batch.column(k) for k in range(len(schema))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d[0] for d in done], pa.int64()),
                                              pa.array([d[1] for d in done], pa.int64())],
                                             [*(f.name for f in schema), n_words, n_removed])

    return map_arrow(joined, run, f"{_ddl(schema)}, `{n_words}` long, `{n_removed}` long")


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def op3_substring_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM w WHERE len(w) >= 35)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM win WHERE s IN (SELECT s FROM rep)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
