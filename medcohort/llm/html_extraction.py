"""Main text of web pages: markup rules, and differencing with the page of the nearest URL."""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medcohort.llm.common import if_small, map_arrow, materialise, read_table, word_hashes
from medcohort.llm.url_filters import url_host, url_path

#: A comment, a declaration, or the start of a tag up to its name.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
#: Within a tag: a quote that begins a value, or the tag's end.
_IN_TAG = re.compile(r"""=\s*+(["'])|>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
#: Elements whose content is no markup; their text is dropped.
_RAW = {"script", "style", "template", "noscript", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
#: Elements that never hold main text.
_ASIDE = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "object", "audio", "video",
          "dialog", "menu", "map", "fieldset"}
_MAIN = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hgroup", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
          "tfoot", "thead", "tr", "ul"}
#: Words of a class, id or role that mark other parts of a page.
_MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
          "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "footer", "menu",
          "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related",
          "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Words that, beside such a word, only say which part of the layout it is.
_PLACES = {"area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "form", "global",
           "icons", "inline", "inner", "item", "items", "label", "left", "links", "list", "main", "message", "mobile",
           "outer", "overlay", "page", "panel", "posts", "primary", "right", "secondary", "section", "signup", "site",
           "slot", "thread", "top", "unit", "wrap", "wrapper"}
#: Names of the text itself: one of the first words followed by one of the second.
_TEXT_OF = {"article", "entry", "main", "page", "post", "story"}
_TEXT = {"body", "content", "text"}
_HEADS = {"header", "masthead"}
_CELLS = {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}
_PARENTS = _BLOCK | _CELLS | {"dialog", "menu"}
_ITEM = (_BLOCK | {"menu", "td", "th", "button", "object"}) - {"address", "div", "p", "br", "hr"}
#: Elements that may lack an end tag: the starts that end them, the elements inside them that shield from that, and the
#: parents whose end is theirs.
_IMPLIED = {
    "p": ((_BLOCK | _CELLS | {"menu", "dialog"}) - {"body", "br", "html"}, {"button", "object", "table"}, _PARENTS),
    "li": ({"li"} | _CELLS, _ITEM, _PARENTS),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"} | _CELLS, _ITEM, _PARENTS)),
    **dict.fromkeys(("td", "th"), (_CELLS | {"col"}, {"table"}, _CELLS | {"table"})),
    "tr": (_CELLS - {"td", "th"} | {"col"}, {"table"}, _CELLS | {"table"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot"}, {"table"}, {"table"})),
    "option": ({"option", "optgroup", "hr"}, {"select"}, {"select", "optgroup", "datalist"}),
}


def _marks(words: list[str], marks: set[str]) -> bool:
    """Whether the name made of ``words`` marks another part: by its last word, or if all others are words of layout."""
    if not words:
        return False
    return words[-1] in marks or not marks.isdisjoint(words) and marks.union(_PLACES).issuperset(words)


def _tag_end(page: str, at: int, lost: dict[str, int]) -> tuple[int, int]:
    """Where a tag's attributes end and where the text after the tag begins.

    A value's quote is skipped to its partner. A quote without one is a plain character; ``lost`` remembers from where
    on a quote has no partner, so a page of any length is read once.
    """
    while found := _IN_TAG.search(page, at):
        at = found.end()
        if not found[1]:
            return at - 1, at
        if at < lost.get(found[1], len(page)):
            partner = page.find(found[1], at)
            if partner < 0:
                lost[found[1]] = at
            else:
                at = partner + 1
    return len(page), len(page)


def _left_out(name: str, attributes: str, in_main: bool) -> bool:
    if name in _ASIDE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body") or name in _MAIN and not in_main and "comment" not in attributes.lower():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id", "role"):
            names = [[w for w in re.split(r"[^a-z0-9]+", name) if w] for name in value.split()]
            if not any(len(n) > 1 and n[-1] in _TEXT and _TEXT_OF.intersection(n[:-1]) for n in names):
                if any(_marks(n, _MARKS if in_main else _MARKS | _HEADS) for n in names):
                    return True
    return False


def blocks_of(page: str | None) -> list[tuple[str, bool]]:
    """The text blocks of a page in page order, each with whether it is inside ``article`` or ``main``.

    Parts that markup names as something else are left out with all they contain: by element; by a class, id or role
    whose last word is one of ``_MARKS``, or that has one beside words of layout only (so ``related-work`` and
    ``notice-of-meeting`` stay), unless another name there is one of the text itself, as ``main-content``.
    Paragraphs, list items, table cells, rows and options without an end tag end at the start of the next sibling or
    the end of the parent, as HTML implies; any other element that is not closed runs to the end. Character references
    are decoded, white space is one blank, blocks without text are dropped. Time is linear in the page, also if malformed.
    """
    page = page or ""
    blocks: list[tuple[str, bool]] = []
    parts: list[str] = []
    lost: dict[str, int] = {}
    depth = out_depth = at = 0
    out_name = ""
    opened: dict[str, int] = {}  # elements around the one that is left out
    inside: list[str] = []  # elements open within a left-out one that may lack its end tag

    def close() -> None:
        line = " ".join("".join(parts).split())
        parts.clear()
        if line:
            blocks.append((line, depth > 0))

    while at < len(page):
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at and not out_name:
            parts.append(entities.unescape(page[at:end]))
        if not found:
            break
        at = found.end()
        shut, name = found[1], (found[2] or "").lower()
        if not name:
            continue
        begin = at
        stop, at = _tag_end(page, at, lost)
        attributes = page[begin:stop]
        if out_name in _IMPLIED and name not in _RAW:
            starts, shields, parents = _IMPLIED[out_name]
            if shut and name in inside:
                while inside.pop() != name:
                    pass
                continue
            if shut and name == out_name:
                out_name = ""
                continue
            if not (name in parents and opened.get(name) if shut else name in starts and shields.isdisjoint(inside)):
                if not shut and name not in _VOID:
                    inside.append(name)
                continue
            out_name = ""
        if name in _RAW and not shut:
            if not attributes.endswith("/"):
                last = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(page, at)
                at = last.end() if last else len(page)
        elif out_name:
            if name == out_name:
                out_depth += -1 if shut else 1
                if not out_depth:
                    out_name = ""
        elif not shut and name not in _VOID and _left_out(name, attributes, depth > 0):
            close()
            out_name, out_depth = name, 1
            inside.clear()
        else:
            if shut:
                opened[name] = max(0, opened.get(name, 0) - 1)
            elif name not in _VOID:
                opened[name] = opened.get(name, 0) + 1
            if name in _BLOCK:
                close()
            elif name in ("td", "th"):
                parts.append(" ")
            if name in _MAIN:
                depth = max(0, depth + (-1 if shut else 1))
    close()
    return blocks


def lines_of(page: str | None) -> tuple[list[str], list[str]]:
    """The blocks of :func:`blocks_of` inside ``article`` or ``main``, and all others."""
    blocks = blocks_of(page)
    return [x for x, marked in blocks if marked], [x for x, marked in blocks if not marked]


def chosen(blocks: list[tuple[str, bool]]) -> tuple[list[tuple[str, int]], bool]:
    """The blocks that may be main text, each with its place among the unmarked ones (-1: marked), in page order; and
    whether unmarked ones are among them.

    All marked blocks are, and each unmarked block longer than all marked text (all of them, if nothing is marked).
    """
    marked_size = sum(len(x) for x, marked in blocks if marked)
    out, place, open_ = [], 0, False
    for line, marked in blocks:
        if marked:
            out.append((line, -1))
            continue
        if len(line) > marked_size:
            out.append((line, place))
            open_ = True
        place += 1
    return out, open_


#: Bits of alignment states that are kept at once; longer alignments are halved first.
STATE_BITS = 1 << 26


def _state_rows(mine: list[int], other: list[int], keep: bool) -> list[int]:
    """Alignment states after each of ``mine`` (only the last unless ``keep``): bit j is 0 where the length of the
    longest common subsequence with ``other[: j + 1]`` is one more than with ``other[:j]``."""
    masks: dict[int, int] = {}
    for j, x in enumerate(other):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    state, rows = full, []
    for x in mine:
        both = state & masks.get(x, 0)
        state = ((state + both) | (state - both)) & full
        if keep:
            rows.append(state)
    return rows if keep else [state]


def _lengths(mine: list[int], other: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``mine`` with every prefix of ``other``."""
    n = len(other)
    state = _state_rows(mine, other, False)[0]
    bits = np.unpackbits(np.frombuffer(state.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(mine: list[int], other: list[int], limit: int = STATE_BITS) -> list[int]:
    """Places in ``mine`` of a longest common subsequence with ``other``, by bit vectors.

    Blocks that only one side has are set aside first. States of over ``limit`` bits are not held: ``mine`` is halved,
    and ``other`` cut where the halves' lengths sum to most.
    """
    here, there = set(mine), set(other)
    places = [k for k, x in enumerate(mine) if x in there]
    out: list[int] = []
    todo = [(0, [mine[k] for k in places], [x for x in other if x in here])]
    while todo:
        first, a, b = todo.pop()
        if not a or not b:
            continue
        if len(a) == 1:
            out += [first] if a[0] in b else []
        elif len(a) * len(b) > limit:
            half = len(a) // 2
            cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
            todo += [(first + half, a[half:], b[cut:]), (first, a[:half], b[:cut])]
        else:
            rows = _state_rows(a, b, True)
            i, j, found = len(a), len(b), []
            while i and j:
                if rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
                    i -= 1
                else:
                    found.append(first + i - 1)
                    i, j = i - 1, j - 1
            out += found[::-1]
    return [places[k] for k in out]


def _hashes(lines: list[str]) -> list[int]:
    if not lines:
        return []
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    size = np.array([len(x) for x in raw])
    ends = np.cumsum(size)
    return word_hashes(np.frombuffer(b"".join(raw) + b" ", np.uint8), ends - size, ends).view(np.int64).tolist()


#: Pages whose common blocks are this share of the larger one's bytes, or more, are copies: they tell nothing of furniture.
COPY_SHARE = 2 / 3
#: A shared block of marked text goes if it is on this share of the host's pages with marked text, and on as many pages.
FURNITURE_SHARE, FURNITURE_PAGES = 1 / 2, 4
#: Pages of one run that meet their partner in one key.
RUN_BLOCK = 1000
_KEYS = ("key", "key2")
_LIGHT = "host string, path string, need boolean, lines array<long>, sizes array<int>, key long, key2 long"


def _keys() -> list[Column]:
    return [F.xxhash64("url", "html").alias("key"), F.xxhash64(F.lit("second"), "url", "html").alias("key2")]


def _difference(mine: list[int], sizes: list[int], other: list[int], other_sizes: list[int]) -> list[int] | None:
    """Blocks of ``mine`` that ``other`` shares, or None if the two are copies."""
    if mine == other:
        return None
    shared = shared_lines(mine, other)
    copies = sum(sizes[i] for i in shared) >= COPY_SHARE * max(sum(sizes), sum(other_sizes))
    return None if copies else shared


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _numbered(light: DataFrame) -> DataFrame:
    """``light`` with ``place``: 0, 1, ... in order of host, path and page, by ranks within range partitions and a sum
    over one row a partition."""
    order = ["host", "path", *_KEYS]
    stored = materialise(light.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "page-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return materialise(stored.withColumn("rank", rank).join(F.broadcast(offsets), "part")
                       .withColumn("place", F.col("offset") + F.col("rank") - 1).drop("offset", "rank"), "page-places")


def _runs(pages: DataFrame) -> DataFrame:
    """(place, first): the place of each page, and of the first page of its run; in a run of pages of one host in path
    order, each is a copy of the one before it."""
    ahead = pages.select((F.col("place") + 1).alias("place"), F.col("host").alias("host2"),
                         F.col("lines").alias("lines2"), F.col("sizes").alias("sizes2"))
    pairs = pages.select("part", "place", "host", "lines", "sizes").join(ahead, "place", "left")
    pairs = pairs.select("part", "place", F.coalesce(F.col("host") == F.col("host2"), F.lit(False)).alias("one_host"),
                         "lines", "sizes", "lines2", "sizes2")

    def begins(batches):
        for batch in batches:
            first = [r["place"] if not r["one_host"] or
                     _difference(r["lines"], r["sizes"], r["lines2"], r["sizes2"]) is not None else None
                     for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first, pa.int64())],
                                             ["part", "place", "first"])

    marked = materialise(map_arrow(pairs, begins, "part int, place long, first long"), "page-runs")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = marked.groupBy("part").agg(F.max("first").alias("greatest")).select(
        "part", F.max("greatest").over(before).alias("earlier"))  # one row a partition
    here = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = marked.withColumn("first", F.max("first").over(here)).join(F.broadcast(earlier), "part")
    return materialise(rows.select("place", F.coalesce("first", "earlier").alias("first")), "page-run-places")


def _furniture(best: DataFrame, placed: DataFrame) -> DataFrame:
    """The check after differencing: of the shared blocks ``gone`` of marked text, those on ``FURNITURE_SHARE`` of the
    host's pages and on ``FURNITURE_PAGES`` at least. Passages that some articles share are text."""
    shared = best.join(placed.select(*_KEYS, "host", "lines"), list(_KEYS)).select(
        *_KEYS, "host", "lines", F.explode("gone").alias("place"))
    shared = materialise(shared.select(*_KEYS, "host", "place", F.col("lines")[F.col("place")].alias("line")), "page-shared")
    asked = if_small(materialise(shared.select("host", "line").distinct(), "page-asked"))
    often = placed.select("host", F.explode(F.array_distinct("lines")).alias("line")).join(
        asked, ["host", "line"], "left_semi").groupBy("host", "line").agg(F.count("*").alias("n"))
    often = often.join(placed.groupBy("host").agg(F.count("*").alias("all")), "host").where(
        (F.col("n") >= FURNITURE_PAGES) & (F.col("n") >= F.col("all") * FURNITURE_SHARE)).select("host", "line")
    return shared.join(often, ["host", "line"]).groupBy(*_KEYS).agg(F.collect_list("place").alias("gone"))


def template_lines(pages: DataFrame, marked: bool = False) -> DataFrame:
    """(key, key2, gone): for pages with unmarked blocks in their result, the places of the unmarked blocks they share
    with the nearest page in path order on their host that is no copy (``COPY_SHARE``).

    Pages of a host in path order form runs in which each is a copy of the one before; a page's neighbours are those on
    either side of its run, however long. Of the two, the one with the longer common path (the one before, in a tie)
    that is no copy of the page itself is aligned with it; without one the page keeps all blocks. Repeated rows are one
    page.

    With ``marked``, the same is done among the pages with marked text, for its blocks, and an exact check follows
    (:func:`_furniture`).

    Pages are numbered by host and path over range partitions, so a host of any size is many partitions. A run meets its
    neighbours in blocks of ``RUN_BLOCK`` places, each a key of its own.
    """
    rows = pages.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html", *_keys())

    def run(batches):
        for batch in batches:
            found = [blocks_of(h) for h in batch.column(2).to_pylist()]
            mine = [[x for x, inside in blocks if inside == marked] for blocks in found]
            need = [bool(lines) for lines in mine] if marked else [chosen(blocks)[1] for blocks in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(need, pa.bool_()),
                 pa.array([_hashes(lines) for lines in mine], pa.list_(pa.int64())),
                 pa.array([[len(x.encode("utf-8", "surrogatepass")) for x in lines] for lines in mine],
                          pa.list_(pa.int32())), batch.column(3), batch.column(4)],
                ["host", "path", "need", "lines", "sizes", "key", "key2"])

    order = ["host", "path", *_KEYS]
    light = materialise(map_arrow(rows, run, _LIGHT), "page-lines")
    if light.where("need").isEmpty():
        return light.select(*_KEYS, F.array().cast("array<int>").alias("gone")).limit(0)
    if marked:
        light = light.where("need")
    placed = _numbered(light.groupBy(*order).agg(F.first("need").alias("need"), F.first("lines").alias("lines"),
                                                 F.first("sizes").alias("sizes")))
    runs = _runs(placed)
    sides = runs.groupBy("first").agg(F.max("place").alias("last")).select(
        "first", F.explode(F.sequence(F.floor(F.col("first") / RUN_BLOCK), F.floor(F.col("last") / RUN_BLOCK))).alias("block"),
        F.array(F.struct((F.col("first") - 1).alias("place"), F.lit(1).alias("side")),
                F.struct((F.col("last") + 1).alias("place"), F.lit(0).alias("side"))).alias("at"))
    partners = sides.select("first", "block", F.inline("at")).join(
        placed.select("place", F.col("host").alias("host2"), F.col("path").alias("path2"),
                      F.col("lines").alias("lines2"), F.col("sizes").alias("sizes2")), "place").drop("place")
    met = placed.where("need").join(runs, "place").withColumn("block", F.floor(F.col("place") / RUN_BLOCK))
    met = met.join(partners, ["first", "block"]).where(F.col("host") == F.col("host2"))
    met = met.select(*_KEYS, "path", "path2", "side", "lines", "sizes", "lines2", "sizes2")

    def align(batches):
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                gone = _difference(r["lines"], r["sizes"], r["lines2"], r["sizes2"])
                if gone is not None:
                    found.append({"key": r["key"], "key2": r["key2"], "side": r["side"], "gone": gone,
                                  "score": _common(r["path"], r["path2"])})
            yield pa.RecordBatch.from_pylist(found, schema=_FOUND)

    best = map_arrow(met, align, "key long, key2 long, score int, side int, gone array<int>")
    best = best.groupBy(*_KEYS).agg(F.max_by("gone", F.struct("score", "side")).alias("gone"))
    best = best.where(F.size("gone") > 0)
    return materialise(_furniture(best, placed) if marked else best, "page-gone")


_FOUND = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("score", pa.int32()), ("side", pa.int32()),
                    ("gone", pa.list_(pa.int32()))])


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page, from its whole html (null: empty).

    What markup names as menu, header, footer, sidebar, notice, advert, form, comment, script or style goes. Of a page
    with text in ``article`` or ``main`` elements, that text is the result, with any other block longer than all of it.
    Blocks outside such elements are deleted if a longest common subsequence aligns them with the page of the host
    with the nearest URL path that is no copy. Blocks inside marked articles are aligned in the same way among
    themselves, but copied articles and quoted passages are common: of the blocks that differencing finds, only those
    on half of the host's pages with marked text go (4 pages at least), and never all of a page's marked text.

    Returns page_id, url, text, n_chars (code points), one row per input row, repeated rows included. Other columns
    are not read. A page alone with its copies on its host keeps all its blocks.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"), *_keys())
    for name, marked in (("gone", False), ("gone_marked", True)):
        rows = rows.join(if_small(template_lines(pages, marked).withColumnRenamed("gone", name)), list(_KEYS), "left")
    rows = rows.select("page_id", "url", "html", "gone", "gone_marked")

    def run(batches):
        for batch in batches:
            texts = []
            for page, skip, skip_marked in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                out, kept = set(skip or ()), chosen(blocks_of(page))[0]
                within = [i for i, (_, k) in enumerate(kept) if k < 0]
                drop = {within[i] for i in skip_marked or ()}
                if len(drop) == len(within):
                    drop = set()
                texts.append("\n".join(x for i, (x, k) in enumerate(kept) if k not in out and i not in drop))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark, sf_dir):
    return extract(read_table(spark, sf_dir, "pages"))
