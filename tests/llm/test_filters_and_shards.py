"""URL filters and sharding on edge cases, against brute force."""

import random
import zlib

import pytest

from medcohort.llm import sharding, url_filters

URLS = ["https://www.Example.ORG/es/x", "http://example.org/en/12?q", "http://a.b.com/de/", "x.com/de/", None, "",
        "ftp://org", "http://org/", "http://notexample.org/es/", "http://ex.com/fr/#a", "http://ex.com?/fr/",
        "http://com./de/", "://com/de/y", "http://é.com/de/", "http://a.com/de/", "http://a.com/de/"]


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: next((k for k, c in enumerate(path) if c in "?#"), len(path))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


@pytest.mark.parametrize("rules", [url_filters.RULES, (("com", "/de/", "allow"), ("com", "/de/", "block"), ("a.com", "/", "allow"))])
def test_urls_match_brute_force(spark, rules):
    rows = [(k % 15, u, "x", 1) for k, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    got = sorted(map(tuple, url_filters.filter_urls(pages, rules).collect()), key=str)
    assert got == sorted(((k, *judge(u, rules)) for k, u, _, _ in rows), key=str)


def test_urls_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.filter_urls(pages).count() == 0
    assert url_filters.filter_urls(spark.createDataFrame([(1, None)], pages.schema), []).first()["verdict"] == "allow"


def test_very_long_urls(spark):
    rules = url_filters.RULES
    urls = ["http://" + "a." * 3000 + "example.org/es/" + "x/" * 50_000, "http://" + "a" * 300_000 + ".com/de/", "http://b.org?" + "/" * 300_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = sorted(map(tuple, url_filters.filter_urls(pages, rules).collect()))
    assert got == [(k, *judge(u, rules)) for k, u in enumerate(urls)]


def test_hilbert_curve_visits_every_cell_by_unit_steps(spark):
    for bits in (1, 2, 3):
        cells = {r["curve"]: (r["x"], r["y"], r["z"]) for r in sharding.hilbert_cells(spark, bits).collect()}
        assert sorted(cells) == list(range(8 ** bits)) and len(set(cells.values())) == 8 ** bits
        assert all(sum(abs(a - b) for a, b in zip(cells[k], cells[k + 1])) == 1 for k in range(8 ** bits - 1))


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 500])
def test_shards(spark, n):
    rng = random.Random(n)
    texts = [None, "", "same", "é" * 50, "x" * 100_000]
    rows = [(rng.choice([None, k, k, k]), texts[rng.randrange(5)] if rng.random() < 0.7 else str(k), rng.choice(["en", None]),
             rng.choice(["a", "b", None]), "c") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, Shard string")
    got = sharding.shard(docs).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1
    curve = sorted((r["shard"], r["slot"], r["curve_index"]) for r in got)
    assert [c[2] for c in curve] == sorted(c[2] for c in curve)


def test_cells_are_ranges_of_equal_shares(spark):
    rng = random.Random(3)
    values = [f"v{rng.randrange(40):02d}" for _ in range(900)] + ["v07"] * 600
    rows = spark.createDataFrame([(v,) for v in values], "source string")
    got = {r["source"]: (r["n"], r["cell"]) for r in sharding.ranked_cells(rows, "source", 3).collect()}
    before = 0
    for v in sorted(set(values)):
        n = values.count(v)
        assert got[v] == (n, (2 * before + n) * 8 // (2 * len(values)))
        before += n


def test_few_shards_hold_a_value(spark):
    """Least and greatest values of a shard's rows prune it: a filter on one dimension opens a part of the shards."""
    rng = random.Random(9)
    rows = [(k, "x" * int(2 ** rng.uniform(3, 12)), rng.choice(["de", "en", "es", "fr"]), f"s{rng.randrange(16):02d}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shard_of = {r["doc_id"]: r["shard"] for r in sharding.shard(docs).collect()}
    for column, most in ((2, 14), (3, 16)):
        spans = {}
        for r in rows:
            spans.setdefault(shard_of[r[0]], []).append(r[column])
        for value in {r[column] for r in rows}:
            assert sum(min(v) <= value <= max(v) for v in spans.values()) <= most


def plain_places(rows, bits=4, shards=24):
    """Independent placement: quantise by rank, sort by the curve, the hashes and the id, and cut."""
    cells = []
    for column in range(3):
        values = sorted(r[column] for r in rows)
        cells.append({v: (2 * values.index(v) + values.count(v)) * (1 << bits) // (2 * len(rows)) for v in set(values)})
    return [tuple(cells[c][r[c]] for c in range(3)) for r in rows]


def test_shards_follow_the_curve_of_ranked_cells(spark):
    rng = random.Random(4)
    rows = [(k, "y" * rng.randrange(1, 400), rng.choice(["de", "en", None]), rng.choice(["a", "b", "c", None])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    curve = {(r["x"], r["y"], r["z"]): r["curve"] for r in sharding.hilbert_cells(spark, 4).collect()}
    plain = plain_places([(r[2] or "", r[3] or "", len(r[1])) for r in rows])
    got = {r["doc_id"]: r for r in sharding.shard(docs).collect()}
    assert all(got[r[0]]["curve_index"] == curve[p] for r, p in zip(rows, plain))
    order = sorted(got.values(), key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve_index"] for r in order] == sorted(curve[p] for p in plain)
    assert [r["shard"] for r in order] == [k * 24 // 400 for k in range(400)]
