"""Line dedup, decontamination, substring dedup and the Jaccard join on edge cases, against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from medcohort.llm import decontamination, line_dedup, ngram_join, substring_dedup

SCHEMA = "doc_id long, text string, n_lines string, _hash int, n_words int, `Key` string"


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "x", 1, 2, "y") for k, t in enumerate(texts)], SCHEMA)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "A,b", "the"]
    base = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(n // 3)]
    texts = [None, "", " ", "\n\n", "a", "a", "\x1cx\xa0y"]
    for _ in range(n):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.choice(base).split(" ")
            if rng.random() < 0.5:
                k = rng.randrange(len(words))
                words[k:k + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    return texts + texts[-3:] + [" ".join(["same"] * 3000)]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, seed):
    texts = corpus(seed)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    seen = []
    for k, text in enumerate(texts):
        left, removed, lines = [], 0, (text or "").split("\n")
        for line in lines:
            words = line.split(" ")
            gone = line.strip(" ") and any(
                line == other or len(words) >= 8 <= len(o) and one_edit(words, o) for other, o in seen)
            if line.strip(" "):
                seen.append((line, words))
            if gone:
                removed += 1
            else:
                left.append(line)
        row = got[k]
        assert row["text"] == (None if text is None else "\n".join(left))
        assert row["n_removed"] == removed and row["_n_lines"] == sum(bool(x.strip(" ")) for x in lines)
        assert row["n_lines"] == "x" and row["Key"] == "y"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, seed):
    texts = corpus(seed)
    rng = random.Random(seed)
    items = [None, "", "...", "a", "w1 W2", "w3 w4 w5 w6", *(" ".join(words(t)[k:k + 20]) for t in texts[8:14] for k in (0, 5))]
    items += [items[-1], " ".join(f"z{k}" for k in range(13)), " ".join(rng.choices(["the", "w1"], k=14))]
    bench = spark.createDataFrame([(100 + k, t, "q") for k, t in enumerate(items)], "item_id long, text string, words string")
    got = {r["doc_id"]: r for r in decontamination.contamination(frame(spark, texts), bench).collect()}
    for k, text in enumerate(texts):
        own, hit, found = words(text), set(), set()
        for i, item in enumerate(items):
            w = words(item)
            n = min(13, len(w))
            for a in range(len(w) - n + 1) if n else ():
                for p in range(len(own) - n + 1):
                    if own[p:p + n] == w[a:a + n]:
                        hit.update(range(p, p + n))
                        found.add(str(100 + i))
        row = got[k]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(own), len(hit), len(found))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(own))
    kept = decontamination.decontaminate(frame(spark, texts), bench)
    assert kept.columns == frame(spark, texts).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, r in got.items() if not r["contaminated"])


@pytest.mark.parametrize("bitmap_cells", [substring_dedup.BITMAP_CELLS, 0])
def test_substring_dedup(spark, bitmap_cells):
    rng = random.Random(5)
    passages = [[f"p{j}x{k}" for k in range(n)] for j, n in enumerate((34, 35, 36, 80))]
    texts = [None, "", "a b", " ".join(["loop"] * 90), "\x0b".join(passages[3]) + "\xa0z"]
    for _ in range(40):
        parts = [[f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(40))] for _ in range(2)]
        texts.append(" ".join(parts[0] + rng.choice(passages) + parts[1]).replace(" ", rng.choice([" ", "\n", " \t "])))
    texts += [texts[8], texts[9]]
    docs = frame(spark, texts).unionByName(frame(spark, texts).where("doc_id = 20"))
    got = substring_dedup.remove_repeats(docs, bitmap_cells).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = {}
    for w in split:
        for k in range(len(w) - 34):
            count[tuple(w[k:k + 35])] = count.get(tuple(w[k:k + 35]), 0) + 1
    want = []
    for (doc, text), w in zip(rows, split):
        gone = {p for k in range(len(w) - 34) if count[tuple(w[k:k + 35])] > 1 for p in range(k, k + 35)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want.append((doc, len(w), len(gone), None if text is None else kept))
    assert sorted(((r["doc_id"], r["_n_words"], r["n_removed"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert got[0].asDict().keys() >= {"n_words", "Key", "n_lines"}


def test_substring_dedup_groups_runs_before_windows(spark, monkeypatch):
    stored, store = {}, substring_dedup.materialise
    monkeypatch.setattr(substring_dedup, "materialise", lambda df, tag: stored.setdefault(tag, store(df, tag)))
    copied = " ".join(f"c{k}" for k in range(400))
    docs = frame(spark, [copied] * 5 + [" ".join(f"u{k}" for k in range(200)), "round and " * 60])
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {0: 400, 1: 400, 2: 400, 3: 400, 4: 400, 5: 0, 6: 120}
    assert "sub-starts" not in stored  # a number for each repeated window: 366 of each copy
    assert sorted(r["spans"] for r in stored["sub-spans"].collect()) == [[0, 120]] + [[0, 400]] * 5
    # windows go one by one only where an anchor's runs differ, or a run may meet a window twice
    assert [r["doc_id"] for r in stored["sub-open"].collect()] == [6]


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard_join(spark, monkeypatch, block):
    from medcohort.llm import blocks
    monkeypatch.setattr(blocks, "BLOCK", block)
    rng = random.Random(7)
    base = [[f"v{rng.randrange(500)}" for _ in range(rng.choice([3, 60, 200]))] for _ in range(8)]
    texts = [None, None, "", "", "!!", "a b", "A  b"]
    for _ in range(70):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += texts[-2:]
    got = {r["doc_id"]: r for r in ngram_join.near_classes(frame(spark, texts)).collect()}

    def runs(t):
        w = words(t)
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    sets = [runs(t) for t in texts]
    links = {k: [] for k in range(len(texts))}
    for a in range(len(texts)):
        for b in range(len(texts)):
            if a != b and texts[a] is not None and texts[b] is not None:
                both = len(sets[a] & sets[b])
                if texts[a] == texts[b] or both and both >= 0.8 * len(sets[a] | sets[b]):
                    links[a].append(b)
    for k in links:
        reach, todo = {k}, [k]
        while todo:
            for n in links[todo.pop()]:
                if n not in reach:
                    reach.add(n)
                    todo.append(n)
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (len(links[k]), min(reach), k == min(reach)), k
        assert got[k]["class_id"] == min([k, *(j for j in links[k] if texts[j] == texts[k])])
    kept = ngram_join.drop_near_copies(frame(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, r in got.items() if r["kept"])
    assert kept.columns == frame(spark, texts).columns


def test_pruning_keeps_the_threshold():
    least = ngram_join.least_matches()
    assert len(least) == 8 and all(0 < m < 16 * (k + 1) * 0.8 for k, m in enumerate(least))


@pytest.mark.parametrize("operator", [
    line_dedup.dedup_lines, substring_dedup.remove_repeats, ngram_join.near_classes, ngram_join.drop_near_copies,
    lambda d: decontamination.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    lambda d: decontamination.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text"))])
def test_empty_tables_and_null_ids(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None, None)] * 2, SCHEMA)
    assert operator(nulls).count() == 2


def test_near_copies_with_repeated_and_null_ids(spark):
    base = [f"word{k}" for k in range(60)]
    near, other = " ".join([*base[:-1], "changed"]), " ".join(f"other{k}" for k in range(60))
    base, both = " ".join(base), [" ".join([f"z{k}" for k in range(60)] + [x]) for x in ("a", "b")]
    rows = [(1, base), (2, near), (2, other), (3, both[0]), (None, both[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.drop_near_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], *rows[2:]], key=str)
    links = {(r["doc_id"], r["n_links"], r["component_id"]) for r in ngram_join.near_classes(docs).collect()}
    assert links == {(1, 1, 1), (2, 1, 1), (2, 0, 2), (3, 1, 3), (None, 1, 3)}
