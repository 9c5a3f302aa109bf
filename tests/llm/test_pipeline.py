"""The pipeline's stages against plain versions of what they promise."""

import corpus_pipeline
from medcohort.llm import decontamination, toxicity
from medcohort.llm.common import read_table

from ..conftest import SF0001


def test_stages_take_effect(spark):
    docs = read_table(spark, SF0001, "documents")
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, before, SF0001), "test-stage")
        assert after.columns == columns
        kept[name], before = (before, after), after
    first, second = kept["toxicity"]
    model = toxicity.train(docs, read_table(spark, SF0001, "labels"))
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(first, model).collect()}
    assert {r["doc_id"] for r in second.collect()} == {k for k, bad in scored.items() if not bad}
    first, second = kept["line dedup"]
    lines = {r["doc_id"]: (r["text"] or "").split("\n") for r in first.collect()}
    seen = set()
    for row in second.orderBy("doc_id").collect():
        left = (row["text"] or "").split("\n")
        assert set(left) <= {*lines[row["doc_id"]], ""} and row["n_chars"] == len(row["text"] or "")
        shown = [x for x in left if x.strip(" ")]
        assert not seen.intersection(shown)
        seen.update(shown)
    first, second = kept["benchmark decontamination"]
    judged = decontamination.contamination(first, read_table(spark, SF0001, "benchmark"))
    assert {r["doc_id"] for r in second.collect()} == {r["doc_id"] for r in judged.where("not contaminated").collect()}
    packed = corpus_pipeline.run(spark, SF0001)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in before.collect()}


def shingles(text):
    import re
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    n = min(5, len(words))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()


def kept_by_jaccard(rows):
    """Ids that stay when all pairs are compared and the least id of every component is kept."""
    sets = [(k, text, shingles(text)) for k, text in rows if text is not None]
    least = {k: k for k, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, (a, t, s) in enumerate(sets):
            for b, u, r in sets[:i]:
                if t == u or s and r and len(s & r) >= 0.8 * len(s | r):
                    low = min(least[a], least[b])
                    changed |= least[a] != low or least[b] != low
                    least[a] = least[b] = low
    return sorted(k for k, _ in rows if least[k] == k)


def test_jaccard_stage_against_all_pairs(spark):
    import random
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choices(words, k=rng.randrange(3, 120)) for _ in range(25)]
    rows = [(0, None), (1, ""), (2, ""), (3, "!!"), (4, None)]
    for k in range(5, 120):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_copies_stage(spark, docs, SF0001)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == kept_by_jaccard(rows)


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids, texts and other columns, empty and very long texts, repeated rows; then no rows at all."""
    long = " ".join(f"word{k}" for k in range(9000))
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "loose text without an id", "en", None, 3),
            (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, None, None, "a", None), (3, long, "de", "b", len(long)),
            (4, "one line of its own\nand a second line", "en", "b", 1), (4, "one line of its own\nand a second line", "en", "b", 1)]
    for name, some in (("odd", rows), ("none", [])):
        base = str(tmp_path / name)
        spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, None, None)][:len(some)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "")][:len(some)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        packed = corpus_pipeline.run(spark, base).collect()
        ids = {r["doc_id"] for r in packed}
        assert ids == ({None, 1, 2, 3, 4} if some else set())
        places = {}
        for r in packed:
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for place in places.values():
            place.sort()
            assert [a for a, _ in place] == [sum(n for _, n in place[:k]) for k in range(len(place))]
            assert sum(n for _, n in place) <= 4096
