"""Hard negatives, quality and conversation repair: brute force, held-out accuracy and edge cases."""

import hashlib
import heapq
import math
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from medcohort.llm import conversation_repair as repair
from medcohort.llm import hard_negatives, quality

# --- hard negatives ------------------------------------------------------------------------


def mined(rows, positives=5, negatives=5, low=80, high=100, every=10):
    """Plain form: rows are (vec_id, vector, label)."""
    good = [(i, v, k) for i, v, k in rows if k is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, [math.floor(256 * x) for x in v], k) for i, v, k in good]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, v, k) in enumerate(good):
        if i is None or i % every:
            continue
        met = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(good) if b != a and len(w) == len(v)]
        met.sort(key=lambda t: (-t[0], last(t[1])))
        others = [t for t in met if t[2] != k]
        for score, p, _ in [t for t in met if t[2] == k][:positives]:
            found = [t for t in others if low * score <= 100 * t[0] <= high * score][:negatives]
            out += [(i, p, rank, t[1], score, t[0]) for rank, t in enumerate(found, 1)]
    return sorted(out, key=str)


def vector_rows(n=160, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(4, 6))
    rows = [(k, [float(x) for x in np.float32(base[rng.integers(4)] + rng.normal(size=6) * 0.3)], int(rng.integers(3))) for k in range(n)]
    rows += [(k, [1.0] * 6, k % 2) for k in range(200, 230)]  # ties
    rows += [rows[10], rows[10], (None, [1.0] * 6, 0), (None, [1.0] * 6, 1), (300, [0.0] * 6, 0), (310, None, 1),
             (320, [None] * 6, 1), (330, [float("nan")] * 6, 1), (340, [float("inf")] * 6, 0), (350, [], 0), (351, [], 0),
             (352, [], 1), (360, [2.0], 0), (361, [1.0], 0), (362, [1.0], 1), (370, [1.0] * 6, None), (380, [-1.0] * 6, 2)]
    return rows


@pytest.mark.parametrize(("rows", "anchors"), [(1 << 14, 1 << 12), (16, 3)])
def test_negatives(spark, monkeypatch, rows, anchors):
    monkeypatch.setattr(hard_negatives, "ROWS", rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    data = vector_rows()
    table = spark.createDataFrame([(*r, "x", 1) for r in data],
                                  "vec_id long, embedding array<float>, label int, Anchor string, score int")
    is_anchor = F.col("vec_id") % 10 == 0
    got = sorted(map(tuple, hard_negatives.mine(table, is_anchor).collect()), key=str)
    assert got == mined(data) and len(got) > 100
    got = hard_negatives.mine(table, is_anchor, positives=3, negatives=2, low=50, high=90).collect()
    assert sorted(map(tuple, got), key=str) == mined(data, 3, 2, 50, 90)
    assert hard_negatives.mine(table.limit(0), is_anchor).count() == 0
    assert hard_negatives.mine(table, F.lit(False)).count() == 0


def test_scores_are_exact_integers():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-2**40, 2**40, (5, 7)), rng.integers(-2**20, 2**20, (9, 7))
    assert hard_negatives.exact_scores(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(u, w)) for w in b] for u in a]
    big = np.full((1, 2), 2**62)
    assert hard_negatives.exact_scores(big, big).tolist() == [[2**63 - 1]] and hard_negatives.exact_scores(big, -big).tolist() == [[1 - 2**63]]


def test_best_keeps_the_first_of_each_anchor():
    rng = np.random.default_rng(1)
    best, met = hard_negatives.Best(3), []
    for _ in range(20):
        s, ids = rng.integers(0, 5, (4, 50)), rng.permutation(1000)[:50]
        want = rng.random((4, 50)) < 0.5
        best.add(s, want, ids, ids.astype(object))
        met.append((s, want, ids))
    for i in range(4):
        plain = sorted((-s[i, j], ids[j]) for s, want, ids in met for j in np.flatnonzero(want[i]))[:3]
        mine = best.owner == i
        assert sorted(zip(-best.score[mine], best.order[mine])) == plain


# --- quality -------------------------------------------------------------------------------


def quality_table(spark, n=600):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(n):
        bad = k % 6 == 0
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.choice([30, 80, 900]))]
        if bad:
            words = [w + rng.choice(["$$$", "%%%", "!!"]) for w in words]
        rows.append((k, " ".join(words) + ".", "t"))
        if k % 2 or bad:
            marks.append((k, int(not bad), 0))
    rows += [(9000, None, "t"), (9001, "", "t"), (9001, "", "t"), (None, "some words", "t"), (9002, "x" * 300_000, "t")]
    marks += [(9000, 1, 0), (None, 1, 0), (1, None, 0), (3, 0, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, Score string"),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))


def test_quality(spark):
    docs, labels = quality_table(spark)
    model = quality.train(docs, labels)
    assert 0.7 < model.prior <= 1
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert len(unseen) > 150 and sum(r["predicted"] == (r["doc_id"] % 6 != 0) for r in unseen) >= 0.97 * len(unseen)
    again = quality.train(docs.repartition(7, "text"), labels)  # exact sums: no layout changes the model
    assert (again.weights == model.weights).all()


def test_quality_uses_no_held_out_label(spark):
    docs, labels = quality_table(spark, 200)
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels).weights == quality.train(docs, flipped).weights).all()


def test_quality_without_positives(spark):
    docs, labels = quality_table(spark, 30)
    for some in (labels.limit(0), labels.where("quality = 0")):
        assert {r["score"] for r in quality.score(docs, quality.train(docs, some)).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


def test_the_risk_stays_non_negative():
    """Where the unclipped risk of the negatives would fall below zero, the clipped one is minimised."""
    rng = np.random.default_rng(3)
    x = rng.random((40, quality.WIDTH))
    x[:, -1] = 1
    pos, unl = x[:25], x
    moments = [m.T @ m / len(m) for m in (unl, pos)]
    model = quality.fit(*moments)
    loss = lambda m, v: v @ m @ v / 4
    one = np.eye(quality.WIDTH)[-1]

    def risk(w):
        negative = loss(moments[0], one + w) - model.prior * loss(moments[1], one + w)
        return model.prior * loss(moments[1], one - w) + max(0, negative) + quality.RIDGE * w @ w

    assert all(risk(model.weights) <= risk(model.weights + d) + 1e-6 for d in rng.normal(size=(50, quality.WIDTH)) * 0.05)


# --- conversations -------------------------------------------------------------------------


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        text = "" if hit == 1 else re.sub(r"[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def plain_repair(rows):
    """Faults and cheapest edits of one conversation's ordered (turn, role, text), by a search over whole audits."""
    seen, faults, initials = set(), [], [r[:1] for _, r, _ in rows]
    for _, role, text in rows:
        left = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    counts = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
              sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, roles, kept = heapq.heappop(queue)
        state = (at, roles[-1:] if roles else "")
        if at == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return (*counts, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
        if (state, audit, cost) in done or not re.fullmatch(r"(s?(ua)*u?)?", roles):
            continue
        done.add((state, audit, cost))
        for role in ("user", "assistant"):
            if cost < 3 * len(rows) + 8:
                heapq.heappush(queue, (cost + 2, audit + "I", at, roles + role[0], (*kept, f"{role}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, roles, kept))
            if faults[at] not in ("blank", "duplicate"):
                more = int(faults[at] == "truncated")
                if role:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, roles + role[0], (*kept, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, roles + new[0], (*kept, f"{new}:{text}")))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def turn_rows(n=70):
    rng = random.Random(8)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No!", "why?  \n", "cut off", "", " \t", "é", f"t{turn}."])))
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (500, None, "user", "x."), (500, None, None, "y."), (500, 4, "user", None),
             (501, None, None, None), (502, 3, "user", "same."), (502, 3, "user", "same."), (502, 3, "assistant", "other."),
             (503, -5, "user", "q."), (503, 9, "assistant", "w" * 100_000 + ".")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, Audit string"


def test_repair_equals_a_search_over_all_edits(spark):
    rows = turn_rows()
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    for damaged in (False, True):
        turns = repair.damage(table) if damaged else table
        copies = F.col("copies") if damaged else None
        got = {r["conv_id"]: tuple(r)[1:] for r in repair.examine(turns, copies).collect()}
        texts = {}
        for r in repair.repair(turns, copies=copies).orderBy("place").collect():
            texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        left = plain_damage(rows) if damaged else plain
        key = lambda r: (r[0] is not None, r[0] or 0)
        want = {c: [] for c, *_ in rows} | {k[1] if k[0] else None: [r[1:] for r in g] for k, g in groupby(sorted(left, key=key), key=key)}
        assert set(got) == set(want)
        for conv, some in want.items():
            *report, digest = plain_repair(in_order(some)) if some else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            assert got[conv] == tuple(report), conv
            assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == digest
    assert repair.examine(table.limit(0)).count() == repair.repair(table.limit(0)).count() == 0


@pytest.mark.parametrize("spill", [1 << 20, 64, 2])
def test_backpointers_come_back_in_row_order(monkeypatch, spill):
    monkeypatch.setattr(repair, "SPILL_BYTES", spill)
    trail, plain = repair.Trail(), []
    for code, times in ((5, 1), (300, 3), (0, 500), (7, 1)):
        trail.add(code, times)
        plain += [code] * times
    assert list(trail.forward()) == plain[::-1]


def test_giant_conversation(spark):
    turns = spark.range(40_000).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 1000 == 0, "same.").otherwise(F.concat(F.col("id"), F.lit("."))).alias("text"))
    row = repair.examine(turns).collect()
    assert len(row) == 1 and row[0]["duplicate"] == 39 and len(row[0]["audit"]) >= 40_000
    assert row[0]["audit"].count("D") >= 39 and row[0]["gaps"] == row[0]["illegal"] == 0
    assert repair.repair(turns).count() == sum(c != "D" for c in row[0]["audit"])
