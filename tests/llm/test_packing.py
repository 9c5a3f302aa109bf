"""Tokenised pieces against the whole tokenizer; packing laws; the greedy step."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from medcohort.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcXYZ'sS'tT<|endoftext|>  \n\t\r\x0b\x0c\x1c\x85\xa0 éÉñßİıſΣσςǺ̀ﬁ１２3²½_-.,!ÀÖ×÷ǅªº漢字🙂‍\x00\xad"


def test_chunks_give_the_tokenizers_ids():
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["<|startoftext|>a <|endoftext|>", "", " ", "don't we'll I'M", None]
    coder, whole = packing.ChunkTokenizer(PATH), Tokenizer.from_file(PATH)
    for text, ids in zip(texts, coder.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_pieces_and_sequences(spark):
    rng = random.Random(2)
    words = ["alpha", "beta,", "Gamma", "d'or", "42"]
    texts = [None, "", "one", "two words", "one"] + [" ".join(rng.choices(words, k=rng.randrange(1, 900))) for _ in range(60)]
    texts.append(" ".join(rng.choices(words, k=9000)))
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, Offset string")
    got = packing.pack_documents(docs).collect()
    whole, want = Tokenizer.from_file(PATH), {}
    for k, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for n, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            want[k, n] = (a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= -(-sum(r["length"] for r in got) // 4096) + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_two_documents_replace_the_smallest():
    # greedy: 6 + 3 leaves a gap of 1; 3 goes back for 2 + 2, which fill the bin
    bins = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sorted(bins[0]) == [0, 2, 3] and bins[1] == [1]


def test_bins_hold_every_row_once():
    rng = np.random.default_rng(3)
    for capacity in (1, 7, 100):
        lengths = rng.integers(1, capacity + 1, 400)
        bins = packing.best_two_fit(lengths, capacity)
        assert sorted(r for b in bins for r in b) == list(range(400))
        assert all(lengths[b].sum() <= capacity for b in bins)


def test_many_groups(spark):
    pieces = spark.range(300).selectExpr("id as doc_id", "0 as piece", "0L as start", "id % 90 + 1 as length", "0L as ids_crc32")
    got = packing.pack(pieces, 100, group_pieces=50).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in got) == sum(k % 90 + 1 for k in range(300)) and max(r[1] for r in got) <= 100


def test_repeated_rows_and_null_ids_are_spread_over_groups(spark):
    same = spark.range(2500).selectExpr("cast(null as long) as doc_id", "0 as piece", "0L as start", "7L as length", "5L as ids_crc32")
    other = spark.range(500).selectExpr("3L as doc_id", "cast(id % 5 as int) as piece", "0L as start", "id % 50 + 1 as length", "0L as ids_crc32")
    pieces = same.union(other)
    got = packing.pack(pieces, 100, group_pieces=100).collect()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted([str(tuple(r[k] for k in key)) for r in got]) == sorted(str(tuple(r)) for r in pieces.collect())
    groups, places = {}, {}
    for r in got:
        groups[r["sequence_id"] % 30] = groups.get(r["sequence_id"] % 30, 0) + 1
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(groups) == 30 and max(groups.values()) < 200
    for place in places.values():
        place.sort()
        assert [a for a, _ in place] == [sum(n for _, n in place[:k]) for k in range(len(place))] and sum(n for _, n in place) <= 100


def test_documents_with_null_and_repeated_ids(spark):
    rows = [(None, None), (None, None), (None, "a b"), (1, "a b"), (1, "a b"), (1, "c"), (2, "word " * 5000), (None, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack_documents(docs).collect()
    whole = Tokenizer.from_file(PATH)
    size = [len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sum(r["length"] for r in got) == sum(size) and len(got) == sum(-(-n // 4096) for n in size)
    assert sum(r["doc_id"] is None for r in got) == 3 + -(-size[-1] // 4096)


def test_a_task_works_in_small_steps_and_forgets_word_parts():
    rng = random.Random(8)
    seen = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(250)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": seen})
    out = list(packing._piece_rows(iter([batch]), PATH, 4096, 1))
    assert [k for b in out for k, piece in zip(b["doc_id"].to_pylist(), b["piece"].to_pylist()) if not piece] == list(range(2000))
    assert len(out) >= 4  # five MB of text
    encoder = packing._tokenizer(PATH)
    assert len(encoder.parts) + len(encoder.older) <= 2 * (60_000 + (1 << 20) // 10)


def test_chunks_of_letters_are_encoded_together_and_remembered(monkeypatch):
    coder, whole, calls, batches = packing.ChunkTokenizer(PATH), Tokenizer.from_file(PATH), [], []
    chunk = coder.chunk
    monkeypatch.setattr(coder, "chunk", lambda c: calls.append(c) or chunk(c))
    texts = pa.array(["Une école, the words. And words", None, "The Words and: ÉCOLE d'or 42"]).slice(0, 3)
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [ids.tolist() for ids in coder.encode(texts)] == want
    assert set(calls) <= {",", ".", ":", "d'or", "42", ""}  # one call for each different chunk before
    new_ids = coder.new_ids
    monkeypatch.setattr(coder, "new_ids", lambda c: batches.append(c.to_pylist()) or new_ids(c))
    assert [ids.tolist() for ids in coder.encode(texts.slice(1))] == want[1:] and batches == [[]]


def test_forgotten_chunks_and_odd_letters_give_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_CHUNKS", 20)
    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 3)
    rng, coder, whole = random.Random(9), packing.ChunkTokenizer(PATH), Tokenizer.from_file(PATH)
    odd = ["<|ENDOFTEXT|>", "<|endoftext|>", "H\u0331", "h\u0331", "A.\u0301", "ΑΣ.", "aΣ", "aΣ. Σ", "İI.", "ıJ̌", "a.", "A", ".", "B..", "c;Ω", "x" * 40]
    words = odd + ["".join(rng.choices("abcDEFéÉœŒ", k=rng.randrange(1, 5))) for _ in range(60)]
    for with_special in (True, False):
        for _ in range(40):
            texts = [rng.choice(["", " "]).join(rng.choices(words[2 * (not with_special):], k=rng.randrange(9))) for _ in range(12)]
            texts = pa.array([*texts, None, "\u0331", ". A"]).slice(rng.randrange(3))
            for text, ids in zip(texts.to_pylist(), coder.encode(texts), strict=True):
                assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
            assert len(coder.chunks) <= 20 and len(coder.ids) == coder.sizes.sum()
