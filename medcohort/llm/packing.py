"""Best-two-fit packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import STEP_BYTES, fresh, map_arrow, materialise, read_table, ship_code, steps

MAX_TOKENS = 4096
END_ID = 1
#: Pieces that one packing task gets on average. Every group ends with at most one poorly filled sequence.
GROUP_PIECES = 50_000
#: Copies of an equal row that are numbered at once.
COPIES_AT_ONCE = 1000
#: Word parts that a Python worker remembers in each of two generations: once the new one is full it becomes the old
#: one, and parts met again move to the new one (a bound on memory, about 20 MB, not on the input).
CACHE_PARTS = 60_000
#: Chunks that a Python worker remembers between steps, those met last, and the most bytes of one (a bound on memory, about
#: 5 MB, not on the input).
KNOWN_CHUNKS = 100_000
KNOWN_BYTES = 32
#: Bytes of text whose distinct chunks are looked up at once; the ids are then written out by ``STEP_BYTES``.
CODED_BYTES = 4 * STEP_BYTES
#: New words that are given to the tokenizer in one call.
WORDS_AT_ONCE = 10_000
#: Letters below U+0250 only, without U+0130, whose small form is two characters.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
#: Marks that are a part of their own between an ASCII letter and white space.
MARKS = np.isin(np.arange(256), list(b".,;:!?"))
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _visible_bytes() -> dict[int, int]:
    """How byte-level BPE writes a byte (as Latin-1): printable ones as themselves, the rest as 256, 257, ..."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return {b: 256 + k for k, b in enumerate(hidden)}


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of all spans, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places), dtype=np.int64)
    return places


def _apart(texts: pa.Array) -> pa.Array:
    """Texts of the same ids with fewer different chunks: a blank before a mark that ends a word, and A-Z in lower case.

    A letter stays if no ASCII byte follows (the normaliser composes before it lower-cases), and so do all letters if
    the texts may have a special token, which is met in the case given.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    if offsets[0] == offsets[-1]:
        return texts
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]: offsets[-1]].copy()
    offsets = offsets - offsets[0]
    gaps = np.flatnonzero((raw == 32) | (raw - np.uint8(9) < 5))
    gaps = gaps[gaps > 1]
    ends = gaps[MARKS[raw[gaps - 1]] & ((raw[gaps - 2] | 32) - np.uint8(97) < 26)] - 1
    if not np.any((raw[:-1] == ord("<")) & (raw[1:] == ord("|"))):
        upper = np.flatnonzero(raw[:-1] - np.uint8(65) < 26)
        raw[upper[raw[upper + 1] < 128]] += 32
    raw = np.insert(raw, ends, 32)
    offsets = offsets + np.searchsorted(ends, offsets)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


class ChunkTokenizer:
    """Token ids of texts, chunk by chunk.

    Texts are cut at blanks, tabs and line ends, which the tokenizer drops and across which it joins nothing, so
    the ids of a text are those of its chunks in order. Chunks of printable Latin letters, which the tokenizer's
    normaliser only lower-cases, are cut by the tokenizer's own pattern and only unseen parts go to its model; all
    others go to the whole tokenizer. Each step hands its new chunks of letters to the tokenizer's model together. Short
    chunks are remembered with their ids in Arrow and numpy arrays, so only those not met lately are encoded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        cuts = json.loads(self.whole.pre_tokenizer.__getstate__())["pretokenizers"][0]["pattern"]["Regex"]
        self.cut = regex.compile(cuts).findall
        self.visible = _visible_bytes()
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # for words of small ASCII letters, and of other letters, with blanks between them
        self.plain, self.latin = Tokenizer(self.model), Tokenizer(self.model)
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.latin.normalizer = normalizers.Lowercase()
        self.latin.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # a word's last id, and no other, carries the suffix
        self.last[[k for token, k in vocabulary.items() if token.endswith(self.model.end_of_word_suffix)]] = True
        self.chunks = pa.array([], pa.large_string())
        self.ids = np.zeros(0, np.uint32)  # of all remembered chunks, one after the other
        self.sizes = np.zeros(0, np.int32)
        self.met = np.zeros(0, np.int32)  # the last step that had the chunk
        self.step = 0

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.older.get(part)
            if ids is None:
                shown = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(self.visible)
                ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.parts) >= CACHE_PARTS:
                self.parts, self.older = {}, self.parts
            self.parts[part] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        if chunk and (chunk.isascii() or max(chunk) < "\u0250"):
            low = chunk.lower()
            if low.isalpha():  # letters are one part, and so is a mark after them
                return self.part(low)
            if low[-1] in ".,;:!?" and low[:-1].isalpha():
                return self.part(low[:-1]) + self.part(low[-1])
            if chunk.isprintable() and "<|" not in chunk:
                return b"".join(map(self.part, self.cut(low)))
        return array("I", self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()

    def new_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks not met before: all ids, and where those of each chunk begin and how many they are."""
        letters = pc.match_substring_regex(chunks, LETTERS)
        rest = [self.chunk(c) for c in chunks.filter(pc.invert(letters)).to_pylist()]
        kinds = [(self.plain, pc.ascii_lower(chunks), pc.and_(letters, pc.string_is_ascii(chunks))),
                 (self.latin, chunks, pc.and_not(letters, pc.string_is_ascii(chunks)))]
        ids, sizes = [np.frombuffer(b"".join(rest), np.uint32)], np.zeros(len(chunks), np.int32)
        starts = np.zeros(len(chunks), np.int64)
        where = np.flatnonzero(~letters.to_numpy(zero_copy_only=False))
        sizes[where] = np.fromiter(map(len, rest), np.int32, len(rest)) // 4
        starts[where] = np.cumsum(sizes[where]) - sizes[where]
        done = len(ids[0])
        for tokenizer, shown, mask in kinds:
            where = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
            shown = shown.filter(mask)
            for k in range(0, len(where), WORDS_AT_ONCE):
                joined = " ".join(shown[k: k + WORDS_AT_ONCE].to_pylist())
                part = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                size = np.diff(np.flatnonzero(self.last[part]), prepend=-1)
                sizes[where[k: k + WORDS_AT_ONCE]] = size
                starts[where[k: k + WORDS_AT_ONCE]] = done + np.cumsum(size) - size
                ids.append(part)
                done += len(part)
        return np.concatenate(ids), starts, sizes

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every word's chunk number; all ids, and where those of each chunk begin and how many they are."""
        had = len(self.chunks)
        coded = pa.concat_arrays([self.chunks, words]).dictionary_encode()  # remembered chunks keep their numbers
        chunks, at = coded.dictionary, coded.indices.to_numpy()[had:]
        ids, starts, sizes = self.new_ids(chunks[had:])
        starts = np.concatenate([np.cumsum(self.sizes, dtype=np.int64) - self.sizes, starts + len(self.ids)])
        ids, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])

        self.step += 1
        met = np.concatenate([self.met, np.zeros(len(chunks) - had, np.int32)])
        met[at] = self.step
        met[pc.greater(pc.binary_length(chunks), KNOWN_BYTES).to_numpy(zero_copy_only=False)] = 0
        keep = np.argsort(-met, kind="stable")[:KNOWN_CHUNKS]
        keep = keep[met[keep] > 0]
        self.chunks, self.met, self.sizes = chunks.take(pa.array(keep)), met[keep], sizes[keep]
        self.ids = ids[_places(starts[keep], sizes[keep])]
        return at, ids, starts, sizes

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(_apart(texts.cast(pa.large_string()).fill_null("")))
        at, ids, starts, sizes = self.look_up(split.flatten())
        stops = split.offsets.to_numpy()
        stops = stops - stops[0]
        for a, b in steps(texts):
            here = at[stops[a]: stops[b]]
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[here], dtype=np.int64)])
            tokens = ids[_places(starts[here], sizes[here])]
            cuts = ends[stops[a: b + 1] - stops[a]]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                yield tokens[first:last]


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def _tokenizer(path: str) -> ChunkTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def _piece_rows(batches, tokenizer_path: str, max_tokens: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _tokenizer(tokenizer_path)
    for batch in batches:
        ids, text = batch.column(0).to_pylist(), batch.column(1)
        for a, b in steps(text, CODED_BYTES):
            part = text.slice(a, b - a)
            coded = encoder.encode(part)
            for c, d in steps(part):
                rows = []
                for doc, tokens in zip(ids[a + c: a + d], coded, strict=False):
                    data = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(data), max_tokens)):
                        piece = data[start: start + max_tokens]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                                    (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``max_tokens`` ids, the document's end id included (null text: empty)."""

    def run(batches):
        yield from _piece_rows(batches, tokenizer_path, max_tokens, end_id)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECE_SCHEMA)


class _Pool:
    """The unpacked lengths as bit sets: bit ``n`` is set while a piece of ``n`` tokens is left."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        order = np.argsort(lengths, kind="stable")
        cuts = np.searchsorted(lengths[order], np.arange(capacity + 2))
        self.rows = [order[cuts[n]: cuts[n + 1]].tolist() for n in range(capacity + 1)]
        self.bits = sum(1 << n for n in range(capacity + 1) if self.rows[n])
        self.mirror = sum(1 << (capacity - n) for n in range(capacity + 1) if self.rows[n])

    def largest(self, at_most: int) -> int:
        return (self.bits & ((1 << (at_most + 1)) - 1)).bit_length() - 1

    def take(self, n: int) -> int:
        row = self.rows[n].pop()
        if not self.rows[n]:
            self.bits ^= 1 << n
            self.mirror ^= 1 << (self.capacity - n)
        return row

    def put(self, n: int, row: int) -> None:
        if not self.rows[n]:
            self.bits ^= 1 << n
            self.mirror ^= 1 << (self.capacity - n)
        self.rows[n].append(row)

    def pair(self, at_most: int, over: int) -> tuple[int, int] | None:
        """Two unpacked lengths with the largest sum in ``over + 1 .. at_most``."""
        for total in range(at_most, over, -1):
            both = self.bits & (self.mirror >> (self.capacity - total))
            while both:
                n = both.bit_length() - 1
                if n * 2 != total or len(self.rows[n]) > 1:
                    return n, total - n
                both ^= 1 << n
        return None


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of row numbers. Fill a bin greedily with the largest piece that fits, until none does; then, if two
    unpacked pieces fill the room of its smallest piece and the gap more tightly, swap them in."""
    pool, bins = _Pool(lengths, capacity), []
    while pool.bits:
        rows, gap = [], capacity
        while gap > 0 and (n := pool.largest(gap)) > 0:
            rows.append(pool.take(n))
            gap -= n
        if gap and len(rows) > 1:
            small = int(lengths[rows[-1]])
            if found := pool.pair(gap + small, small):
                pool.put(small, rows.pop())
                rows += [pool.take(n) for n in found]
        bins.append(rows)
    return bins


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place every row of ``pieces`` (with ``doc_id``, ``piece``, ``length`` in 1 .. ``max_tokens``).

    Rows are dealt by hash over groups of about ``group_pieces`` rows; each group is packed by itself, so memory is
    bounded at any size, and the packing depends on the rows alone. Equal rows are counted first and each is dealt with
    its number among them, so a row repeated any number of times is spread over all groups.
    """
    ship_code(pieces.sparkSession)
    groups = max(1, -(-pieces.count() // group_pieces))
    columns = pieces.columns
    times, copy = fresh(pieces, "_times", "_copy")
    dealt = (pieces.groupBy(*columns).agg(F.count(F.lit(1)).alias(times))
             .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / COPIES_AT_ONCE))))
             .withColumn(copy, F.explode(F.sequence(F.col(copy) * COPIES_AT_ONCE, F.least(
                 F.col(times), (F.col(copy) + 1) * COPIES_AT_ONCE) - 1)))
             .withColumn("_group", F.pmod(F.xxhash64(*columns, copy), F.lit(groups))).drop(times, copy))

    def run(key, frame):
        frame = frame.sort_values(["length", "doc_id", "piece"], kind="stable", ignore_index=True)
        bins = best_two_fit(frame["length"].to_numpy(), max_tokens)
        rows = np.array([r for b in bins for r in b], np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = frame.iloc[rows][columns].reset_index(drop=True)
        ends = out["length"].cumsum()
        out["sequence_id"] = number * groups + int(key[0])
        begin = ends - out["length"]
        out["offset"] = begin - begin.groupby(number).transform("min")
        return out

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Tokenise documents, cut only those longer than ``max_tokens`` and pack the pieces by best-two-fit.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is its end id alone.
    Repeated rows are packed one by one; ties in length are broken by doc_id and piece. Other columns are not
    read. An empty table gives an empty result.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return pack(materialise(tokenised_pieces(docs, tokenizer_path, max_tokens), "pieces"), max_tokens)


def op2_best_fit_packing(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"))
