"""Conversation structure repair: cheapest edits to well-formed turns, streamed in turn order."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medcohort.llm.common import give_back, map_arrow, materialise, read_table, ship_code

#: ASCII white space; the characters that end a text; what a row's own text says of it.
SPACE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
SOUND, TRUNCATED, BLANK = 0, 1, 2
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: States: nothing yet, after a leading system turn, after a user, after an assistant. The next role that fits is the
#: user's, but the assistant's after a user; a system turn fits at the start only.
NEXT = (2, 2, 3, 2)
INITIALS, ROLES = ("u", "u", "a", "u"), ("user", "user", "assistant", "user")
#: Costs of what must still be inserted after the last row, by state.
TAIL = (0, 2 * INSERT, INSERT, 0)
MOVES = "DIKR"  # in ASCII order, so the first cheapest one gives the least text of edits
_SYSTEM = 1 << 8
#: Backpointers of one conversation kept in memory before they go to an unnamed file; rows of an output frame.
SPILL_BYTES, FRAME_ROWS = 1 << 20, 4096
REPORT = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class Trail:
    """Backpointers of a conversation, written last row first and read first row first: two bytes a row."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)  # unnamed: gone with the task, lost or not
        self.part: list[int] = []

    def add(self, code: int, times: int = 1) -> None:
        while times:
            now = min(times, SPILL_BYTES)
            self.part += [code] * now
            times -= now
            if len(self.part) >= SPILL_BYTES // 2:
                self.flush()

    def flush(self) -> None:
        self.file.write(np.array(self.part, np.uint16).tobytes())
        self.part = []

    def forward(self) -> Iterator[int]:
        self.flush()
        end = self.file.tell()
        while end:
            begin = max(0, end - SPILL_BYTES)
            self.file.seek(begin)
            yield from np.frombuffer(self.file.read(end - begin), np.uint16)[::-1].tolist()
            end = begin
        self.file.close()


_known: dict[tuple, tuple] = {}


def step(ahead: tuple, initial: str, truncated: int) -> tuple[tuple, int, int]:
    """Costs to the end before a row from those after it: (costs less their least, their least, backpointers).

    A state's two bits of the backpointers name its first cheapest move in ASCII order; a ninth bit says that a kept
    row is a system one. Costs differ by a few units between states, so there are few distinct steps to work out.
    """
    key = (ahead, initial, truncated)
    if key in _known:
        return _known[key]
    moves = []
    for state in range(4):
        kept = 1 if state == 0 and initial == "s" else NEXT[state] if initial == INITIALS[state] else None
        moves.append([DELETE + ahead[state], None, None if kept is None else KEEP + truncated + ahead[kept],
                      REROLE + truncated + ahead[NEXT[state]]])
    alone = [min(c for c in m if c is not None) for m in moves]
    costs = list(alone)
    for _ in range(3):  # insertions: the longest useful chain has two
        costs = [min(alone[s], INSERT + costs[NEXT[s]]) for s in range(4)]
    code = _SYSTEM if initial == "s" else 0
    for state, m in enumerate(moves):
        m[1] = INSERT + costs[NEXT[state]]
        code |= m.index(costs[state]) << 2 * state
    least = min(costs)
    _known[key] = tuple(c - least for c in costs), least, code
    return _known[key]


def walk(codes: Iterator[int]) -> str:
    """The edits' initials, from the start state along the backpointers."""
    state, out = 0, bytearray()
    for code in codes:
        move = 1
        while move == 1:
            move = code >> 2 * state & 3
            out.append(ord(MOVES[move]))
            if move == 1:
                state = NEXT[state]
        if move:
            state = 1 if move == 2 and state == 0 and code & _SYSTEM else NEXT[state]
    return (out + b"I" * (TAIL[state] // INSERT)).decode()


class Conversation:
    """State carried over a conversation's rows, which come last first."""

    def __init__(self, conv):
        self.conv, self.trail, self.costs, self.cost = conv, Trail(), TAIL, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.first = self.after = None

    def row(self, known: bool, turn: int, initial: str, fault: int, copies: int, first: bool) -> None:
        """``copies`` equal rows; only the first of them is no duplicate, and only if ``first``."""
        if known and (self.first is None or turn != self.first):
            self.turns, self.first = self.turns + 1, turn
            self.last = turn if self.last is None else self.last
        sound = int(first and fault != BLANK)
        if fault == BLANK:
            self.blank += copies
        else:
            self.duplicate += copies - sound
        if self.after is not None:
            self.illegal += initial + self.after not in ("su", "ua", "au")
        self.illegal += copies - 1  # two equal initials
        self.after = initial
        if copies > sound:
            self.cost += DELETE * (copies - sound)
            self.trail.add(0, copies - sound)
        if sound:
            self.truncated += fault == TRUNCATED
            self.costs, more, code = step(self.costs, initial, int(fault == TRUNCATED))
            self.cost += more
            self.trail.add(code)

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, min(gaps, (1 << 63) - 1), self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + self.costs[0], walk(self.trail.forward()))


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= FRAME_ROWS or size > 1 << 22:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    yield pd.DataFrame(held, columns=columns)
    give_back()


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def reports():
        now = None
        for frame in frames:
            for conv, *row in zip(*(frame[c].tolist() for c in frame.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        yield now.report()
                    now = Conversation(conv)
                if row[4]:
                    now.row(*row)
        if now is not None:
            yield now.report()

    return _frames(reports(), [c.split()[0] for c in REPORT.split(", ")])


def _turns(turns: DataFrame, copies: Column) -> DataFrame:
    """Rows with their conversation as text, null roles and texts as one blank, and what the text says."""
    rows = turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        copies.alias("copies"))
    seen = F.rtrim("text", F.lit(SPACE))
    fault = F.when(seen == "", BLANK).when(~F.substring(seen, -1, 1).isin(*ENDS), TRUNCATED).otherwise(SOUND)
    return rows.withColumn("fault", fault).withColumn("digest", F.md5("text"))


def examine(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conversation: its faults and the cheapest edits.

    ``turns`` has conv_id, turn, role and text; ``copies`` counts a row as so many adjacent equal rows (0: it only
    names its conversation). Rows go by turn (nulls first); those of one turn by role, then by the MD5 of their text,
    so the result does not depend on the layout. Null roles and texts count as one blank. A null conv_id is one
    conversation. A role that is empty has no initial: it can't be kept.

    First rows of equal role and text are minima by key, equal rows are counted, both before the narrow rows (no
    texts) are dealt by conversation and sorted by falling turn. ``mapInPandas`` carries the costs to the end of the
    four grammar states across batches; its backpointers, two bytes a row, spill to an unnamed file of the task when a
    conversation is giant, and are walked from the first row on.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    kind = turns.schema["conv_id"].dataType
    rows = _turns(turns, F.lit(1) if copies is None else copies).drop("text")
    live = F.col("copies") > 0
    place = ["conv", "turn", "role", "digest", "fault"]
    counted = rows.select("conv", *(F.when(live, F.col(c)).alias(c) for c in place[1:]), F.col("copies").cast("long").alias("copies"))
    counted = counted.groupBy(*place).agg(F.sum("copies").alias("copies")).withColumn("first", F.lit(False))
    firsts = rows.where(live).groupBy("conv", "role", "digest", "fault").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("at"))
    firsts = firsts.select("conv", F.col("at.turn").alias("turn"), "role", "digest", "fault",
                           F.lit(0).cast("long").alias("copies"), F.lit(True).alias("first"))
    rows = counted.unionByName(firsts).groupBy(*place).agg(F.sum("copies").alias("copies"), F.max("first").alias("first"))
    rows = rows.repartition("conv").sortWithinPartitions(
        "conv", F.desc_nulls_last("turn"), F.desc_nulls_last("role"), F.desc_nulls_last("digest"))
    rows = rows.select("conv", F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("turn"),
                       F.coalesce(F.substring("role", 1, 1), F.lit("")).alias("initial"),
                       F.coalesce("fault", F.lit(SOUND)).alias("fault"), "copies", "first")
    ship_code(turns.sparkSession)
    found = rows.mapInPandas(_reports, REPORT)
    return found.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", "conv_id")


def _edits(batches) -> Iterator[tuple]:
    """(conv, edit, role, text) of the rows that stay or come in, conversation by conversation; first (conv, None...)."""
    conv, audit, at, state = None, "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield conv, "I", ROLES[state], ""
            at, state = at + 1, NEXT[state]

    for batch in batches:
        for own, plan, role, text, copies in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if plan is not None:  # the conversation's audit comes before its rows
                yield from inserts()
                conv, audit, at, state = own, plan, 0, 0
                yield conv, None, None, None
                continue
            for _ in range(copies):
                yield from inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    yield conv, edit, role, text
                    state = 1 if state == 0 and role[0] == "s" else NEXT[state]
                elif edit == "R":
                    yield conv, edit, ROLES[state], text
                    state = NEXT[state]
    yield from inserts()


def _repaired(batches):
    def placed():
        place = 0
        for conv, edit, role, text in _edits(batches):
            place = 0 if edit is None else place + 1
            if edit is not None:
                yield conv, place, edit, role, text

    schema = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    for frame in _frames(placed(), schema.names):
        yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)


def _digests(batches):
    done, now = [], None
    for conv, edit, role, text in _edits(batches):
        if edit is None:
            if now:
                done.append((now[0], now[1].hexdigest()))
            now = [conv, hashlib.sha256(), b""]
        else:
            now[1].update(now[2] + role.encode("utf-8", "surrogatepass") + b":" + text.encode("utf-8", "surrogatepass"))
            now[2] = b"\n"
    if now:
        done.append((now[0], now[1].hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], ["conv", "repaired_sha256"])


def _followed(turns: DataFrame, report: DataFrame, copies: Column | None, function, schema: str) -> DataFrame:
    """Each conversation's audit, then its rows in turn order, as one stream: texts are shuffled once, never gathered."""
    rows = _turns(turns, F.lit(1) if copies is None else copies).where("copies > 0").withColumn("audit", F.lit(None).cast("string"))
    plan = report.select(F.col("conv_id").cast("string").alias("conv"), "audit")
    both = rows.unionByName(plan, allowMissingColumns=True).repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest")
    return map_arrow(both.select("conv", "audit", "role", "text", "copies"), function, schema)


def repair(turns: DataFrame, report: DataFrame | None = None, copies: Column | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, place from 1, edit, role, text) of every row kept, reroled or inserted.

    ``report`` is :func:`examine`'s result for the same rows. Inserted rows have an empty text.
    """
    report = examine(turns, copies) if report is None else report
    out = _followed(turns, materialise(report, "conv-report"), copies, _repaired,
                    "conv string, place long, edit string, role string, text string")
    return out.withColumn("conv", F.col("conv").cast(turns.schema["conv_id"].dataType)).withColumnRenamed("conv", "conv_id")


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn, with ``copies`` (0: dropped, 2: repeated)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    by = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    return turns.select("conv_id", "turn", by.alias("by"), blank("role").alias("role"), blank("text").alias("text")).select(
        "conv_id", "turn", F.when(F.col("by") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("by") == 0, 0).when(F.col("by") == 3, 2).otherwise(1).alias("copies"))


def op13_conversation_repair(spark, sf_dir):
    turns = damage(read_table(spark, sf_dir, "conversations"))
    copies = F.col("copies")
    report = materialise(examine(turns, copies), "conv-report")
    digests = _followed(turns, report, copies, _digests, "conv string, repaired_sha256 string")
    same = F.col("conv_id").cast("string").eqNullSafe(F.col("conv"))
    return report.join(digests, same).drop("conv")


#: The same by recursion in SQL: CRC-32 bit by bit, costs to the end from the last row back, then the cheapest moves.
ORACLE = """
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_reduce(
    flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                           lambda c: list_transform(range(8), lambda k: (ord(c)::BIGINT >> k::INTEGER) & 1))),
    lambda crc, bit: xor(crc >> 1, CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT) AS crc
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, xor(crc, 4294967295) % 20 AS hit FROM source), unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen
  FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN seen = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM ordered),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
costs AS (
  SELECT conv_id, n + 1 AS pos, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3, NULL::VARCHAR[] AS moves FROM counts
  UNION ALL
  SELECT conv_id, pos, c0, c1, c2, c3, [
    CASE WHEN d0 = c0 THEN 'D' WHEN 2 + c2 = c0 THEN 'I' WHEN k0 = c0 THEN 'K' ELSE 'R' END,
    CASE WHEN d1 = c1 THEN 'D' WHEN 2 + c2 = c1 THEN 'I' WHEN k1 = c1 THEN 'K' ELSE 'R' END,
    CASE WHEN d2 = c2 THEN 'D' WHEN 2 + c3 = c2 THEN 'I' WHEN k2 = c2 THEN 'K' ELSE 'R' END,
    CASE WHEN d3 = c3 THEN 'D' WHEN 2 + c2 = c3 THEN 'I' WHEN k3 = c3 THEN 'K' ELSE 'R' END]
  FROM (
    SELECT *, least(b0, 2 + b2, 4 + b3) AS c0, least(b1, 2 + b2, 4 + b3) AS c1, least(b2, 2 + b3) AS c2, least(b3, 2 + b2) AS c3
    FROM (
      SELECT *, least(d0, k0, r0) AS b0, least(d1, k1, r1) AS b1, least(d2, k2, r2) AS b2, least(d3, k3, r3) AS b3
      FROM (
        SELECT f.conv_id, f.pos, 3 + c0 AS d0, 3 + c1 AS d1, 3 + c2 AS d2, 3 + c3 AS d3,
               CASE WHEN gone THEN 1e9 WHEN initial = 's' THEN t + c1 WHEN initial = 'u' THEN t + c2 ELSE 1e9 END::BIGINT AS k0,
               CASE WHEN NOT gone AND initial = 'u' THEN t + c2 ELSE 1e9 END::BIGINT AS k1,
               CASE WHEN NOT gone AND initial = 'a' THEN t + c3 ELSE 1e9 END::BIGINT AS k2,
               CASE WHEN NOT gone AND initial = 'u' THEN t + c2 ELSE 1e9 END::BIGINT AS k3,
               CASE WHEN gone THEN 1e9 ELSE 2 + t + c2 END::BIGINT AS r0, CASE WHEN gone THEN 1e9 ELSE 2 + t + c2 END::BIGINT AS r1,
               CASE WHEN gone THEN 1e9 ELSE 2 + t + c3 END::BIGINT AS r2, CASE WHEN gone THEN 1e9 ELSE 2 + t + c2 END::BIGINT AS r3
        FROM costs c JOIN (SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INTEGER AS t FROM faulty) f
          ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.pos = c.pos - 1)))),
edited AS (
  SELECT conv_id, 1::BIGINT AS pos, 0 AS state, '' AS audit, NULL::VARCHAR AS repaired FROM counts
  UNION ALL
  SELECT e.conv_id, CASE WHEN move = 'I' THEN e.pos ELSE e.pos + 1 END,
         CASE WHEN move = 'D' THEN e.state WHEN move = 'K' AND e.state = 0 AND initial = 's' THEN 1 WHEN e.state = 2 THEN 3 ELSE 2 END,
         audit || move, CASE move WHEN 'D' THEN repaired
           ELSE coalesce(repaired || chr(10), '') || CASE WHEN move = 'K' THEN role WHEN e.state = 2 THEN 'assistant' ELSE 'user' END
                || ':' || CASE WHEN move = 'I' THEN '' ELSE text END END
  FROM (
    SELECT e.*, CASE WHEN e.pos <= n THEN c.moves[e.state + 1] WHEN e.state IN (1, 2) THEN 'I' END AS move, f.initial, f.role, f.text
    FROM edited e JOIN counts s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN costs c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.pos = e.pos
    LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.pos = e.pos) e
  WHERE move IS NOT NULL)
SELECT o.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(c.c0, 0)::BIGINT AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(e.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN costs c ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND c.pos = 1
LEFT JOIN (SELECT * FROM edited WHERE pos > 0 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(audit) DESC) = 1) e
  ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
