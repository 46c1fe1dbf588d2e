"""Repair of the structure of conversations by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.line_quality import WHITE
from quillon.llm.prefix_trie import CRC
from quillon.llm.repair_lattice import END, FAR, FOLLOWING, GONE, ROLE, START, SYSTEM, TAIL, Lattice, between
from quillon.llm.turns import in_order
from quillon.session import Scratch

SEGMENT = 256
KNOWN = 50_000
CLOSING = ".!?"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the test damage that the hash of conversation and turn chooses.

    NULL is one space. Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its closing marks, 3 repeats it,
    4 makes its role user; the others leave it as it is.
    """
    text_of = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text", "turn")}
    kind = F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), text_of["turn"])) % 20
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", CLOSING, "")).otherwise(F.col("text"))
    known = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text_of["role"].alias("role"), text_of["text"].alias("text"), kind.alias("kind"))
    left = known.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "kind")
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("copy", F.explode(twice)).select("conv_id", "turn", "role", "text")


def role_class(role: Column) -> Column:
    """s, u or a by the role's first letter, else x."""
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, t, turn, class, fault): each row's place in its conversation, and its first fault.

    Faults: ``b`` blank, ``d`` a role and text that stand earlier in the conversation, ``t`` no closing mark at the end,
    ``n`` none. Texts are compared by MD5. Only digests move; texts stay where they are.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    kind = F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(*CLOSING), "n").otherwise("t")
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), kind.alias("fault"))
    keep = ["conv_id", "turn", "role", "digest", "fault"]
    placed = scratch.keep(in_order(narrow, "conv_id", order(), keep, scratch))
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("t").alias("t")).select("conv_id", "t", F.lit(True).alias("first"))
    marked = placed.join(firsts, ["conv_id", "t"], "left")
    fault = F.when((F.col("fault") != "b") & F.col("first").isNull(), "d").otherwise(F.col("fault"))
    return scratch.keep(marked.select("conv_id", "t", "turn", role_class(F.col("role")).alias("class"), fault.alias("fault")))


def order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def repair(rows: DataFrame, scratch: Scratch, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, audit, cost, illegal, repaired_sha256) of each conversation in ``rows`` (conv_id, turn, role, text; no NULL but turn).

    Rows are taken by turn (NULL first), then by role, then by the MD5 of the text. Keep costs 0, a new role (user or
    assistant) 1, deletion 2, an inserted empty turn of either 5, and a truncated row that stays 5; blank and
    repeated rows have to go. The result's roles are nothing, or an optional system turn and pairs of user and
    assistant. Of the cheapest edits, the letters (D, I, K, R) that sort first count. A role of no class can't be kept.

    1. Conversations are cut into segments of ``segment`` rows. Where there are several, an auction gives a
       segment's costs from each state to each, and the costs behind each segment follow from the last to the first.
    2. A segment's edits from each state are the first path of tight arcs after an auction with these costs as exits.
       A path ends with the edit of the segment's last row, so the first path of the whole is the first paths in turn.
    3. Edits meet the texts in one stream per conversation, which is hashed as it passes.

    An audit, and the costs of a conversation's segments (16 numbers each), are held in one task, texts are not.
    """
    return repaired(rows, faults(rows, scratch), scratch, segment)


def repaired(rows: DataFrame, marks: DataFrame, scratch: Scratch, segment: int = SEGMENT) -> DataFrame:
    """``repair`` with the ``faults`` of the rows known."""
    code = F.when(F.col("fault").isin("b", "d"), GONE).when(F.col("fault") == "t", F.upper("class")).otherwise(F.col("class"))
    element = F.struct("t", code.alias("code"), "class")
    cut = marks.withColumn("segment", F.floor(F.col("t") / segment).cast("bigint")).groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(element)).alias("rows"))
    strings = [F.array_join(F.transform("rows", lambda r: r[c]), "").alias(n) for c, n in (("code", "codes"), ("class", "classes"))]
    segments = scratch.keep(cut.select("conv_id", "segment", *strings))
    several = scratch.keep(segments.where("segment > 0").select("conv_id").distinct())
    chained = segments.join(several, "conv_id", "left_semi").mapInArrow(_between, "conv_id bigint, segment bigint, costs array<bigint>")
    chains = chained.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "costs"))).alias("parts"))
    exits = scratch.keep(chains.mapInArrow(_behind, "conv_id bigint, segment bigint, exits array<bigint>"))
    known = segments.join(exits, ["conv_id", "segment"], "left")
    traced = known.mapInArrow(_traced, "conv_id bigint, segment bigint, classes string, edits array<string>, ends array<int>, cost bigint")
    parts = traced.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "classes", "edits", "ends", "cost"))).alias("parts"))
    audits = scratch.keep(parts.mapInArrow(_audited, "conv_id bigint, audit string, cost bigint, illegal bigint"))
    shuffle = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None)
    first = audits.select("conv_id", F.lit(0).alias("kind"), none.cast("bigint").alias("turn"), F.lit("").alias("role"), none.cast("binary").alias("digest"), F.col("audit").alias("text"))
    rest = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    stream = first.unionByName(rest).repartition(shuffle, "conv_id").sortWithinPartitions("conv_id", "kind", *order()).select("conv_id", "kind", "role", "text")
    hashes = stream.mapInArrow(_replayed, "conv_id bigint, repaired_sha256 string")
    return audits.join(hashes, "conv_id")


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list[int]] = {}
    for batch in batches:
        out = [_remembered(seen, codes, lambda: between(codes)) for codes in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "segment", "costs"])


def _remembered(seen: dict, key, make: Callable):
    if key not in seen:
        if len(seen) >= KNOWN:
            seen.clear()
        seen[key] = make()
    return seen[key]


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each state costs at the end of each segment, from the last segment to the first."""
    for batch in batches:
        for at, conv in enumerate(batch.column("conv_id").to_pylist()):
            parts = batch.column("parts")[at].as_py()
            exits, out = list(END), []
            for part in reversed(parts):
                out.append((part["segment"], list(exits)))
                exits = [min(FAR, *(part["costs"][4 * q + r] + exits[r] for r in range(4))) for q in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(out), pa.int64()), pa.array([s for s, _ in out], pa.int64()), pa.array([e for _, e in out], pa.list_(pa.int64()))], ["conv_id", "segment", "exits"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and last state of each segment from each state before it; the cost from the first segment's start."""
    seen: dict[tuple, tuple] = {}

    def solve(codes: str, exits: tuple[int, ...], first: bool) -> tuple[list[str], list[int], int]:
        lattice = Lattice(codes, exits)
        found = [lattice.trace(q) if lattice.distance(q) < FAR else ("", q) for q in ([START] if first else range(4))]
        return [e for e, _ in found], [q for _, q in found], lattice.distance(START)

    for batch in batches:
        out = []
        for codes, segment, exits in zip(*(batch.column(c).to_pylist() for c in ("codes", "segment", "exits")), strict=True):
            key = (codes, tuple(exits or END), segment == 0)
            out.append(_remembered(seen, key, lambda key=key: solve(*key)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("segment"), batch.column("classes"), pa.array([o[0] for o in out], pa.list_(pa.string())),
             pa.array([o[1] for o in out], pa.list_(pa.int32())), pa.array([o[2] for o in out], pa.int64())],
            ["conv_id", "segment", "classes", "edits", "ends", "cost"])


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in turn: the edits of each from where the one before ended, and adjacent roles that don't fit."""
    for batch in batches:
        audits, costs, illegal = [], [], []
        for i in range(batch.num_rows):
            edits, state, wrong, last = [], START, 0, ""
            parts = batch.column("parts")[i].as_py()
            for part in parts:
                edits.append(part["edits"][state])
                state = part["ends"][state]
                line = last + part["classes"]
                wrong += sum(a + b not in ("su", "ua", "au") for a, b in zip(line, line[1:], strict=False))
                last = line[-1]
            audits.append("".join(edits) + TAIL[state])
            costs.append(parts[0]["cost"])
            illegal.append(wrong)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(audits, pa.string()), pa.array(costs, pa.int64()), pa.array(illegal, pa.int64())], ["conv_id", "audit", "cost", "illegal"])


class _Repair:
    """One conversation's edits as its rows pass, and the hash of what they leave."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.empty, self.hash = audit, 0, START, True, hashlib.sha256()

    def _write(self, line: str) -> None:
        self.hash.update(line.encode() if self.empty else b"\n" + line.encode())
        self.empty = False

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, self.at = FOLLOWING[self.state], self.at + 1
            self._write(ROLE[self.state] + ":")

    def row(self, role: str, text: str) -> None:
        self.insertions()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "D":
            return
        self.state = SYSTEM if letter == "K" and role[:1] == "s" else FOLLOWING[self.state]
        self._write(f"{role if letter == 'K' else ROLE[self.state]}:{text}")

    def done(self) -> str:
        self.insertions()
        return self.hash.hexdigest()


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit comes first, then its rows."""
    conv, now = None, None
    for batch in batches:
        ids, hashes = [], []
        for i, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")), strict=True):
            if kind == 0:
                if now:
                    ids.append(conv)
                    hashes.append(now.done())
                conv, now = i, _Repair(text)
            else:
                now.row(role, text)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([now.done()], pa.string())], ["conv_id", "repaired_sha256"])


def damage_and_repair(rows: DataFrame, scratch: Scratch, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows``: what the damage did to it, and its cheapest repair.

    conv_id, gaps (turn numbers missing between the first and the last; 0 without any), blank, duplicate, truncated
    and illegal (adjacent roles that don't fit), cost, audit, repaired_sha256. A conversation that loses all its
    rows has zeros, no edits and the hash of nothing. Rows without conv_id are no conversation. Rows that repeat
    others are repeated turns. An empty table gives an empty result. Other columns are not looked at.
    """
    hurt = damaged(rows.select("conv_id", "turn", "role", "text"))
    marks = faults(hurt, scratch)
    fixed = repaired(hurt, marks, scratch, segment)
    spans = marks.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(n) for n, f in (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))])
    every = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    found = every.join(spans, "conv_id", "left").join(fixed, "conv_id", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


SQL = (
    r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, conv_id::VARCHAR || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations WHERE conv_id IS NOT NULL),
kinds AS (SELECT *, """
    + CRC.format("name")
    + r""" % 20 AS kind FROM given),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS t FROM hurt),
repeated AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY t) AS nth, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS trimmed FROM placed),
marked AS (
  SELECT conv_id, t, turn, role, text, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END AS class,
    CASE WHEN trimmed = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(trimmed, 1) IN ('.', '!', '?') THEN 'n' ELSE 't' END AS fault FROM repeated),
pairs AS (SELECT conv_id, class || lead(class) OVER (PARTITION BY conv_id ORDER BY t) AS pair FROM marked),
illegal AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE pair NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
spans AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) AS n FROM marked GROUP BY conv_id),
starts(q, letters, cost, r, added) AS (VALUES
  (0, '', 0, 0, []), (0, 'I', 5, 2, ['user:']), (0, 'II', 10, 3, ['user:', 'assistant:']), (1, '', 0, 1, []), (1, 'I', 5, 2, ['user:']), (1, 'II', 10, 3, ['user:', 'assistant:']),
  (2, '', 0, 2, []), (2, 'I', 5, 3, ['assistant:']), (2, 'II', 10, 2, ['assistant:', 'user:']), (3, '', 0, 3, []), (3, 'I', 5, 2, ['user:']), (3, 'II', 10, 3, ['user:', 'assistant:'])),
edits AS (
  SELECT conv_id, t, q, letters || 'D' AS letters, cost + 2 AS cost, r AS next, added FROM marked, starts
  UNION ALL
  SELECT conv_id, t, q, letters || 'K', cost + CASE fault WHEN 't' THEN 5 ELSE 0 END, CASE WHEN class = 's' THEN 1 WHEN r = 2 THEN 3 ELSE 2 END, list_append(added, role || ':' || text)
  FROM marked, starts WHERE fault IN ('n', 't') AND ((class = 's' AND r = 0) OR class = CASE r WHEN 2 THEN 'a' ELSE 'u' END)
  UNION ALL
  SELECT conv_id, t, q, letters || 'R', cost + 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END, CASE WHEN r = 2 THEN 3 ELSE 2 END, list_append(added, CASE WHEN r = 2 THEN 'assistant:' ELSE 'user:' END || text)
  FROM marked, starts WHERE fault IN ('n', 't')),
best AS (
  SELECT conv_id, 0::BIGINT AS t, 0 AS q, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS way FROM spans
  UNION ALL
  SELECT b.conv_id, b.t + 1, e.next, min({'cost': b.way.cost + e.cost, 'audit': b.way.audit || e.letters, 'lines': list_concat(b.way.lines, e.added)})
  FROM best b JOIN edits e ON e.conv_id = b.conv_id AND e.t = b.t AND e.q = b.q GROUP BY b.conv_id, b.t, e.next),
ends(q, tail, cost, added) AS (VALUES (0, '', 0, []), (1, 'II', 10, ['user:', 'assistant:']), (2, 'I', 5, ['assistant:']), (3, '', 0, [])),
done AS (
  SELECT conv_id, min({'cost': b.way.cost + e.cost, 'audit': b.way.audit || tail, 'lines': list_concat(b.way.lines, added)}) AS way
  FROM best b JOIN spans USING (conv_id) JOIN ends e USING (q) WHERE b.t = spans.n GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost, coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM given) c LEFT JOIN spans USING (conv_id) LEFT JOIN illegal USING (conv_id) LEFT JOIN done USING (conv_id)
""")
