"""Conversation structure repair: the cheapest edits that make each conversation's roles follow ``(s?(ua)+)?``.

Edits: Keep a row (0), Rerole it to user or assistant (3), Delete it (4; blank and duplicate rows have to go), Insert an
empty user or assistant row anywhere (3). A truncated row that stays adds 3. Of the cheapest ways the one whose edits'
initials come first in ASCII is taken. Where a conversation has got to is one of four states: nothing yet, after the
system row, after a user row, after an assistant row; each state takes either a user or an assistant next, so a list of
edits alone says what comes out.

Two streams of rows, each dealt by conversation and sorted by turn within it; Arrow batches end anywhere, and what a
stream knows is carried from batch to batch:

1. ``decide`` runs from each conversation's last row to its first. It carries the cheapest costs from the four states to
   the end (dynamic programming) and notes for each row which edit each state takes: two bits a state, a byte a row. Full
   blocks of these backpointers are put out as rows (spilled to the shared folder), so a conversation of any length needs
   one block of memory. Only turns, initials, faults and digests are dealt here, no texts.
2. ``_walk`` runs from the first row to the last over texts and backpointers together, carries one state, and puts out
   the repaired rows, or their running hash.

Costs relative to the smallest of the four are few, so steps are looked up in a table that fills itself.

Rows: conv_id (any type; null is a conversation of its own), turn (null: before all others), role and text (null: one
space). Rows of one turn stand in the order of the MD5 of role and text; repeated rows beside each other. The initial of
a role is its first character: rows of other roles, and of the empty one, can't be kept, only reroled. A row's first
fault counts: blank (only ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier in the conversation), truncated
(its last other character isn't one of ``.!?``). A conversation without rows has zeros, no edits and the hash of the
empty string. One conversation is one stream, however long; all others are dealt over the tasks. An empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import materialize

#: State after an inserted or reroled row (a user row, but for an assistant row after a user row), and after a kept row.
FORCED = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Costs from each state where no rows are left: inserts alone.
AT_END = (0, 6, 3, 0)
EDITS = "DIKR"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FORCED_ROLE = ("user", "user", "assistant", "user")
#: Backpointers in a block.
BLOCK = 1 << 16
WHITE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
COUNTS = ("gaps", *FAULTS, "illegal", "cost")


def step(costs: tuple[int, ...], initial: str, must_go: bool, truncated: bool) -> tuple[tuple[int, ...], int]:
    """Costs from each state before a row, and its byte of backpointers, from the costs after it."""
    ways: list[dict[str, int]] = []
    extra = TRUNCATED * truncated
    for state in range(4):
        own = {"D": DELETE + costs[state]}
        if not must_go:
            if (to := KEPT.get(initial, {}).get(state)) is not None:
                own["K"] = extra + costs[to]
            own["R"] = REROLE + extra + costs[FORCED[state]]
        ways.append(own)
    least = [min(own.values()) for own in ways]
    two, three = min(least[2], INSERT + least[3]), min(least[3], INSERT + least[2])
    least = [min(least[0], INSERT + two), min(least[1], INSERT + two), two, three]
    marks = 0
    for state, own in enumerate(ways):
        own["I"] = INSERT + least[FORCED[state]]
        marks |= next(i for i, edit in enumerate(EDITS) if own.get(edit) == least[state]) << 2 * state
    return tuple(least), marks


class Backward:
    """One conversation from its last row to its first."""

    steps: dict[tuple, tuple] = {}

    def __init__(self) -> None:
        self.costs, self.base, self.marks = AT_END, 0, bytearray()
        self.count = dict.fromkeys((*FAULTS, "illegal"), 0)
        self.after: str | None = None
        self.last = self.first = None
        self.turns, self.blocks = 0, 0

    def row(self, turn: int | None, initial: str, fault: str) -> None:
        key = (self.costs, initial if initial in KEPT else "", fault)
        if (found := self.steps.get(key)) is None:
            costs, marks = step(self.costs, initial, fault in ("blank", "duplicate"), fault == "truncated")
            low = min(costs)
            found = self.steps[key] = (tuple(c - low for c in costs), low, marks)
        self.costs, low, marks = found
        self.base += low
        self.marks.append(marks)
        if fault:
            self.count[fault] += 1
        if self.after is not None and initial + self.after not in ("su", "ua", "au"):
            self.count["illegal"] += 1
        self.after = initial
        if turn is not None and turn != self.first:
            self.turns += 1
            self.first = turn
            self.last = turn if self.last is None else self.last

    def block(self) -> bytes:
        """The backpointers noted since the last block, first row first."""
        out = bytes(reversed(self.marks))
        self.marks.clear()
        self.blocks += 1
        return out

    def counts(self) -> dict[str, int]:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.count | {"gaps": gaps, "cost": self.base + self.costs[0]}


class Forward:
    """One conversation from its first row to its last, by the backpointers. Gives (edit, role, text) of what happens."""

    def __init__(self) -> None:
        self.state, self.marks, self.at = 0, bytearray(), 0

    def more(self, marks: bytes) -> None:
        del self.marks[: self.at]
        self.at = 0
        self.marks += marks

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        marks = self.marks[self.at]
        self.at += 1
        while (edit := EDITS[marks >> 2 * self.state & 3]) == "I":
            yield self.forced("I", "")
        if edit == "R":
            yield self.forced("R", text)
        else:
            yield edit, role, text
            if edit == "K":
                self.state = KEPT[role[0]][self.state]

    def end(self) -> Iterator[tuple[str, str, str]]:
        while AT_END[self.state]:
            yield self.forced("I", "")

    def forced(self, edit: str, text: str) -> tuple[str, str, str]:
        role = FORCED_ROLE[self.state]
        self.state = FORCED[self.state]
        return edit, role, text


def shaped(rows: DataFrame) -> DataFrame:
    """conv (conv_id as text), timed, turn, digest, role, text: rows as the streams sort them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    own = rows.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").isNotNull().alias("timed"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), role.alias("role"), text.alias("text"))
    return own.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def decide(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Blocks of backpointers: conv, timed, turn and digest of a block's first row, seq, marks; the block that begins a
    conversation (counts not null) has its counts. known: conv_ids that get a block even without rows."""
    own = shaped(rows)
    rest = F.rtrim("text", F.lit(WHITE))
    narrow = own.select("conv", "timed", "turn", "digest", F.substring("role", 1, 1).alias("initial"), plain_fault(rest).alias("fault"))
    if known is not None:
        marker = known.select(F.col("conv_id").cast("string").alias("conv"), F.lit(False).alias("timed"), F.lit(0).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("initial"), F.lit("").alias("fault"))
        narrow = narrow.unionByName(marker)
    # one exchange: rows of one conversation and digest lie where the conversation lies
    earlier = F.row_number().over(Window.partitionBy("conv", "digest").orderBy("timed", "turn"))
    marked = narrow.repartition("conv").withColumn("nth", earlier).withColumn("fault", F.when((F.col("nth") > 1) & (F.col("fault") != "blank"), "duplicate").otherwise(F.col("fault")))
    ordered = marked.sortWithinPartitions("conv", F.desc("timed"), F.desc("turn"), F.desc_nulls_last("digest"), F.desc("nth")).select("conv", "timed", "turn", "digest", "initial", "fault")
    names = ["conv", "timed", "turn", "digest", "seq", "marks", *COUNTS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, where = None, None, (False, 0, None)

        def done(last: bool) -> tuple:
            counts = state.counts() if last else {}
            return (now, *where, -state.blocks, state.block(), *(counts.get(c) for c in COUNTS))

        for batch in batches:
            out = []
            for conv, timed, turn, digest, initial, fault in batch.itertuples(index=False, name=None):
                if state is None or conv != now:
                    if state is not None:
                        out.append(done(True))
                    now, state, where = conv, Backward(), (False, 0, None)
                if digest is None:
                    continue  # a conversation is known by this row, and has no more of it
                if len(state.marks) >= BLOCK:
                    out.append(done(False))
                state.row(turn if timed else None, initial, fault)
                where = (timed, turn, digest)
            yield _frame(out, names)
        if state is not None:
            yield _frame([done(True)], names)

    schema = "conv string, timed boolean, turn long, digest binary, seq long, marks binary, " + ", ".join(f"{c} long" for c in COUNTS)
    return ordered.mapInPandas(run, schema)


def plain_fault(rest: Column) -> Column:
    """blank, truncated or nothing, for a text without the white space at its end."""
    return F.when(rest == "", "blank").when(~F.substring(rest, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names, dtype=object)


def _streams(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Texts and the blocks that go with them, one conversation after another, each block before its first row."""
    blocks = materialize(decide(rows, known), "backpointers")
    none = lambda kind: F.lit(None).cast(kind)
    texts = shaped(rows).withColumns({"seq": F.lit(1).cast("long"), "marks": none("binary")} | {c: none("long") for c in COUNTS})
    both = texts.unionByName(blocks.withColumns({"role": none("string"), "text": none("string")}))
    counts = F.when(F.col("cost").isNotNull(), F.array(*COUNTS)).alias("counts")
    both = both.repartition("conv").sortWithinPartitions("conv", "timed", "turn", F.asc_nulls_first("digest"), "seq")
    return both.select("conv", "marks", counts, "role", "text")


def repair_report(rows: DataFrame, *, known: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (initials of the edits in order) and
    repaired_sha256 of each conversation. gaps: turns missing between the smallest and the largest. illegal: neighbours
    whose initials aren't su, ua or au, before the repair. known: conv_ids that are reported even without rows."""
    names = ["conv", *COUNTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, walk, counts, audit, digest, between = None, None, (), bytearray(), None, ""

        def take(edits: Iterator[tuple[str, str, str]]) -> None:
            nonlocal between
            for edit, role, text in edits:
                if edit != "D":
                    digest.update(f"{between}{role}:{text}".encode())
                    between = "\n"
                audit.append(ord(edit))

        def done() -> tuple:
            take(walk.end())
            return (now, *counts, audit.decode(), digest.hexdigest())

        for batch in batches:
            out = []
            for conv, marks, own, role, text in batch.itertuples(index=False, name=None):
                if walk is None or conv != now:
                    if walk is not None:
                        out.append(done())
                    now, walk, audit, digest, between = conv, Forward(), bytearray(), hashlib.sha256(), ""
                if marks is None:
                    take(walk.row(role, text))
                else:
                    walk.more(marks)
                    if own is not None:
                        counts = tuple(int(x) for x in own)
            yield _frame(out, names)
        if walk is not None:
            yield _frame([done()], names)

    schema = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    found = materialize(_streams(rows, known).mapInPandas(run, schema), "repaired")
    return found.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *names[1:])


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role and text of the rows of all repaired conversations."""
    names = ["conv", "place", "edit", "role", "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, walk, place = None, None, 0

        def take(edits: Iterator[tuple[str, str, str]], out: list) -> None:
            nonlocal place
            for edit, role, text in edits:
                if edit != "D":
                    out.append((now, place, edit, role, text))
                    place += 1

        for batch in batches:
            out: list[tuple] = []
            for conv, marks, _, role, text in batch.itertuples(index=False, name=None):
                if walk is None or conv != now:
                    if walk is not None:
                        take(walk.end(), out)
                    now, walk, place = conv, Forward(), 0
                if marks is None:
                    take(walk.row(role, text), out)
                else:
                    walk.more(marks)
            yield _frame(out, names)
        if walk is not None:
            out = []
            take(walk.end(), out)
            yield _frame(out, names)

    found = materialize(_streams(rows, None).mapInPandas(run, "conv string, place long, edit string, role string, text string"), "repaired-turns")
    return found.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *names[1:])


def damage(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows after damage by the CRC-32 of ``conv_id:turn`` modulo 20, and the rows that it dropped. 0 drops a row, 1 empties
    its text, 2 removes the characters ``.!?`` from it, 3 repeats the row, 4 sets its role to user. Nulls are one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    own = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    kept = own.where("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return kept.withColumn("copy", copies).drop("kind", "copy"), own.where("kind = 0").select("conv_id")


def report_sql() -> str:
    """DuckDB SQL for the report of damaged conversations: suffixes of edits and texts for each state, last row first."""
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    one_byte = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT), lambda c, b: {one_byte}), 4294967295)"
    before = lambda piece, v: f"{piece} || CASE WHEN {v}.t = '' THEN '' ELSE chr(10) || {v}.t END"
    way = lambda cost, edit, v, text: f"{{'c': {cost} + {v}.c, 'a': '{edit}' || {v}.a, 't': {text}}}"
    forced = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    kept = {0: "WHEN 's' THEN {1} WHEN 'u' THEN {2}", 1: "WHEN 'u' THEN {2}", 2: "WHEN 'a' THEN {3}", 3: "WHEN 'u' THEN {2}"}
    base = []
    for q in range(4):
        keep = kept[q]
        for to in (1, 2, 3):
            keep = keep.replace(f"{{{to}}}", way("extra", "K", f"v{to}", before("role || ':' || text", f"v{to}")))
        role, to = forced[q]
        rerole = way("3 + extra", "R", f"v{to}", before(f"'{role}:' || text", f"v{to}"))
        ways = [way("4", "D", f"v{q}", f"v{q}.t"), f"CASE WHEN NOT must_go THEN CASE initial {keep} END END", f"CASE WHEN NOT must_go THEN {rerole} END"]
        base.append(f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1] AS b{q}")
    insert = lambda q, v: way("3", "I", v, before(f"'{forced[q][0]}:'", v))
    best = lambda q, v: f"list_sort([b{q}, {insert(q, v)}])[1] AS v{q}"
    end = lambda cost, edits, text: f"{{'c': {cost}, 'a': '{edits}', 't': {text}}}"
    return f"""
WITH RECURSIVE marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE kind <> 0),
placed AS (SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i FROM damaged),
faulty AS (
  SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed),
turns AS (SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM faulty),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS i, {end(0, '', "''")} AS v0, {end(6, 'II', "'user:' || chr(10) || 'assistant:'")} AS v1, {end(3, 'I', "'assistant:'")} AS v2, {end(0, '', "''")} AS v3 FROM counted
  UNION ALL
  SELECT conv_id, i, {best(0, 'v2')}, {best(1, 'v2')}, v2, v3
  FROM (SELECT conv_id, i, b0, b1, {best(2, 'b3')}, {best(3, 'b2')} FROM (
    SELECT w.conv_id, w.i - 1 AS i, {', '.join(base)} FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i)))
SELECT DISTINCT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
  coalesce(w.v0.c, 0)::BIGINT AS cost, coalesce(w.v0.a, '') AS audit, sha256(coalesce(w.v0.t, '')) AS repaired_sha256
FROM conversations o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 0"""
