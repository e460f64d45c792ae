"""Conversation repair against a search over all lists of edits."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from loomgraph.llm import conversations

VISIBLE = r"[^\x20\x09-\x0D]"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        seen_before, shown = (role, text) in seen, re.findall(VISIBLE, text)
        seen.add((role, text))
        out.append("blank" if not shown else "duplicate" if seen_before else "truncated" if shown[-1] not in ".!?" else "")
    return out


def every_way(rows):
    """(cost, audit, repaired rows) of all lists of edits with at most two inserts in a gap, roles of inserts and reroles free."""
    marked = list(zip(rows, faults(rows), strict=True))

    def ways(i, inserts):
        if i == len(marked):
            yield 0, "", ()
        if inserts < 2:
            for role in ("user", "assistant"):
                for cost, audit, rest in ways(i, inserts + 1):
                    yield cost + 3, "I" + audit, ((role, ""), *rest)
        if i == len(marked):
            return
        (role, text), fault = marked[i]
        for cost, audit, rest in ways(i + 1, 0):
            yield cost + 4, "D" + audit, rest
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                yield cost + extra, "K" + audit, ((role, text), *rest)
                for other in ("user", "assistant"):
                    yield cost + 3 + extra, "R" + audit, ((other, text), *rest)

    return min(w for w in ways(0, 0) if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in w[2])))


def report(rows):
    """The report of one conversation's (turn, role, text) rows in order."""
    own = [(r, t) for _, r, t in rows]
    cost, audit, repaired = every_way(own)
    turns = [t for t, _, _ in rows if t is not None]
    found = faults(own)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), repaired


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 2, 3])):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice([f"Fine {turn}.", f"Fine {turn}.", "again!", "cut off", "", " \n", None, "Endé? \t"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows


def grouped(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {k: sorted(v, key=order) for k, v in by.items()}


def test_repairs_equal_a_search_of_all_edits(spark, monkeypatch):
    """Ties, repeated rows, nulls everywhere, unknown and empty roles; blocks of two backpointers and batches of three rows."""
    monkeypatch.setattr(conversations, "BLOCK", 2)
    rows = made(150, 4)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"seq": F.lit("clash"), "marks": F.lit(1), "cost": F.lit("x")}).repartition(5)
    wanted = {k: report(v) for k, v in grouped(rows).items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = {r[0]: tuple(r)[1:] for r in conversations.repair_report(docs, known=spark.createDataFrame([(9999,), (5,)], "conv_id long")).collect()}
        turns = conversations.repaired_turns(docs).orderBy("conv_id", "place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found.pop(9999) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    if 5 not in wanted:
        found.pop(5)
    assert found == {k: v[0] for k, v in wanted.items()}
    for k, (_, repaired) in wanted.items():
        assert tuple((r.role, r.text) for r in turns if r.conv_id == k) == repaired
    assert conversations.repair_report(docs.limit(0)).count() == 0


def test_damage_equals_plain_loop(spark):
    rows = [(c, t, random.Random(c * 9 + t).choice(["system", "user", "assistant"]), f"Text {t}. Yes? No!") for c in range(60) for t in range(8)] + [(None, 3, None, None), (7, None, "user", "x")]
    kept, gone = conversations.damage(spark.createDataFrame(rows, SCHEMA))
    wanted, dropped = [], []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        wanted += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1 if kind else 0)
        dropped += [c] * (kind == 0)
    assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == sorted(map(repr, wanted))
    assert sorted(r.conv_id for r in gone.collect()) == sorted(dropped)


def test_a_giant_conversation_is_streamed(spark, monkeypatch):
    """100,000 turns: blocks of backpointers are put out on the way, and the repair is what the pieces' repairs say."""
    monkeypatch.setattr(conversations, "BLOCK", 1000)
    rows = spark.range(100_000).select(F.lit("one").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("row "), "id", F.when(F.col("id") % 1000 == 999, "").otherwise(".")).alias("text"))
    assert conversations.decide(rows).count() == 100
    found = conversations.repair_report(rows).first()
    assert (found.conv_id, found.gaps, found.truncated, found.illegal, found.cost, found.audit) == ("one", 0, 100, 0, 300, "K" * 100_000)
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:row {i}{'' if i % 1000 == 999 else '.'}" for i in range(100_000))
    assert found.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
