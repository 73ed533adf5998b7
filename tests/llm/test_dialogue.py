"""Repair of conversations against trying every edit."""

import hashlib
import itertools
import random
import re

import pytest
from odd_tables import SAMPLE, frame, workers  # noqa: F401
from pyspark.sql import functions as F

from duebook.llm import dialogue
from duebook.llm.queries import QUERIES

GOOD = re.compile(r"(s?(ua)+)?")


def every_audit(rows, most):
    """All (cost, audit, repaired) of rows (role, text, fault) with at most so many inserts."""
    kinds = [("K", "R", "D") if f not in ("b", "d") else ("D",) for _, _, f in rows]
    for edits in itertools.product(*kinds):
        for inserts in itertools.product(range(most + 1), repeat=len(rows) + 1):
            if sum(inserts) > most:
                continue
            audit = "".join("I" * n + e for n, e in zip(inserts, (*edits, "")))
            free = sum(e == "R" for e in edits) + sum(inserts)
            for given in itertools.product(("user", "assistant"), repeat=free):
                given, left, out, cost = iter(given), iter(rows), [], 0
                for e in audit:
                    if e == "I":
                        out.append((next(given), ""))
                        cost += 2
                        continue
                    role, text, fault = next(left)
                    cost += {"K": 0, "R": 2, "D": 3}[e] + (fault == "t" and e != "D")
                    if e != "D":
                        out.append((next(given) if e == "R" else role, text))
                if GOOD.fullmatch("".join(r[:1] for r, _ in out)):
                    yield cost, audit, out


@pytest.mark.parametrize("seed", range(40))
def test_the_cheapest_audit(seed):
    draw = random.Random(seed)
    rows = [(draw.choice(["user", "assistant", "system", "tool", " "]), f"t{i}", draw.choice(["", "", "t", "b", "d"])) for i in range(draw.randrange(0, 5))]
    want = min(every_audit(rows, 4 if len(rows) < 4 else 3), key=lambda x: x[:2])
    audits = dialogue.Audits()
    cost, node = dialogue.ending(dialogue.audit_from(dialogue.START, [(r[:1], f) for r, _, f in rows], audits), audits)
    audit = audits.string(node)
    assert (cost, audit) == want[:2]
    assert list(dialogue.carried_out(audit, [(r, t) for r, t, _ in rows])) == want[2]


def plain_audit(rows):
    """The program with whole strings instead of linked nodes."""
    inf = (10**9, "")
    best = [(0, ""), inf, inf, inf]

    def inserted(b):
        add = lambda x, n: (x[0] + 2 * n, x[1] + "I" * n)
        return [b[0], b[1], min(b[2], add(b[0], 1), add(b[1], 1), add(b[3], 1)), min(b[3], add(b[2], 1), add(b[0], 2), add(b[1], 2))]

    for initial, fault in rows:
        e, new = inserted(best), [inf] * 4
        for s in range(4):
            options = [(s, 3, "D")]
            if fault not in ("b", "d"):
                late, turn = int(fault == "t"), 3 if s == 2 else 2
                options.append((turn, 2 + late, "R"))
                if initial == ("a" if s == 2 else "u"):
                    options.append((turn, late, "K"))
                if initial == "s" and s == 0:
                    options.append((1, late, "K"))
            for to, cost, letter in options:
                new[to] = min(new[to], (e[s][0] + cost, e[s][1] + letter))
        best = new
    e = inserted(best)
    return min(e[0], e[3])


def test_long_conversations_and_colliding_hashes(monkeypatch):
    draw = random.Random(5)
    for modulus in (dialogue.HASH_MODULUS, 3):
        monkeypatch.setattr(dialogue, "HASH_MODULUS", modulus)
        for n in (50, 333, 1500):
            rows = [(draw.choice("uuaas"), draw.choice(["", "", "", "t", "b", "d"])) for _ in range(n)]
            audits = dialogue.Audits()
            cost, node = dialogue.ending(dialogue.audit_from(dialogue.START, rows, audits), audits)
            assert (cost, audits.string(node)) == plain_audit(rows)


def expected(rows):
    """What op11 gives of the rows (turn, role, text) of one conversation, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        again = (role, text) in seen
        seen.add((role, text))
        faults.append("b" if blank else "d" if again else "" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "t")
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = plain_audit(list(zip(initials, faults)))
    lines = [f"{r}:{t}" for r, t in dialogue.carried_out(audit, [(r, t) for _, r, t in rows])]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (*[faults.count(f) for f in "bdt"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest())
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)


def check(df, rows):
    own = {}
    for conv, *rest in rows:
        own.setdefault(conv, []).append(tuple(rest))
    got = {r.id: tuple(r)[1:] for r in dialogue.summaries(dialogue.repair(df)).collect()}
    assert got == {conv: expected(in_order(r)) for conv, r in own.items()}


SCHEMA = "conv_id long, turn long, role string, text string"
EXTRA = "id part at key nth blank cost audit seen"


def drawn(draw, conv, turn):
    role = draw.choice(["user", "assistant", "assistant", "user", "system", "tool", None])
    return conv, turn, role, draw.choice(["", " \n", "Yes.", "No!", "and then", "é?", None, f"text {turn}.", f"tail {turn}"])


def test_conversations_of_odd_tables(frame):
    draw = random.Random(11)
    rows = [drawn(draw, conv, draw.choice([None, 0, 1, 2, 3, 4, 5])) for conv in (None, *range(60)) for _ in range(draw.randrange(1, 12))]
    rows += rows[:40]
    check(frame(rows, SCHEMA, EXTRA), rows)
    empty = frame([], SCHEMA, EXTRA)
    assert dialogue.summaries(dialogue.repair(empty)).count() == 0 and dialogue.gaps(empty).count() == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_a_conversation_over_many_partitions(spark, frame, hot):
    draw = random.Random(12)
    rows = [drawn(draw, hot, draw.choice([None, *range(900)])) for _ in range(2500)]
    rows += [(hot, 5, "user", "the same row.")] * 400
    rows += [drawn(draw, conv, turn) for conv in range(100, 300) for turn in range(6)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        repaired = dialogue.repair(frame(rows, SCHEMA, EXTRA))
        assert repaired.filter(F.col("id").eqNullSafe(F.lit(hot))).select("part").distinct().count() > 3
        check(frame(rows, SCHEMA, EXTRA), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_gaps(frame):
    rows = [(1, 3, "user", "x"), (1, 7, "user", "x"), (1, 7, "user", "x"), (1, None, "user", "x"), (2, None, "user", "x"), (3, 5, "user", "x")]
    assert {r.id: r.gaps for r in dialogue.gaps(frame(rows, SCHEMA, "gaps")).collect()} == {1: 3, 2: 0, 3: 0}


def test_damage(frame):
    import zlib

    rows = [(c, t, "assistant", "One. Two!") for c in (None, *range(40)) for t in (None, *range(4))]
    got = sorted(map(repr, dialogue.damaged(frame(rows, SCHEMA, "kind time")).collect()))
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        new = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "One Two" if kind == 2 else text)
        want += [new] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(f"Row(conv_id={c!r}, turn={t!r}, role={r!r}, text={x!r})" for c, t, r, x in want)


def test_op11_has_every_conversation(spark):
    rows = QUERIES["op11_dialogue"](spark, SAMPLE).collect()
    ids = {r.conv_id for r in spark.read.parquet(f"{SAMPLE}/conversations.parquet").select("conv_id").collect()}
    assert sorted(r.conv_id for r in rows) == sorted(ids)
    assert all(r.audit or r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
