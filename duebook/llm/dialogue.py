"""Repair of conversations: the cheapest edits that make the roles take turns, with an audit of them.

A conversation is read row by row. For each state that the repaired roles may be in, the program keeps the cheapest audit so
far, a string of edit initials. Audits are linked nodes, so that they share their prefixes; a node knows its ancestors at
distances of powers of two and a rolling hash of its string. Two audits of equal cost compare at the end of their longest
common prefix, which is searched for by lifting both while the hashes differ. Nodes are interned by parent and letter, so
equal hashes are verified by identity: of two different nodes the strings differ, whatever the hashes say. No audit is a
proper prefix of another of its cost and state, as only inserts could follow, and those cost.

Rows are sorted by range of conversation and order, so one conversation may lie in many partitions. One that lies in a
single partition is repaired where it is. Of the others, at most one for each border of partitions, each part gives its
cheapest audits from every state to every state; these few rows are put together, and then each part is repaired as the
whole asks for. Only an audit, which is one value, is ever held for a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import cut

#: What the repaired roles so far end with: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: States that a conversation may end in.
ENDS = (START, ASSISTANT)
RETELL, REMOVE, ADD, CUT_OFF = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
HASH_BASE, HASH_MODULUS = 1_000_003, (1 << 61) - 1
#: Lines and characters that one Arrow batch holds at most, but for a single longer conversation.
BATCH_LINES, BATCH_CHARS = 5000, 1 << 20


class Audits:
    """Strings of edit initials as linked nodes; node 0 is the empty string."""

    def __init__(self):
        self.depth, self.letter, self.hash = [0], [""], [0]
        self.ancestors: list[list[int]] = [[]]
        self.known: dict[tuple[int, str], int] = {}

    def after(self, node: int, letter: str) -> int:
        """The string with one letter more."""
        key = (node, letter)
        new = self.known.get(key)
        if new is None:
            new = self.known[key] = len(self.depth)
            self.depth.append(self.depth[node] + 1)
            self.letter.append(letter)
            self.hash.append((self.hash[node] * HASH_BASE + ord(letter)) % HASH_MODULUS)
            lifted, k, at = [node], 0, node
            while k < len(self.ancestors[at]):
                at = self.ancestors[at][k]
                lifted.append(at)
                k += 1
            self.ancestors.append(lifted)
        return new

    def ancestor(self, node: int, depth: int) -> int:
        up = self.depth[node] - depth
        while up:
            node = self.ancestors[node][up.bit_length() - 1]
            up -= 1 << up.bit_length() - 1
        return node

    def before(self, a: int, b: int) -> bool:
        """Whether string a comes before string b."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        k = len(self.ancestors[x]) - 1
        while k >= 0:
            up_x, up_y = self.ancestors[x], self.ancestors[y]
            if k < len(up_x) and (self.hash[up_x[k]] != self.hash[up_y[k]] or up_x[k] != up_y[k]):
                x, y = up_x[k], up_y[k]
            k -= 1
        return self.letter[x] < self.letter[y]

    def string(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))


Best = list  # for each state (cost, node), or None where it cannot be reached


def offer(best: Best, state: int, cost: int, node: int, audits: Audits) -> None:
    held = best[state]
    if held is None or cost < held[0] or cost == held[0] and audits.before(node, held[1]):
        best[state] = (cost, node)


def with_inserts(best: Best, audits: Audits) -> Best:
    """Every state that inserts lead to from those reached; more than two of them only lead back."""
    out = list(best)
    for state in STATES:
        if best[state] is None:
            continue
        cost, node = best[state]
        for n in range(1, 2 if state in (USER, ASSISTANT) else 3):
            state = ASSISTANT if state == USER else USER
            node = audits.after(node, "I")
            offer(out, state, cost + ADD * n, node, audits)
    return out


def step(best: Best, initial: str, fault: str, audits: Audits) -> Best:
    """The states after one more row. fault: `b`lank, `d`uplicate, `t`runcated or none."""
    reached, out = with_inserts(best, audits), [None] * 4
    for state in STATES:
        if reached[state] is None:
            continue
        cost, node = reached[state]
        offer(out, state, cost + REMOVE, audits.after(node, "D"), audits)
        if fault in ("b", "d"):
            continue
        cost += CUT_OFF * (fault == "t")
        turn = ASSISTANT if state == USER else USER
        if initial == ("a" if state == USER else "u"):
            offer(out, turn, cost, audits.after(node, "K"), audits)
        elif initial == "s" and state == START:
            offer(out, SYSTEM, cost, audits.after(node, "K"), audits)
        offer(out, turn, cost + RETELL, audits.after(node, "R"), audits)
    return out


def audit_from(state: int, rows: list[tuple[str, str]], audits: Audits) -> Best:
    """Cheapest audits of rows (initial, fault) from one state to each, without inserts behind the last row."""
    best: Best = [None] * 4
    best[state] = (0, 0)
    for initial, fault in rows:
        best = step(best, initial, fault, audits)
    return best


def ending(best: Best, audits: Audits) -> tuple[int, int]:
    """The cheapest of the states that a conversation may end in: its cost and node."""
    end: Best = [None]
    for state in ENDS:
        if (held := with_inserts(best, audits)[state]) is not None:
            offer(end, 0, *held, audits)
    return end[0]


def carried_out(audit: str, rows: Iterable[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str]]:
    """The repaired rows (role, text)."""
    rows = iter(rows)
    for letter in audit:
        turn = ASSISTANT if state == USER else USER
        named = "assistant" if turn == ASSISTANT else "user"
        if letter == "I":
            state = turn
            yield named, ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = SYSTEM if role[:1] == "s" else turn
            yield role, text
        elif letter == "R":
            state = turn
            yield named, text


@dataclass
class Part:
    """Consecutive rows of a conversation in one partition."""

    id: object
    part: int
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[str] = field(default_factory=list)
    keys: set = field(default_factory=set)

    def add(self, role: str, text: str, blank: bool, truncated: bool, key: str, seen: bool) -> None:
        again = seen or key in self.keys
        self.keys.add(key)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append("b" if blank else "d" if again else "t" if truncated else "")

    @property
    def initials(self) -> list[str]:
        return [r[:1] for r in self.roles]

    def counts(self) -> dict[str, int]:
        pairs = zip(self.initials, self.initials[1:])
        faults = {name: self.faults.count(name[0]) for name in ("blank", "duplicate", "truncated")}
        return faults | {"illegal": sum(a + b not in LEGAL for a, b in pairs)}


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """The parts of a stream of rows that is sorted by conversation and part."""
    own = None
    for batch in batches:
        for id, part, role, text, blank, truncated, key, seen in zip(*[c.to_pylist() for c in batch.columns]):
            if own is None or (own.id, own.part) != (id, part):
                if own is not None:
                    yield own
                own = Part(id, part)
            own.add(role, text, blank, truncated, key, seen)
    if own is not None:
        yield own


SUMMARY = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")


class Rows:
    """Rows to be given out as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: dict, chars: int = 0) -> None:
        self.rows.append(row)
        self.chars += chars

    def ready(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (last or len(self.rows) >= BATCH_LINES or self.chars >= BATCH_CHARS):
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
            self.rows, self.chars = [], 0


def lines_schema(id: pa.DataType) -> pa.Schema:
    long = ("part", "at", "blank", "duplicate", "truncated", "illegal", "cost")
    return pa.schema([("id", id), *[(c, pa.int64()) for c in long], ("role", pa.string()), ("text", pa.string()), ("audit", pa.string())])


LINES = "part long, at long, blank long, duplicate long, truncated long, illegal long, cost long, role string, text string, audit string"


def repaired_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of each whole conversation, then a row with its audit and counts."""
    out = None
    for kind, own in _with_type(batches):
        out = out or Rows(lines_schema(kind))
        audits = Audits()
        cost, node = ending(audit_from(START, list(zip(own.initials, own.faults)), audits), audits)
        audit = audits.string(node)
        for at, (role, text) in enumerate(carried_out(audit, zip(own.roles, own.texts))):
            out.add({"id": own.id, "part": own.part, "at": at, "role": role, "text": text}, len(text))
            yield from out.ready()
        out.add({"id": own.id, "part": own.part, **own.counts(), "cost": cost, "audit": audit}, len(audit))
        yield from out.ready()
    if out:
        yield from out.ready(last=True)


def _with_type(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, Part]]:
    """The parts, each with the type of its id."""
    kind = None

    def noted() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield batch

    for own in parts(noted()):
        yield kind, own


TABLE = "part long, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, audits array<string>"


def part_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part of a conversation its counts and its cheapest audits, from each state to each state."""
    long = [(c, pa.int64()) for c in ("part", "blank", "duplicate", "truncated", "illegal")]
    for kind, own in _with_type(batches):
        schema = pa.schema([("id", kind), *long, ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
        audits, rows = Audits(), list(zip(own.initials, own.faults))
        ways = [way for state in STATES for way in audit_from(state, rows, audits)]
        row = {"id": own.id, "part": own.part, **own.counts(), "first": own.initials[0], "last": own.initials[-1]}
        row |= {"costs": [w and w[0] for w in ways], "audits": [w and audits.string(w[1]) for w in ways]}
        yield pa.RecordBatch.from_pylist([row], schema)


PIECES = "part long, state long, piece string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def put_together(tables: pa.Table) -> pa.Table:
    """The audit of a conversation from those of its parts: for each part the state it begins in and its piece."""
    rows = sorted(tables.to_pylist(), key=lambda r: r["part"])
    # For each state the cost and a chain (chain before, state before, piece).
    best: list = [(0, None), None, None, None]
    for row in rows:
        new: list = [None] * 4
        for a in STATES:
            for b in STATES:
                cost, piece = row["costs"][4 * a + b], row["audits"][4 * a + b]
                if best[a] is None or piece is None:
                    continue
                way = (best[a][0] + cost, (best[a][1], a, piece))
                if new[b] is None or way[0] < new[b][0] or way[0] == new[b][0] and chain_before(way[1], new[b][1]):
                    new[b] = way
        best = new
    ends = []
    for state, inserts in ((START, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")):
        if best[state] is not None:
            ends.append((best[state][0] + ADD * len(inserts), (best[state][1], state, inserts)))
    least = min(c for c, _ in ends)
    end = None
    for cost, chain in ends:
        if cost == least and (end is None or chain_before(chain, end)):
            end = chain
    pieces, states, chain = [], [], end
    while chain is not None:
        chain, state, piece = chain
        pieces.append(piece)
        states.append(state)
    pieces, states = pieces[::-1], states[::-1]
    audit = "".join(pieces)
    inserts = pieces.pop()
    pieces[-1] += inserts
    states.pop()
    joints = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows, rows[1:]))
    counts = {name: sum(r[name] for r in rows) + joints * (name == "illegal") for name in ("blank", "duplicate", "truncated", "illegal")}
    out = [{"id": r["id"], "part": r["part"], "state": s, "piece": p, **counts, "cost": least} for r, s, p in zip(rows, states, pieces)]
    # One row carries the whole audit.
    out[-1]["audit"] = audit
    long = [(c, pa.int64()) for c in ("part", "state")], [(c, pa.int64()) for c in (*counts, "cost")]
    schema = pa.schema([tables.schema.field("id"), *long[0], ("piece", pa.string()), *long[1], ("audit", pa.string())])
    return pa.Table.from_pylist(out, schema)


def chain_before(a: tuple | None, b: tuple | None) -> bool:
    """Whether one chain of pieces spells a string before another's; what they share is not spelled."""
    spelled_a, spelled_b = [], []
    while a is not b:
        spelled_a.append(a[2])
        spelled_b.append(b[2])
        a, b = a[0], b[0]
    return "".join(reversed(spelled_a)) < "".join(reversed(spelled_b))


def repaired_spans(rows: pa.Table, pieces: pa.Table) -> pa.Table:
    """The repaired rows of one part of a conversation, and with its last part the row of its audit and counts."""
    rows, (piece,) = rows.sort_by("nth_in_part"), pieces.to_pylist()
    where = {"id": piece["id"], "part": piece["part"]}
    done = carried_out(piece["piece"], zip(rows["role"].to_pylist(), rows["text"].to_pylist()), piece["state"])
    out = [{**where, "at": at, "role": role, "text": text} for at, (role, text) in enumerate(done)]
    if piece["audit"] is not None:
        out.append(where | {c: piece[c] for c in SUMMARY})
    return pa.Table.from_pylist(out, lines_schema(pieces.schema.field("id").type))


def repair(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows (`id`, `part`, `at`, `role`, `text`) and, where `at` is null, a row per conversation with `blank`,
    `duplicate`, `truncated`, `illegal`, `cost` and `audit`.

    A conversation's rows come one after the other, in order, the row of its audit last. Rows are read by turn (null first);
    rows of one turn by role, then by a hash of role and text, so repeated rows stand next to each other. Null roles and
    texts count as one blank. A null id is a conversation of its own. Other columns are ignored, so names cannot clash.
    """
    roles, texts = (F.coalesce(df[f"`{c}`"].cast("string"), F.lit(" ")) for c in (role, text))
    named = df.select(df[f"`{id}`"].alias("id"), df[f"`{turn}`"].alias("turn"), roles.alias("role"), texts.alias("text"))
    marks = named.select(
        "id",
        "turn",
        "role",
        "text",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("key"),
        F.monotonically_increasing_id().alias("nth"),
    )
    order = ["id", "turn", "role", "key", "nth"]
    ranged = marks.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(ranged.withColumn("part", F.spark_partition_id().cast("long")))
    borders = rows.groupBy("part").agg(F.min(F.struct("id")).alias("low"), F.max(F.struct("id")).alias("high"))
    ends = borders.select("part", F.col("low.id").alias("open")).union(borders.select("part", F.col("high.id").alias("open"))).distinct()
    # At most one for each border of partitions.
    spans = cut(ends.groupBy("open").agg(F.count("*").alias("n")).filter("n > 1").select("open"))
    columns = ["id", "part", "role", "text", "blank", "truncated", "key"]
    kind = df.select(df[f"`{id}`"].alias("id")).schema[0].dataType.simpleString()
    in_span = rows["id"].eqNullSafe(spans["open"])
    whole = rows.join(F.broadcast(spans), in_span, "left_anti").select(*columns, F.lit(False).alias("seen"))
    done = whole.mapInArrow(repaired_parts, f"id {kind}, {LINES}")
    if spans.isEmpty():
        return done
    # The rows of a part are in order, so their numbers are.
    spanning = rows.join(F.broadcast(spans), in_span, "left_semi").withColumn("nth_in_part", F.monotonically_increasing_id())
    firsts = spanning.groupBy(F.col("id").alias("id_"), F.col("key").alias("key_")).agg(F.min("part").alias("first_part"))
    met = spanning.join(firsts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("key") == F.col("key_")))
    met = met.withColumn("seen", F.col("first_part") < F.col("part")).drop("id_", "key_", "first_part")
    by_part = met.repartition("id", "part").sortWithinPartitions("id", "part", "nth_in_part")
    tables = by_part.select(*columns, "seen").mapInArrow(part_tables, f"id {kind}, {TABLE}")
    pieces = cut(tables.groupBy("id").applyInArrow(put_together, f"id {kind}, {PIECES}"))
    ordered = spanning.select("id", "part", "role", "text", "nth_in_part")
    spelled = ordered.groupBy("id", "part").cogroup(pieces.groupBy("id", "part")).applyInArrow(repaired_spans, f"id {kind}, {LINES}")
    return done.union(spelled.repartition("id").sortWithinPartitions("id", "part", F.col("at").asc_nulls_last()))


def summaries(repaired: DataFrame) -> DataFrame:
    """(`id`, counts, `cost`, `audit`, `repaired_sha256`): the digest of the repaired rows as `role:text`, joined by line feeds.

    Reads the rows as they come from `repair`, one conversation after the other; no conversation is held.
    """
    kind = repaired.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = hashlib.sha256(), True
        for batch in batches:
            found = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                id, at, role, text, *counts = row
                if at is not None:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
                else:
                    found.append((id, *counts, digest.hexdigest()))
                    digest, first = hashlib.sha256(), True
            names = ["id", *SUMMARY, "repaired_sha256"]
            types = [batch.schema.field(0).type, *[pa.int64()] * 5, pa.string(), pa.string()]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*found), types)] if found else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return repaired.select("id", "at", "role", "text", *SUMMARY).mapInArrow(run, schema)


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of `conv_id:turn` mod 20 (nulls as one blank).

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats it, 4 makes it the user's.
    """
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = (F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")) % 20).alias("kind")
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = df.select("conv_id", "turn", *filled, kind).filter("kind <> 0")
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def gaps(df: DataFrame, id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(`id`, `gaps`): turns that are missing between a conversation's first and last one; 0 where all are null."""
    numbers = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
    return df.groupBy(F.col(id).alias("id")).agg(F.coalesce(numbers, F.lit(0)).cast("long").alias("gaps"))
