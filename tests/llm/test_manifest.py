"""The manifest against a plain Merkle tree."""

import hashlib
import random
import zlib

from odd_tables import EDGES, SAMPLE, edges, frame, nothing, workers  # noqa: F401
from pyspark.sql import functions as F

from duebook.llm import manifest
from duebook.llm.queries import QUERIES


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spelled(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The top of a list of digests and each one's siblings (left, right), level by level."""
    ways = [[] for _ in nodes]
    own = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for k in range(len(run)):
                for i in own[a + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h("".join(run)))
            held.append([i for k in range(len(run)) for i in own[a + k]])
        nodes, own = above, held
    return nodes[0], ways


def plain(rows):
    """(leaf, subroot, root, siblings) of rows (doc_id, source, lang, n_chars, text), in any order."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, h("".join(map(spelled, r)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    tops = {name: climb([leaf for _, leaf in groups[name]]) for name in names}
    root, upper = climb([tops[name][0] for name in names])
    return [
        (r, leaf, tops[name][0], root, way + upper[n])
        for n, name in enumerate(names)
        for (r, leaf), way in zip(groups[name], tops[name][1])
    ]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def check(df, rows):
    got = sorted((r.id is not None, r.id or 0, r.leaf, r.subroot, r.root, [tuple(s) for s in r.above]) for r in manifest.manifest(df).collect())
    want = sorted((r[0] is not None, r[0] or 0, leaf, sub, root, way) for r, leaf, sub, root, way in plain(rows))
    assert got == want


def test_trees(spark):
    """Dense, wide and negative ids, rows that share an id or have none, trees of every height, many sources."""
    draw = random.Random(1)
    rows = []
    spread = {
        "dense": lambda: draw.randrange(3000),
        "wide": lambda: draw.randrange(1 << 62),
        "signed": lambda: draw.randrange(-(1 << 40), 1 << 40),
    }
    for source, n, kind in (("a", 600, "dense"), ("w", 290, "wide"), ("n", 280, "signed"), ("b", 1, "wide"), ("é", 16, "dense"),
                            ("Z", 17, "signed"), ("", 257, "dense"), (None, 30, "wide"), ("-", 2, "dense"), (":", 3, "dense")):
        some = set()
        while len(some) < n:
            some.add(spread[kind]())
        rows += [(i, source, draw.choice(["en", None]), draw.choice([None, 5]), draw.choice([None, "", "Täxt " * 3])) for i in some]
    rows += [(i, "ends", None, None, "x") for i in (-(1 << 63), -(1 << 63) + 1, -1, 0, 63, 64, 4095, 4096, (1 << 63) - 1)]
    rows += [(draw.choice([None, 5, 6, 7, 4097]), draw.choice(["shared", None]), None, None, draw.choice(["x", "y", "z", None])) for _ in range(400)]
    rows += [(i, f"s{i % 300}", None, None, str(i)) for i in range(700)]
    draw.shuffle(rows)
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_odd_tables(edges, nothing):
    columns = lambda df: df.select("*", F.lit("s").alias("source"), F.lit(None).alias("n_chars"), F.lit(1).alias("digest"), F.lit(1).alias("tree"), F.lit(1).alias("pos"))
    odd = columns(edges)
    got = sorted((r.id is not None, r.id or 0, r.leaf, r.subroot) for r in manifest.manifest(odd).collect())
    want = plain([(i, "s", "x", None, t) for i, t in EDGES])
    assert got == sorted((r[0] is not None, r[0] or 0, leaf, sub) for r, leaf, sub, *_ in want)
    assert manifest.manifest(columns(nothing)).count() == 0


def test_a_proof_holds_only_for_its_row(spark):
    rows = [(i, "ab"[i % 2], None, None, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = manifest.manifest(df, other={"text": F.when(F.col("doc_id") % 3 == 0, F.lit("forged"))})
    good = made.select("id", "other", (manifest.folded(F.col("leaf"), F.col("above")) == F.col("root")).alias("good"),
                       (manifest.folded(F.coalesce("other", "leaf"), F.col("above")) == F.col("root")).alias("holds"))
    for r in good.collect():
        assert r.good and r.holds == (r.id % 3 != 0) == (r.other is None)


def test_op13(spark):
    documents = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    rows = [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op13_manifest"](spark, SAMPLE).collect()}
    assert len(got) == len(rows)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = 0
    for r, leaf, sub, root, way in plain(rows):
        node = leaf
        if zlib.crc32(str(r[0]).encode()) % 5 == 0:
            node = h("".join(map(spelled, (*r[:4], r[4].translate(lower)))))
        for a, b in way:
            node = h(a + node + b)
        own = got[r[0]]
        assert (own.leaf, own.subroot, own.root, own.proof_sha256) == (leaf, sub, root, h("".join(a + b for a, b in way)))
        assert own.folded_root == node and own.verified == (node == root)
        tampered += node != root
    assert tampered
