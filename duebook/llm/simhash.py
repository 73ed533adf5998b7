"""Near-duplicate texts by SimHash fingerprints.

Fingerprints that differ in few bits are found by the pigeonhole rule: cut 64 bits into more blocks than bits may differ,
and two close fingerprints agree on enough whole blocks to share a key made of those. Candidates of a key are verified
by Hamming distance. A key whose bucket is large is not compared pair by pair: its members get finer keys made of the
bits not used yet, level by level, until a bucket is small. The last level leaves at most 9 free bits, so its buckets
hold at most 512 different fingerprints and are compared whole, large or not: no bucket is capped and no link between
different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import cut, each_text, free_name, release, text_blocks

SEED = 42
DIFFER = 3
BLOCKS = 6
BUCKET = 256
#: Fingerprints up to which all pairs are compared at once.
MATRIX = 256
LEVELS = 3
CHOICES = list(combinations(range(BLOCKS), BLOCKS - DIFFER))


def shingle_hashes(text: bytes, words_in_shingle: int) -> np.ndarray:
    """A 64-bit hash of each shingle, repeats included; fewer words than that make one shingle, no words none."""
    words = text.lower().split()
    if len(words) <= words_in_shingle:
        hashes = xxhash.xxh64_digest(b" ".join(words), SEED) if words else b""
    else:
        joined = b" ".join(words)
        sizes = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - words_in_shingle + 1].tolist()
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, (ends - 1)[words_in_shingle - 1 :].tolist())])
    return np.frombuffer(hashes, ">u8").astype(np.uint64)


def fingerprint(text: bytes, words_in_shingle: int) -> int:
    """64 bits as a long: a bit is set if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, words_in_shingle)
    set_in = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 4096):
        some = hashes[a : a + 4096, None].astype(">u8").view(np.uint8)
        set_in += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * set_in > len(hashes)).view(">i8")[0])


def fingerprints(text, words_in_shingle: int = 3):
    """The fingerprint of each whole text, a column of longs; null counts as empty."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t, words_in_shingle) for block in text_blocks(texts) for t in each_text(*block)]
        return pa.array(found, pa.int64())

    return of(F.coalesce(text, F.lit("")))


@cache
def key_mask(code: int, level: int) -> int:
    """Bits that a key of this code compares: at each level half of those that the level before left free."""
    used = 0
    for step in reversed(range(level)):
        choice = CHOICES[code // len(CHOICES) ** step % len(CHOICES)]
        free = [b for b in range(64) if not used >> b & 1]
        for block in choice:
            for b in free[block * len(free) // BLOCKS : (block + 1) * len(free) // BLOCKS]:
                used |= 1 << b
    return used


def finer_keys(members: DataFrame, level: int) -> DataFrame:
    """For each (code, fp) a row (code, bits, fp) for every choice of blocks at this level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = (code[:, None] * len(CHOICES) + np.arange(len(CHOICES))).ravel()
            distinct, which = np.unique(new, return_inverse=True)
            masks = np.array([key_mask(int(c), level) for c in distinct], np.uint64).view(np.int64)[which]
            fp = np.repeat(fp, len(CHOICES))
            for a in range(0, len(new), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(new[part]), pa.array((fp & masks)[part]), pa.array(fp[part])], names=["code", "bits", "fp"])

    return members.select("code", "fp").mapInArrow(run, "code long, bits long, fp long")


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Places of links that join what is connected among different fingerprints, each verified.

    Row by row, so that memory grows with the fingerprints and not with their pairs.
    """
    left, links = np.arange(len(fps)), []
    while len(left):
        edge, left = [int(left[0])], left[1:]
        while edge and len(left):
            here = edge.pop()
            close = np.bitwise_count(fps[left] ^ fps[here]) <= DIFFER
            near = left[close].tolist()
            left = left[~close]
            links += [(here, x) for x in near]
            edge += near
    return links


def matrix_forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """The same for a few fingerprints, all pairs at once."""
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= DIFFER
    left, links = np.ones(len(fps), bool), []
    for seed in range(len(fps)):
        if not left[seed]:
            continue
        left[seed] = False
        edge = [seed]
        while edge:
            here = edge.pop()
            near = np.flatnonzero(close[here] & left).tolist()
            left[near] = False
            links += [(here, x) for x in near]
            edge += near
    return links


def bucket_links(buckets: DataFrame) -> DataFrame:
    """Links (a, b) within each row's list `fps`. A task leaves out links between what its earlier links connect already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        def joins(a: int, b: int) -> bool:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
            return a != b

        for batch in batches:
            lists = batch.column(0)
            fps, at = lists.flatten().to_numpy(), np.asarray(lists.offsets).astype(np.int64)
            at = at - at[0]
            places = []
            for a, b in zip(at, at[1:]):
                own = fps[a:b].view(np.uint64)
                found = matrix_forest(own) if b - a <= MATRIX else forest(own)
                places += [(a + x, a + y) for x, y in found]
            pairs = fps[np.array(places, np.int64).reshape(-1, 2)].tolist()
            links = np.array([p for p in pairs if joins(*p)], np.int64).reshape(-1, 2)
            columns = [pa.array(f(links[:, 0], links[:, 1])) for f in (np.minimum, np.maximum)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def close_links(fps: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect all fingerprints within DIFFER bits of each other; input: distinct `fp`."""
    members, found = fps.select(F.lit(0).cast("long").alias("code"), "fp"), None
    for level in range(1, LEVELS + 1):
        keys = finer_keys(members, level)
        shared = cut(keys.groupBy("code", "bits").agg(F.count("*").alias("n")).filter("n > 1"))
        # What the last level leaves large holds 512 at most.
        whole = shared if level == LEVELS else shared.filter(F.col("n") <= BUCKET)
        buckets = keys.join(whole, ["code", "bits"]).groupBy("code", "bits").agg(F.collect_list("fp").alias("fps"))
        links = bucket_links(buckets)
        found = links if found is None else found.union(links)
        large = shared.filter(F.col("n") > BUCKET)
        if level == LEVELS or large.isEmpty():
            break
        members = keys.join(large, ["code", "bits"], "left_semi")
    return found.distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest member (`root`) of each linked node's component; links: (a, b), a <> b.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the smallest one of its
    neighbourhood, then every smaller neighbour is. The number of rounds grows with the logarithm of the longest chain.
    """
    arcs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = last = None
    while True:
        both = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        arcs = cut(smaller.union(least.select("u", F.col("m").alias("v"))).distinct())
        release(last)
        last = arcs
        state = arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return arcs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """Per row: `doc_id`, `text_key` (hash of the text), `fp`, `class` and `component_id`, the smallest id reachable.

    Texts whose fingerprints (fp, a long) differ in at most DIFFER bits are linked, all of them. Null and empty texts have
    fingerprint zero and are linked like others. Repeated rows stay separate rows of one component. A component whose ids
    are all null has a null component_id. Other columns are not returned, so names cannot clash.
    """
    text_column = df[f"`{text}`"]
    found = fingerprints(text_column, words_in_shingle).alias("fp")
    rows = cut(df.select(df[f"`{id}`"].alias("doc_id"), F.xxhash64(text_column).alias("text_key"), found))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(close_links(nodes.select("fp"))).withColumnRenamed("node", "linked")
    classed = nodes.join(roots, nodes["fp"] == roots["linked"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("class"))
    ids = classed.groupBy("class").agg(F.min("least_id").alias("component_id"))
    known = classed.select("fp", "class").join(ids, "class")
    return rows.join(known, "fp").select("doc_id", "text_key", "fp", "class", "component_id")


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """The table with one row of each component: the smallest id (nulls last), then one of the rows that share it."""
    members = near_duplicates(df, id, text, words_in_shingle)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    chosen = members.groupBy("class").agg(F.min(order).alias("row")).select(F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"))
    key, nth = free_name(df, "_text_key"), free_name(df, "_nth")
    keyed = df.withColumn(key, F.xxhash64(df[f"`{text}`"]))
    same = keyed[f"`{id}`"].eqNullSafe(chosen["_id"]) & (keyed[key] == chosen["_key"])
    first = F.row_number().over(Window.partitionBy(f"`{id}`", key).orderBy(F.lit(0)))
    return keyed.join(chosen, same, "left_semi").withColumn(nth, first).filter(F.col(nth) == 1).select(*[f"`{c}`" for c in df.columns])
