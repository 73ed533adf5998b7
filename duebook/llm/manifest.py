"""Merkle manifest of a dataset: leaves placed by bitmap ranks, levels reduced through slot arrays.

A leaf is the digest of a row's fields. Its place among the leaves of its group is the rank of its id, and no ids are
sorted for it: the ids of a group are a compressed bitmap of 64-bit words that partial sums merge by `bit_or`; words that
hold no id are left out. 64 words make a container, which knows by a mask which of its words there are, and by a directory
of popcounts how many rows lie before each of them. Containers are summed in a tree with a fan of 1024, so that neither a
group nor a range of ids ever lies in one task. A row's rank is then its container's base, the directory's count and the
popcount of its word below its bit.

Levels are reduced by key: node p goes to slot p mod 16 of run p div 16, and the run's digest is that of its slots in
order. Then the siblings come down the same way, a run at a time, so that a row gets its proof with its run.

Rows that share an id (or have none) are ordered by their leaf; equal leaves of one id are interchangeable. Rows without
an id come first. Sources are ordered by their bytes, null first. An empty table gives an empty manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm.common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
#: Bits of an id within a word, of a word within a container, of a node within its parent.
WORD, CONTAINER, FAN = 6, 6, 10
#: Container of the rows without an id; as a node it is -1, as are its ancestors, and so comes before all others.
NO_ID = -(1 << 63)
#: A tie of rows with one id is broken in pieces by so many hex digits of the leaf.
TIE_DIGITS = 4


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def spelled(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row: dict[str, Column]) -> Column:
    return digest(*[spelled(c) for c in row.values()])


def bits_below(place: Column) -> Column:
    """A mask of the bits below this one."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), place.cast("int")))


def one_bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def container_of(id: Column) -> Column:
    return F.coalesce(F.shiftright(id, WORD + CONTAINER), F.lit(NO_ID))


# ---- ranks --------------------------------------------------------------------------------------------------------


def containers(ids: DataFrame) -> DataFrame:
    """(tree, container, rows, mask, words, before) of the rows (tree, id): the bitmaps with their directories."""
    low, word = F.col("id").bitwiseAND(63), F.shiftright("id", WORD)
    single = ids.groupBy("tree", "id").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > 1, F.struct(low.alias("low"), (F.col("n") - 1).alias("more")))
    words = single.groupBy("tree", word.alias("word")).agg(
        F.bit_or(one_bit(low)).alias("bits"), F.sum("n").alias("rows"), F.collect_list(more).alias("repeats")
    )
    slot = F.col("word").bitwiseAND(63)
    found = words.groupBy("tree", F.coalesce(F.shiftright("word", CONTAINER), F.lit(NO_ID)).alias("container")).agg(
        F.sum("rows").alias("rows"),
        F.bit_or(one_bit(slot)).alias("mask"),
        F.map_from_entries(F.collect_list(F.struct(F.coalesce(slot, F.lit(0)), F.struct("bits", "rows", "repeats")))).alias("by_slot"),
    )
    present = F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.try_element_at("by_slot", i.cast("long"))), lambda w: w.isNotNull())
    found = found.withColumn("words", present).drop("by_slot")
    counts = F.aggregate("words", F.array(F.lit(0).cast("long")), lambda a, w: F.concat(a, F.array(F.element_at(a, -1) + w["rows"])))
    return found.withColumn("before", counts)


def with_bases(found: DataFrame) -> DataFrame:
    """The containers with `base`, the rows of their tree before them, and `total`, all rows of the tree.

    Sums climb a tree of nodes with 1024 children each, as many levels as the range of ids needs, and come down again.
    """
    span = found.filter(F.col("container") != NO_ID).agg(F.min("container"), F.max("container")).first()
    low, high = (span[0], span[1]) if span[0] is not None else (0, 0)
    node = F.when(F.col("container") == NO_ID, -1).otherwise(F.col("container") - low)
    found = found.withColumn("node", node)
    nodes, most = [found.select("tree", "node", "rows")], high - low
    while most >= 1 << FAN:
        nodes.append(nodes[-1].groupBy("tree", F.shiftright("node", FAN).alias("node")).agg(F.sum("rows").alias("rows")))
        most >>= FAN
    before = lambda *by: F.coalesce(F.sum("rows").over(Window.partitionBy(*by).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = nodes.pop()
    total = F.sum("rows").over(Window.partitionBy("tree"))
    placed = top.select("tree", "node", before("tree").alias("base"), total.alias("total"))
    while nodes:
        below = nodes.pop()
        own = below.select("tree", "node", F.shiftright("node", FAN).alias("parent"), before("tree", F.shiftright("node", FAN)).alias("own"))
        parents = placed.withColumnRenamed("node", "parent")
        placed = own.join(parents, ["tree", "parent"]).select("tree", "node", (F.col("base") + F.col("own")).alias("base"), "total")
    return found.drop("rows").join(placed, ["tree", "node"]).drop("node")


def with_rank(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """The rows (tree, id, …) with `pos`, how many rows of their tree have a smaller id, `total`, and `tied`."""
    joined = rows.withColumn("container", container_of(F.col("id"))).join(directory, ["tree", "container"])
    slot, low = F.shiftright("id", WORD).bitwiseAND(63), F.col("id").bitwiseAND(63)
    place = F.coalesce(F.bit_count(F.col("mask").bitwiseAND(bits_below(slot))), F.lit(0))
    joined = joined.withColumn("place", place).withColumn("word", F.element_at("words", F.col("place") + 1))
    inside = F.coalesce(F.bit_count(F.col("word.bits").bitwiseAND(bits_below(low))), F.lit(0))
    repeated = F.aggregate(F.filter("word.repeats", lambda r: r["low"] < low), F.lit(0).cast("long"), lambda n, r: n + r["more"])
    pos = F.col("base") + F.element_at("before", F.col("place") + 1) + inside + repeated
    tied = F.exists("word.repeats", lambda r: r["low"].eqNullSafe(low))
    return joined.select(*rows.columns, pos.alias("pos"), "total", tied.alias("tied"))


def without_ties(rows: DataFrame) -> DataFrame:
    """Rows of one id get places of their own, by their leaf; no id's rows meet in one task.

    Leaves are counted by their first digits and by the part of the input they come from; both are summed up before, so
    that a row needs its number only among equal leaves of its own part.
    """
    own, tied = rows.filter(~F.col("tied")), cut(rows.filter("tied").withColumn("part", F.spark_partition_id()))
    key = ["tree", "pos"]
    bucket = F.substring("leaf", 1, TIE_DIGITS).alias("bucket")
    counts = tied.groupBy(*key, bucket, "leaf", "part").agg(F.count("*").alias("n"))
    buckets = counts.groupBy(*key, "bucket").agg(F.sum("n").alias("n"))
    earlier = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    outer = buckets.select(*key, "bucket", earlier(key, ["bucket"]).alias("outer"))
    inner = counts.select(*key, "bucket", "leaf", "part", earlier([*key, "bucket"], ["leaf", "part"]).alias("inner"))
    first = inner.join(outer, [*key, "bucket"]).select(*key, "leaf", "part", (F.col("inner") + F.col("outer")).alias("first"))
    nth = F.row_number().over(Window.partitionBy(*key, "leaf", "part").orderBy(F.lit(0))) - 1
    settled = tied.withColumn("nth", nth).join(first, [*key, "leaf", "part"]).withColumn("pos", F.col("pos") + F.col("first") + F.col("nth"))
    return own.union(settled.select(*rows.columns))


# ---- levels -------------------------------------------------------------------------------------------------------


def runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, total, run, slots): each 16 consecutive nodes (tree, pos, total, digest, …) as an array in order."""
    slot = F.struct(F.pmod("pos", F.lit(ARITY)).cast("int"), F.struct("digest", *carried))
    keyed = nodes.groupBy("tree", "total", F.floor(F.col("pos") / ARITY).alias("run")).agg(F.map_from_entries(F.collect_list(slot)).alias("by_slot"))
    slots = F.transform(F.sequence(F.lit(0), F.size("by_slot") - 1), lambda i: F.element_at("by_slot", i))
    return keyed.select("tree", "total", "run", slots.alias("slots"))


def reduced(of: DataFrame) -> DataFrame:
    """The nodes (tree, pos, total, digest) that runs become; a run that is its tree's only leaf stays as it is."""
    whole = F.sha2(F.array_join(F.col("slots")["digest"], ""), 256)
    one = F.when(F.col("total") == 1, F.col("slots")[0]["digest"]).otherwise(whole)
    return of.select("tree", F.col("run").alias("pos"), F.ceil(F.col("total") / ARITY).alias("total"), one.alias("digest"))


@dataclass
class Levels:
    """The runs of each level of many trees, lowest first, and the `tops` (tree, digest, level) they come to."""

    runs: list[DataFrame]
    tops: DataFrame


def levels(nodes: DataFrame, most: int, *carried: str) -> Levels:
    """most: nodes of the largest tree."""
    every, tops = [], None
    while not every or most > 1:
        every.append(cut(runs(nodes, *(carried if not every else ()))))
        most = -(-most // ARITY)
        up = reduced(every[-1])
        done = up.filter("total = 1").select("tree", "digest", F.lit(len(every)).alias("level"))
        tops = done if tops is None else tops.union(done)
        nodes = up.filter("total > 1")
    return Levels(every, cut(tops))


def siblings(paths: DataFrame, of: DataFrame, *carried: str) -> DataFrame:
    """One level down: each slot of the runs with `above`, its siblings level by level, and what its run carries."""
    names = [c for c in paths.columns if c not in ("tree", "pos", "above")]
    met = of.join(paths.withColumnRenamed("pos", "run"), ["tree", "run"])
    one = met.select("tree", "total", "run", "above", "slots", *names, F.posexplode("slots").alias("i", "slot"))
    joined = lambda some: F.array_join(F.transform(some, lambda s: s["digest"]), "")
    own = F.struct(
        joined(F.slice("slots", F.lit(1), F.col("i"))).alias("left"),
        joined(F.slice("slots", F.col("i") + 2, F.lit(ARITY))).alias("right"),
    )
    above = F.when(F.col("total") == 1, F.col("above")).otherwise(F.concat(F.array(own), "above"))
    pos = (F.col("run") * ARITY + F.col("i")).alias("pos")
    return one.select("tree", pos, above.alias("above"), *names, *[F.col("slot")[c].alias(c) for c in carried])


def descend(of: Levels, tops: DataFrame, *carried: str) -> DataFrame:
    """The siblings of every lowest node; tops: (tree, level, above, …) with what lies above each tree."""
    paths = None
    for level in range(len(of.runs), 0, -1):
        start = tops.filter(F.col("level") == level).drop("level").withColumn("pos", F.lit(0).cast("long"))
        paths = start if paths is None else start.unionByName(paths)
        paths = siblings(paths, of.runs[level - 1], *(carried if level == 1 else ()))
    return paths


def in_order(tops: DataFrame) -> DataFrame:
    """The tops with `pos`, their place by the name of their tree; ranges are numbered side by side."""
    ranged = cut(tops.repartitionByRange("tree").withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("tree")) - 1
    numbered = ranged.withColumn("nth", nth).join(sizes.select("part", before.alias("before")), "part")
    return numbered.select("tree", "digest", "level", (F.col("before") + F.col("nth")).alias("pos"))


def manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, id: str = "doc_id", group: str = "source", other: dict[str, Column] | None = None) -> DataFrame:
    """Per row: `id`, `leaf`, `other`, `subroot`, `root`, and `above`, the siblings (left, right) from the leaf's level up.

    other: changed fields; `other` is the leaf with those, null where any of them is null. The id is a long. Columns that
    are not fields are ignored, so names cannot clash.
    """
    row = {f: df[f"`{f}`"] for f in fields}
    tree = F.coalesce(F.concat(F.lit(":"), row[group]), F.lit("-")).alias("tree")  # "-" sorts before ":"
    ids = df.select(tree, row[id].cast("long").alias("id"))
    changed = F.lit(None).cast("string")
    if other:
        given = other.values()
        changed = F.when(F.greatest(*[c.isNull().cast("int") for c in given], F.lit(0)) == 0, leaf_of(row | other))
    leaves = df.select(tree, row[id].cast("long").alias("id"), leaf_of(row).alias("leaf"), changed.alias("other"))
    found = cut(containers(ids))
    directory = with_bases(found)
    most = found.groupBy("tree").agg(F.sum("rows").alias("n")).agg(F.max("n"), F.count("*")).first()
    placed = with_rank(leaves, directory)
    if not found.filter(F.exists("words", lambda w: F.size(w["repeats"]) > 0)).isEmpty():
        placed = without_ties(placed)
    placed = placed.withColumn("digest", F.col("leaf"))
    own = levels(placed, most[0] or 0, "id", "leaf", "other")
    sources = cut(in_order(own.tops))
    everything = F.lit("").alias("tree")
    upper = levels(sources.select(everything, "pos", F.lit(most[1]).cast("long").alias("total"), "digest"), most[1])
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    root = upper.tops.select("tree", "level", nothing.alias("above"), F.col("digest").alias("root"))
    upon = descend(upper, root).drop("tree")
    tops = cut(sources.join(upon, "pos").select("tree", "level", "above", "root", F.col("digest").alias("subroot")))
    return descend(own, tops, "id", "leaf", "other").select("id", "leaf", "other", "subroot", "root", "above")


def proof(above: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(above, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, above: Column) -> Column:
    """The root that a leaf comes to with these siblings."""
    return F.aggregate(above, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
