"""Best-fit packing of tokenized documents into sequences.

Documents become pieces of at most a sequence's length. Pieces are then packed in rounds: every partition packs its own
items best-fit, largest first; bins that are nearly full are done; the underfull ones become items of the next round,
in which the bins of several partitions meet in one. The number of partitions falls round by round as a tree, down to
one per NODE_ITEMS underfull bins, so that no task ever holds more than its share, however large the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.bpe import encoder
from duebook.llm.common import BLOCK_BYTES, cut, text_blocks

CAPACITY = 2048
#: Items that one task packs in a round of merging.
NODE_ITEMS = 50_000
#: Partitions that meet in one at each round.
FAN_IN = 8

PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
    ]
)


def cut_lengths(tokens: int, capacity: int) -> list[int]:
    """Full pieces; only the first may be shorter."""
    full, rest = divmod(tokens, capacity)
    return [rest] * bool(rest) + [capacity] * full


def token_pieces(
    df: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every whole text: `keep`, `piece`, `start`, `length`, `ids_crc32` and, if asked for, `ids`.

    A text's ids are followed by end_id, so null and empty texts give one piece of length 1. Only texts longer than a
    sequence are cut. Columns not in `keep` are dropped; `keep` must not hold the names above.
    """
    source = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("_text"))
    added = PIECE.fields + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] * with_ids
    schema = T.StructType(source.schema.fields[:-1] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            done = 0
            for data, offsets in text_blocks(batch.column(len(keep)), 2 * BLOCK_BYTES):
                ids, bounds = bpe.encode(data, offsets)
                # The end id goes behind each text's ids.
                ids = np.insert(ids, bounds[1:], end_id).astype("<i4")
                bounds = bounds + np.arange(len(bounds))
                owner, rows, spans = [], [], []
                for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    at = a
                    for k, length in enumerate(cut_lengths(b - a, capacity)):
                        owner.append(done + i)
                        rows.append((k, at - a, length, zlib.crc32(ids[at : at + length])))
                        spans.append(at)
                        at += length
                columns = [batch.column(i).take(pa.array(owner, pa.int64())) for i in range(len(keep))]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array([*spans, len(ids)], pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                done += len(offsets) - 1
        # Python workers live on after a task; the words it met need not.
        bpe.forget()

    return source.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest first, each into the fullest bin that still takes it."""
    bins = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # bit r of rooms: some bin has room for exactly r
    sizes = lengths.tolist()
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, n
            n += 1
        bins[item] = chosen
        room -= size
        if room:
            open_bins[room].append(chosen)
            rooms |= 1 << room
    return bins


def _merge_bins(members: pa.ListArray, fill: np.ndarray, capacity: int) -> tuple[pa.ListArray, np.ndarray]:
    """Bins packed into fewer: their members end to end, with new offsets."""
    bins = best_fit(fill, capacity)
    order = np.argsort(bins, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(bins[order]) != 0))
    before = np.cumsum(fill[order]) - fill[order]
    shift = before - np.repeat(before[first], np.diff(np.append(first, len(order))))
    counts = np.asarray(pa.compute.list_value_length(members))
    lists = members.take(pa.array(order))
    flat = lists.flatten()
    at = flat.type.get_field_index("offset")
    fields = flat.flatten()
    fields[at] = pa.array(fields[at].to_numpy() + np.repeat(shift, counts[order]), pa.int64())
    flat = pa.StructArray.from_arrays(fields, fields=list(flat.type))
    ends = np.concatenate([[0], np.cumsum(counts[order])])
    upto = np.append(ends[first], ends[-1])
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), flat), np.add.reduceat(fill[order], first)


def _round(bins: DataFrame, capacity: int, slack: int) -> DataFrame:
    """Bins of each partition packed into fewer; done: no more than slack tokens are free."""
    schema = bins.select("members", "fill").schema.add("done", T.BooleanType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All bins of a partition: a few numbers for each item.
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        members, fill = table.column("members").combine_chunks(), table.column("fill").to_numpy()
        members, fill = _merge_bins(members, fill, capacity)
        done = capacity - fill <= slack
        out = pa.RecordBatch.from_arrays([members, pa.array(fill, pa.int64()), pa.array(done)], names=["members", "fill", "done"])
        yield from (out.slice(a, 5000) for a in range(0, len(out), 5000))

    return bins.select("members", "fill").mapInArrow(run, schema)


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The items with `sequence_id` and `offset`: every sequence is gapless from 0 and holds at most capacity.

    Each length is from 1 to capacity (others raise). All columns are kept; columns named `sequence_id` or `offset` are
    replaced. Equal items stay separate. No items give no rows.
    """
    kept = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    size = F.col(f"`{length}`").cast("long")
    checked = F.when(size.between(1, capacity), size).otherwise(F.raise_error(F.lit(f"lengths must be from 1 to {capacity}")).cast("long"))
    member = F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("offset"))
    bins = items.select(F.array(member).alias("members"), checked.alias("fill"))
    slack, last = capacity // 64, False
    packed = cut(_round(bins, capacity, slack))
    finished = packed.filter("done")
    left = packed.filter("not done")
    partitions = packed.rdd.getNumPartitions()
    while not last:
        n = left.count()
        nodes = max(1, -(-n // NODE_ITEMS))
        partitions = max(nodes, -(-partitions // FAN_IN))
        last = partitions == nodes
        packed = cut(_round(left.repartition(partitions), capacity, capacity if last else slack))
        finished = finished.union(packed.filter("done"))
        left = packed.filter("not done")
    names = [f"`{c}`" for c in kept]
    numbered = finished.select("members", F.monotonically_increasing_id().alias("sequence_id"))
    exploded = numbered.select("sequence_id", F.explode("members").alias("m"))
    return exploded.select(*[F.col(f"m.{c}") for c in names], "sequence_id", "m.offset")
