"""Helpers the operators share: Arrow text as numpy arrays, bounded blocks, cut lineage."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text an operator works on at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each begins (one more at the end). Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(texts) else data[:0], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold at most so many bytes, or a single longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def text_blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of one block of texts after the other."""
    data, offsets = utf8(texts)
    for a, b in blocks(offsets, most):
        yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def each_text(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    whole, at = data.tobytes(), offsets.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:])]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table less columns that an operator is about to add; names match without regard to case."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Spark's own bound for the bytes of an Arrow batch, and the one used here: a task holds several copies of a batch.
DEFAULT_BATCH, BATCH = 64 << 20, 4 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session that has not set a bound, and let workers on this machine import the package.

    A cluster gets the package as --py-files.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) in (f"{DEFAULT_BATCH}b", "64m", "64MB", str(DEFAULT_BATCH)):
        spark.conf.set(bound, str(BATCH))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that the session names. Only a local session may name none; it has one in its warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints").rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the folder all executors share."""
    spark: SparkSession = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def release(*frames: DataFrame | None) -> None:
    """Delete what cut frames keep. Nothing that still is to be computed may read them."""
    for df in frames:
        if df is not None:
            file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
            if file.isDefined():
                delete(df.sparkSession, file.get())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
