"""Helpers shared by the operators: table reads, the shared folder, Arrow text access."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six bytes (space and 0x09-0x0D).
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def pinned(df: DataFrame, keep: list[str], columns: list[Column]) -> DataFrame:
    """``keep`` and the aliased ``columns``, computed here and nowhere else.

    The optimizer moves a filter on a computed column below the projection and repeats the whole
    expression in it, once per use; it does not do so through a generator, so the columns come out
    of one that gives a single row.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without that setting: there a temporary folder is made and kept
    as the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are done and staged.

    Spark deletes them once the driver's JVM has collected the DataFrames that made them, which an
    idle driver seldom does by itself. The listeners may hold a finished query a moment longer, so
    it is asked twice.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def fan_out(df: DataFrame, rows: int, rows_per_task: int) -> int:
    """Partitions for ``rows`` rows: grows with the rows, at least the session's setting."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-rows // rows_per_task))


def portions(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of record batches with about ``most`` bytes of text each (one row at least), so that a
    task's memory does not follow the batch; Arrow's free memory goes back after each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        a = 0
        while a < batch.num_rows:
            done = sizes[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(a, b - a)
            a = b
        pa.default_memory_pool().release_unused()


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, count=n + 1, offset=column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the number of its first word.

    A word ends at white space or where its row ends.
    """
    n = len(raw)
    cuts = offsets[1:-1]
    word = ~_WHITE[raw]
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = word[:-1]
        before[cuts[cuts < n]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = word[1:]
        inner = cuts[cuts > 0]
        after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, the same for the same bytes everywhere.

    Words are read eight bytes at a time: each eight-byte lane is mixed into the running hash, so
    the cost is one vector step per eight bytes of the longest word still unread.
    """
    lengths = ends - starts
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded.view(np.uint8), shape=(len(raw) + 1, 8), strides=(1, 1))
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live = np.arange(len(starts))
    at, left = starts.copy(), lengths.copy()
    keep = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
    while len(live):
        lane = lanes[at].reshape(-1, 8).copy().view("<u8").ravel() & keep[np.minimum(left, 8)]
        out[live] = mix64(out[live] ^ (lane * np.uint64(0x9E3779B97F4A7C15)))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out
