"""Shared helpers of the text operators: shared-folder tables and vectorised byte and word access."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text is worked through in slices of about this many bytes, which bounds a task's arrays.
SLICE_BYTES = 2 << 20

_M64 = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: White space and ASCII punctuation.
APART = SPACE.copy()
APART[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local session without it gets one of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "/tmp/checkpoints"
    return at


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, which cuts the lineage for good."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]] if len(at) else whole[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def give_back() -> None:
    """Hand memory that this worker's earlier tasks have freed back to the system: workers outlive their stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches, text: str = "text", limit: int = SLICE_BYTES):
    """Cut record batches by rows so that a slice has about limit bytes of text; a longer text is a slice of its own."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        _, at = buffer_of(col)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        one = np.ones(size, np.uint64)
        up, down = one * np.uint64(_P), one * np.uint64(_PINV)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def word_spans(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and text number of every word, which is a run without bytes of space (ASCII white space)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each span; ends must be above starts."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = False, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the n+1 offsets of each text's words; lower folds A-Z first."""
    data = _LOWER[data] if lower else data
    starts, ends, doc = word_spans(data, at, space)
    return span_hashes(data, starts, ends), np.searchsorted(doc, np.arange(len(at)), "left")


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of width words, over text borders too: callers drop runs that cross one."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= np.uint64(_P)
        out += words[j : j + n]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
