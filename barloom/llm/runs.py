"""Runs: documents bundled into blocks of a few megabytes, and questions that all runs ask of one another.

A run asks by bucket: it sends each bucket one sorted blob, and gets back an answer in the blob's own order. So
only hashes or front-coded strings travel, each distinct one once a run however often a hot passage repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, materialize, slices

RUN_BYTES = 2 << 20
#: Runs are stored and joined compressed.
LEVEL = 6
#: Text bytes that one bucket stands for; what reaches a bucket is a part of that.
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 24
#: Stands for a doc_id that is null: above all others.
NO_ID = (1 << 63) - 1
SCHEMA = "run_id long, ids binary, at binary, data binary, size long"


class Run:
    """A run's document ids, byte offsets and bytes."""

    def __init__(self, run_id: int, ids: bytes, at: bytes, data: bytes, size: int):
        self.run_id = run_id
        self.ids, self.at = np.frombuffer(ids, np.int64), np.frombuffer(at, np.int64)
        self.data = np.frombuffer(pa.decompress(data, size, "zstd"), np.uint8) if size else np.zeros(0, np.uint8)


def make_runs(docs: DataFrame) -> DataFrame:
    """Runs of docs(doc_id, text), written once, so that a run is the same wherever it is read again."""

    def bundle(batches):
        part_id = TaskContext.get().partitionId()
        for k, part in enumerate(slices(batches, limit=RUN_BYTES)):
            data, at = buffer_of(part.column("text"))
            ids = np.asarray(part.column("doc_id").fill_null(NO_ID))
            packed = pa.Codec("zstd", compression_level=LEVEL).compress(np.ascontiguousarray(data), asbytes=True) if len(data) else b""
            yield pa.RecordBatch.from_arrays([pa.array([part_id << 32 | k]), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), at.astype(np.int64).tobytes(), packed)), pa.array([len(data)])], names=["run_id", "ids", "at", "data", "size"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return materialize(rows.mapInArrow(bundle, SCHEMA), "runs")


def bucket_count(runs: DataFrame) -> int:
    total = runs.agg(F.sum("size")).first()[0] or 0
    return max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))


def read_runs(batches) -> Iterator[tuple[Run, dict[int, bytes]]]:
    """Runs with their answers by bucket, where a column `answers` holds them."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            answers = {a["bucket"]: a["answer"] for a in row.pop("answers", None) or ()}
            yield Run(**row), answers


def ask(runs: DataFrame, question: Callable[[Run, dict[int, bytes]], Iterator[tuple[int, bytes]]], answer: Callable[[list[bytes]], list[bytes]], buckets: int) -> DataFrame:
    """Answers (run_id, bucket, answer): answer gets a bucket's blobs, in no fixed order, and returns one for each."""

    def send(batches):
        for run, answers in read_runs(batches):
            rows = list(question(run, answers))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([run.run_id] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "run_id", "blob"])

    def reply(table: pa.Table) -> pa.Table:
        got = answer(table.column("blob").to_pylist())
        return pa.table({"run_id": table.column("run_id"), "bucket": table.column("bucket"), "answer": pa.array(got, pa.binary())})

    sent = runs.mapInArrow(send, "bucket int, run_id long, blob binary").repartition(buckets, "bucket")
    return sent.groupBy("bucket").applyInArrow(reply, "run_id long, bucket int, answer binary")


def with_answers(runs: DataFrame, answers: DataFrame) -> DataFrame:
    """runs with a column of their answers; one that asked nothing has none."""
    by_run = answers.groupBy("run_id").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
    return runs.join(by_run, "run_id", "left")


_PLACE = np.uint64((1 << 24) - 1)


def least_grams(h: np.ndarray, at: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of width symbols inside a text, by their starts, and the place of each window's least gram hash.

    h are the hashes of all grams of gram symbols, at the texts' borders in symbols. Equal windows have their least
    gram at the same offset; of equal hashes the leftmost counts.
    """
    count = width - gram + 1
    key = (h & ~_PLACE) | (np.arange(len(h), dtype=np.uint64) & _PLACE)
    size = 1
    while 2 * size <= count:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < count:
        key = np.minimum(key[: len(key) - (count - size)], key[count - size :])
    inside = np.zeros(at[-1] + 1, np.int32)
    own = np.diff(at) >= width
    np.add.at(inside, at[:-1][own], 1)
    np.add.at(inside, at[1:][own] - width + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[: len(key)] > 0)
    low = (key[start] & _PLACE).astype(np.int64)
    return start, start + ((low - start) & int(_PLACE))


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts 40-bit keys by bucket, then key, and the buckets' borders in it. Buckets are ranges of keys."""
    order = np.argsort(keys, kind="stable")
    edges = np.arange(buckets + 1, dtype=np.uint64) * np.uint64(1 << 40) // np.uint64(buckets)
    return order, np.searchsorted(keys[order], edges)


def ask_repeated(keys: np.ndarray, docs: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Question whether a key (40 bits) is in several documents: each distinct key once, five bytes, and whether this run knows.

    docs may number anything that counts as apart, such as the keys' places.
    """
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    if not len(k):
        return
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    last = np.append(first[1:], len(k)) - 1
    several = d[first] != d[last]
    k = k[first]
    _, border = by_bucket(k, buckets)
    raw = k.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    for b in range(buckets):
        lo, hi = border[b], border[b + 1]
        if hi > lo:
            yield b, several[lo:hi].tobytes() + raw[lo:hi].tobytes()


def answer_repeated(blobs: list[bytes]) -> list[bytes]:
    """Bits, in each blob's order, of the keys that are in several documents."""
    keys, known, sizes = [], [], []
    for x in blobs:
        n = len(x) // 6
        sizes.append(n)
        known.append(np.frombuffer(x, bool, n))
        wide = np.zeros((n, 8), np.uint8)
        wide[:, 3:] = np.frombuffer(x, np.uint8, offset=n).reshape(n, 5)
        keys.append(wide.view(">u8").ravel().astype(np.uint64))
    key, several = np.concatenate(keys), np.concatenate(known)
    value, place, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times > 1
    np.logical_or.at(again, place[several], True) if several.any() else None
    flags = again[place]
    out, lo = [], 0
    for n in sizes:
        out.append(np.packbits(flags[lo : lo + n]).tobytes())
        lo += n
    return out


def repeated(keys: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """For each of this run's keys whether it is in several documents, from the answers to ask_repeated."""
    value, place = np.unique(keys, return_inverse=True)
    _, border = by_bucket(value, buckets)
    flags = np.zeros(len(value), bool)
    for b, x in answers.items():
        lo, hi = border[b], border[b + 1]
        flags[lo:hi] = np.unpackbits(np.frombuffer(x, np.uint8), count=hi - lo).astype(bool)
    return flags[place]
