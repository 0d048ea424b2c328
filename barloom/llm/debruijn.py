"""Removal of repeated word windows by compaction of a de Bruijn graph.

An edge of the graph is a run of WIDTH words, from the node of its first to the node of its last WIDTH - 1. Only
edges whose least gram occurs more than once take part. Edges that always follow each other, in every place, are one
nonbranching path: it is found in a document as a chain of edges with a single successor and a single predecessor
each. A run sends each of its paths once, with its least source coordinate and a 128-bit digest of the words there.
Paths meet in Spark joins on their first and last edge and length, verified by the digest; of equal ones the least
source coordinate keeps its words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, signed, span_hashes, window_hashes, word_spans
from .runs import NO_ID, Run, answer_repeated, ask, ask_repeated, bucket_count, by_bucket, least_grams, make_runs, read_runs, repeated, with_answers

WIDTH, GRAM = 20, 4


class Words:
    """A run's words, its windows of WIDTH words and each window's least gram."""

    def __init__(self, run: Run):
        self.starts, self.ends, self.doc = word_spans(run.data, run.at)
        self.first = np.searchsorted(self.doc, np.arange(len(run.at)), "left")
        self.hashes = span_hashes(run.data, self.starts, self.ends)
        if len(self.hashes) >= WIDTH:
            grams = window_hashes(self.hashes, GRAM)
            self.window, self.place = least_grams(grams, self.first, WIDTH, GRAM)
            self.key = mix(grams[self.place]) >> np.uint64(24)  # least hashes are small; mixed again, they spread over the buckets
        else:
            self.window = self.place = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and places of the windows' least grams, each place once."""
        place, at = np.unique(self.place, return_index=True)
        return self.key[at], place


class Edges:
    """Windows of a run whose least gram is repeated: hash, and hashes of the window before and after (0 at a text's end)."""

    def __init__(self, words: Words, flags: np.ndarray):
        own = np.flatnonzero(flags)
        self.at = words.window[own]
        edges = window_hashes(words.hashes, WIDTH) if len(own) else np.zeros(0, np.uint64)
        self.hash = edges[self.at]
        doc = words.doc[self.at]
        short = (edges >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        has_next = self.at + WIDTH < words.first[doc + 1]
        has_prev = self.at > words.first[doc]
        self.next = np.where(has_next, short[np.minimum(self.at + 1, len(edges) - 1)] if len(own) else 0, 0).astype(np.uint32)
        self.prev = np.where(has_prev, short[np.maximum(self.at - 1, 0)] if len(own) else 0, 0).astype(np.uint32)
        self.value, self.number = np.unique(self.hash, return_inverse=True)

    def blobs(self, buckets: int):
        """Each distinct edge once: hash, a next, a previous, and bits: repeated here, several nexts, several previous."""
        if not len(self.value):
            return
        order = np.argsort(self.number, kind="stable")
        first = np.searchsorted(self.number[order], np.arange(len(self.value)))
        nxt, prv = self.next[order], self.prev[order]
        times = np.bincount(self.number)
        bits = (times > 1) | (np.minimum.reduceat(nxt, first) != np.maximum.reduceat(nxt, first)) << 1 | (np.minimum.reduceat(prv, first) != np.maximum.reduceat(prv, first)) << 2
        _, border = by_bucket(self.value >> np.uint64(24), buckets)
        for b in range(buckets):
            lo, hi = border[b], border[b + 1]
            if hi > lo:
                yield b, b"".join([self.value[lo:hi].tobytes(), nxt[first[lo:hi]].tobytes(), prv[first[lo:hi]].tobytes(), bits[lo:hi].astype(np.uint8).tobytes()])

    def flags(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Bits of every edge over all runs: repeated, several nexts, several previous."""
        _, border = by_bucket(self.value >> np.uint64(24), buckets)
        out = np.zeros(len(self.value), np.uint8)
        for b, x in answers.items():
            out[border[b] : border[b + 1]] = np.frombuffer(x, np.uint8)
        return out[self.number]


def answer_edges(blobs: list[bytes]) -> list[bytes]:
    sizes = [len(x) // 17 for x in blobs]
    part = lambda kind, width, skip: np.concatenate([np.frombuffer(x, kind, n, skip * n) for x, n in zip(blobs, sizes, strict=True)])
    edge, nxt, prv, bits = part(np.uint64, 8, 0), part(np.uint32, 4, 8), part(np.uint32, 4, 12), part(np.uint8, 1, 16)
    order = np.argsort(edge, kind="stable")
    e = edge[order]
    first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
    times = np.diff(np.append(first, len(e)))
    found = np.bitwise_or.reduceat(bits[order], first)
    found |= (times > 1).astype(np.uint8)
    for k, x in ((1, nxt[order]), (2, prv[order])):
        found |= (np.minimum.reduceat(x, first) != np.maximum.reduceat(x, first)).astype(np.uint8) << k
    back = np.empty(len(e), np.uint8)
    back[order] = np.repeat(found, times)
    ends = np.cumsum(sizes)
    return [back[b - n : b].tobytes() for b, n in zip(ends, sizes, strict=True)]


def _spaced(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words data[s:e], each with a space behind, and where each of them ends with its space."""
    size = e - s + 1
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    out = np.full(total, 0x20, np.uint8)
    index = np.arange(total) + np.repeat(s - stop + size, size)
    inner = np.ones(total, bool)
    inner[stop - 1] = False
    out[inner] = data[index[inner]]
    return out.tobytes(), stop


def _paths(run: Run, words: Words, edges: Edges, bits: np.ndarray) -> pa.RecordBatch:
    """The run's distinct paths: least coordinate and all places, those at the least coordinate first."""
    own = np.flatnonzero(bits & 1)
    at, h, bits = edges.at[own], edges.hash[own], bits[own]
    doc = words.doc[at]
    joined = np.zeros(len(at), bool)
    joined[1:] = (at[1:] == at[:-1] + 1) & (doc[1:] == doc[:-1]) & (bits[:-1] & 2 == 0) & (bits[1:] & 4 == 0)
    head = np.flatnonzero(~joined)
    tail = np.append(head[1:], len(at)) - 1 if len(head) else head
    start, last = at[head], at[tail] + WIDTH - 1
    raw, stop = _spaced(run.data, words.starts, words.ends) if len(head) else (b"", np.zeros(0, np.int64))
    begin = stop[start] - (words.ends - words.starts)[start] - 1 if len(head) else start
    digests = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), (stop[last] if len(head) else last).tolist(), strict=True))
    low, high = np.frombuffer(digests, np.int64).reshape(-1, 2).T
    ids, inside = run.ids[doc[head]], start - words.first[doc[head]]
    order = np.lexsort((inside, ids, high, low))
    low, high, ids, inside = low[order], high[order], ids[order], inside[order]
    edge = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])) if len(order) else order
    group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(order))))
    least = (ids == ids[edge][group]) & (inside == inside[edge][group])
    pick = order[edge]
    columns = [signed(h[head][pick]), signed(h[tail][pick]), (tail - head)[pick] + 1, low[edge], high[edge], ids[edge], inside[edge], np.full(len(edge), run.run_id), np.bincount(group[least], minlength=len(edge))]
    places = pa.ListArray.from_arrays(pa.array(np.append(edge, len(order)), pa.int32()), pa.array(start[order], pa.int64()))
    return pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), places], names=["head", "tail", "edges", "low", "high", "doc_id", "start", "run_id", "n_least", "places"])


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256[, kept]), one per document; kept, with texts, has the words left.

    docs needs doc_id and text; other columns are ignored. A null or empty text, and one under WIDTH words, loses
    nothing; the digest of no words is that of the empty string. A null doc_id counts as greater than all. Of rows
    that repeat a doc_id, windows at the same start are each other's equals: both stay if they are the first.
    """
    runs = make_runs(docs)
    buckets = bucket_count(runs)

    def grams(run, _):
        key, place = Words(run).grams()
        yield from ask_repeated(key, place, buckets)

    def edges_of(run: Run, answers: dict[int, bytes]) -> tuple[Words, Edges]:
        words = Words(run)
        key, place = words.grams()
        flags = np.zeros(len(words.hashes) + 1, bool)
        flags[place] = repeated(key, answers, buckets)
        return words, Edges(words, flags[words.place])

    flags = ask(runs, grams, answer_repeated, buckets)
    links = ask(with_answers(runs, flags), lambda run, answers: edges_of(run, answers)[1].blobs(buckets), answer_edges, buckets)
    both = flags.unionByName(links.selectExpr("run_id", "bucket + 1000000000 as bucket", "answer"))

    def compact(batches):
        for run, answers in read_runs(batches):
            words, edges = edges_of(run, {b: x for b, x in answers.items() if b < 1_000_000_000})
            yield _paths(run, words, edges, edges.flags({b - 1_000_000_000: x for b, x in answers.items() if b >= 1_000_000_000}, buckets))

    schema = "head long, tail long, edges long, low long, high long, doc_id long, start long, run_id long, n_least long, places array<long>"
    paths = with_answers(runs, both).mapInArrow(compact, schema)
    paths = materialize(paths, "paths")
    key = ["head", "tail", "edges", "low", "high"]
    source = paths.groupBy(key).agg(F.min(F.struct("doc_id", "start")).alias("source"), F.sum(F.size("places")).alias("n")).where("n > 1").drop("n")
    gone = F.expr("if(struct(doc_id, start) = source, slice(places, cast(n_least as int) + 1, size(places)), places)")
    again = paths.join(source, key).select("run_id", "edges", gone.alias("places")).where("size(places) > 0")
    spans = again.groupBy("run_id").agg(F.collect_list(F.struct("edges", "places")).alias("spans"))

    def finish(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                spans = row.pop("spans") or []
                places = np.array([p for x in spans for p in x["places"]], np.int64)
                sizes = np.repeat(np.array([x["edges"] for x in spans], np.int64), [len(x["places"]) for x in spans])
                yield _kept(Run(**row), places, sizes, texts)

    return runs.join(spans, "run_id", "left").mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept binary" * texts)


def _kept(run: Run, places: np.ndarray, sizes: np.ndarray, texts: bool) -> pa.RecordBatch:
    starts, ends, doc = word_spans(run.data, run.at)
    n = len(run.ids)
    edge = np.bincount(places, minlength=len(starts) + 1) - np.bincount(places + sizes + WIDTH - 1, minlength=len(starts) + 1)
    gone = np.cumsum(edge)[: len(starts)] > 0
    s, e, d = starts[~gone], ends[~gone], doc[~gone]
    raw, stop = _spaced(run.data, s, e)
    border = np.concatenate([[0], stop])[np.searchsorted(d, np.arange(n + 1))]
    kept = [raw[a : max(a, b - 1)] for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]
    count = np.bincount(doc, minlength=n)
    columns = [pa.array(run.ids, mask=run.ids == NO_ID), pa.array(count), pa.array(count - np.bincount(d, minlength=n)), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())] if texts else columns, names=[*names, "kept"] if texts else names)
