"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A window of WIDTH bytes has one anchor, the least hash of its K-byte grams, which is the same wherever the window's
bytes are. Only suffixes at anchors take part, and of those only the ones whose gram is in several documents. A
run sorts its suffixes, each with the bytes left of it as a tail, and sends them front-coded: shared prefix
length and the rest. A bucket merges the runs with a loser tree that keeps each head's common prefix with the last
winner, so known prefixes are never compared again. Neighbours' common prefixes then tell, for each of the
windows around an anchor, the least document that has it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import _TABLE, mix
from .runs import NO_ID, Run, answer_repeated, ask, ask_repeated, bucket_count, least_grams, make_runs, read_runs, repeated, with_answers

WIDTH, K = 50, 16
REACH = WIDTH - K  # bytes left of an anchor that a window can have
ROW = WIDTH + REACH
STEP = -(-ROW // 8)  # words of eight bytes a row
LAST = STEP - 1
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at once; their places fit the low bits of a key.
STRETCH = 1 << 15
_LOW = np.uint64((1 << 17) - 1)


def _apart(at: np.ndarray) -> np.ndarray:
    """Whether a window of WIDTH bytes that starts at each byte ends in the same text."""
    fits = np.ones(at[-1], bool)
    ends = at[1:][np.diff(at) > 0]
    late = ends[:, None] - 1 - np.arange(WIDTH - 1)
    fits[late[late >= 0]] = False
    return fits


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places of all anchors, ascending, and the 40-bit hashes of their grams.

    Of equal least hashes in a window the leftmost counts. The bytes are gone through in stretches that fit the cache.
    """
    n = len(data)
    if n < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    fits, count = _apart(at), WIDTH - K + 1
    places, hashes = [], []
    for lo in range(0, n - WIDTH + 1, STRETCH):
        hi = min(lo + STRETCH, n - WIDTH + 1)
        h, power, width = _TABLE[data[lo : hi + WIDTH - 1]], _MULT, 1
        while width < K:
            h, last = h[:-width] * power, h[width:]
            h += last
            with np.errstate(over="ignore"):
                power = power * power
            width *= 2
        h = mix(h)
        key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= count:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < count:
            key = np.minimum(key[: len(key) - (count - size)], key[count - size :])
        chosen = np.zeros(len(h), bool)
        chosen[(key & _LOW).view(np.int64)[fits[lo:hi]]] = True
        place = np.flatnonzero(chosen)
        # a gram near a stretch's end may be the next one's anchor too
        own = place[place + lo > places[-1][-1]] if places and len(places[-1]) else place
        if len(own):
            places.append(own + lo)
            hashes.append(h[own])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # least hashes are small; mixed again, they spread over the buckets
    return np.concatenate(places), mix(np.concatenate(hashes)) >> np.uint64(24)


class Contexts:
    """Distinct sorted rows around a run's repeated anchors, and which row and document each anchor has."""

    def __init__(self, run: Run, place: np.ndarray, key: np.ndarray, buckets: int):
        doc = np.searchsorted(run.at, place, "right") - 1
        self.place, self.doc = place, doc
        right, left = np.minimum(WIDTH, run.at[doc + 1] - place), np.minimum(REACH, place - run.at[doc])
        padded = np.concatenate([np.zeros(REACH, np.uint8), run.data, np.zeros(WIDTH, np.uint8)])
        step = np.concatenate([np.arange(WIDTH), -1 - np.arange(REACH)])
        rows = padded[place[:, None] + REACH + step]
        rows[:, :WIDTH][np.arange(WIDTH) >= right[:, None]] = 0
        rows[:, WIDTH:][np.arange(REACH) >= left[:, None]] = 0
        bucket = (key * np.uint64(buckets) >> np.uint64(40)).astype(np.int64)
        wide = np.zeros((len(rows), 88), np.uint8)
        wide[:, :ROW] = rows
        wide[:, ROW], wide[:, ROW + 1] = right, left
        words = wide.view(">u8").astype(np.uint64)
        ids = run.ids[doc]
        order = np.lexsort((ids, *words.T[::-1], bucket))
        words, ids, self.bucket = words[order], ids[order], bucket[order]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = (words[1:] != words[:-1]).any(1) | (self.bucket[1:] != self.bucket[:-1])
        self.row = np.empty(len(order), np.int64)
        self.row[order] = np.cumsum(new) - 1
        keep = order[new]
        self.rows, self.right, self.left, self.ids = rows[keep], right[keep].astype(np.uint8), left[keep].astype(np.uint8), ids[new]
        self.border = np.searchsorted(self.bucket[new], np.arange(buckets + 1))

    def blobs(self):
        for b in range(len(self.border) - 1):
            lo, hi = self.border[b], self.border[b + 1]
            if hi > lo:
                yield b, front_code(self.rows[lo:hi], self.right[lo:hi], self.left[lo:hi], self.ids[lo:hi])


def prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the row before; 0 for the first."""
    out = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def front_code(rows: np.ndarray, right: np.ndarray, left: np.ndarray, ids: np.ndarray) -> bytes:
    shared = prefixes(rows)
    rest = rows[np.arange(rows.shape[1]) >= shared[:, None]]
    return b"".join([np.int64(len(rows)).tobytes(), pa.compress(b"".join([ids.tobytes(), shared.tobytes(), right.tobytes(), left.tobytes(), rest.tobytes()]), "zstd", asbytes=True), np.int64(len(rows) * 11 + len(rest)).tobytes()])


def front_decode(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, shared prefixes, right and left sizes and ids of a front-coded run."""
    n, size = int(np.frombuffer(blob, np.int64, 1)[0]), int(np.frombuffer(blob[-8:], np.int64)[0])
    raw = pa.decompress(blob[8:-8], size, "zstd", asbytes=True)
    ids = np.frombuffer(raw, np.int64, n)
    shared, right, left = (np.frombuffer(raw, np.uint8, n, 8 * n + k * n) for k in range(3))
    own = np.arange(ROW) >= shared[:, None]
    rows = np.zeros((n, ROW), np.uint8)
    rows[own] = np.frombuffer(raw, np.uint8, offset=11 * n)
    source = np.maximum.accumulate(np.where(own, np.arange(n)[:, None], 0), axis=0)
    return rows[source, np.arange(ROW)], shared, right, left, ids


def merge(words: list[int], sizes: list[int], prefix: list[int]) -> tuple[list[int], list[int]]:
    """Order of all rows of sorted runs, numbered run after run, and the prefix each shares with the row before it.

    words has STEP integers a row, eight bytes each; sizes the rows of each run; prefix each row's shared prefix with
    its run's row before. In the loser tree a head's prefix is with the last winner: of two heads the one with the
    longer prefix is the less, unseen. Only at equal prefixes are the rows compared, from the word on in which the
    known prefix ends; that gives the loser's prefix with the new winner.
    """
    k = 1
    while k < len(sizes):
        k *= 2
    sizes = sizes + [0] * (k - len(sizes))
    at, total = [], 0
    for n in sizes:
        at.append(total)
        total += n
    end = [a + n for a, n in zip(at, sizes, strict=True)]
    shared = [0 if n else -1 for n in sizes]  # -1: the run is at its end

    def less(a: int, b: int, known: int) -> tuple[bool, int]:
        """Whether run a's head is the less, and the prefix of both heads; on ties a."""
        i, j, w = at[a] * STEP, at[b] * STEP, known >> 3
        while w < STEP:
            x, y = words[i + w], words[j + w]
            if x != y:
                return x < y, 8 * w + ((64 - (x ^ y).bit_length()) >> 3)
            w += 1
        return True, ROW

    # first round: winners from the leaves up, losers stay in the tree
    tree, winner = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        if shared[b] < 0:
            winner[node], tree[node] = a, b
            continue
        if shared[a] < 0:
            winner[node], tree[node] = b, a
            continue
        first, p = less(a, b, 0)
        if not first:
            a, b = b, a
        winner[node], tree[node], shared[b] = a, b, p
    w = winner[1] if k > 1 else 0
    order, out = [], []
    own = 0
    for _ in range(total):
        i = at[w]
        order.append(i)
        out.append(own)
        i += 1
        at[w] = i
        sw = prefix[i] if i < end[w] else -1
        node = (w + k) >> 1
        while node:
            o = tree[node]
            so = shared[o]
            if so > sw:
                tree[node], shared[w] = w, sw
                w, sw = o, so
            elif so == sw and so >= 0:
                # as in less, without its call
                g = so >> 3
                i, j = at[w] * STEP + g, at[o] * STEP + g
                x, y = words[i], words[j]
                while x == y and g < LAST:
                    g, i, j = g + 1, i + 1, j + 1
                    x, y = words[i], words[j]
                if x < y:
                    shared[o] = 8 * g + ((64 - (x ^ y).bit_length()) >> 3)
                elif x > y:
                    tree[node], shared[w] = w, 8 * g + ((64 - (x ^ y).bit_length()) >> 3)
                    w = o
                else:
                    shared[o] = ROW
            node >>= 1
        shared[w] = own = sw
    return order, out


def answer_masks(blobs: list[bytes]) -> list[bytes]:
    """For each row of each blob five bytes: bit o is set if the window that starts o bytes before the anchor is in a smaller document."""
    parts = [front_decode(b) for b in blobs]
    rows, prefix, right, left, ids = (np.concatenate([p[k] for p in parts]) for k in range(5))
    wide = np.zeros((len(rows), 8 * STEP), np.uint8)
    wide[:, :ROW] = rows
    order, shared = (np.array(x, np.int64) for x in merge(wide.view(">u8").ravel().tolist(), [len(p[4]) for p in parts], prefix.tolist()))
    del wide
    # the rows by document, so that the first of equal windows is the least document's
    by = np.argsort(ids[order], kind="stable")
    row = order[by]
    rows, right, left, ids = rows[row], right[row].astype(np.int64), left[row].astype(np.int64), ids[row]
    masks, tail = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
    for o in range(REACH + 1):
        if o:
            tail = mix(tail * _MULT + rows[:, WIDTH + o - 1])
        apart = shared < WIDTH - o
        # rows that share too little with both neighbours are alone
        company = ~(apart & np.append(apart[1:], True))[by]
        own = np.flatnonzero(company & (left >= o) & (right >= WIDTH - o))
        if not len(own):
            continue
        group = np.cumsum(apart).astype(np.uint64)[by[own]]
        number, _ = pd.factorize(mix(tail[own] * _MULT + group))
        first = np.empty(int(number.max()) + 1, np.int64)
        first[number[::-1]] = own[::-1]
        masks[own[ids[first[number]] < ids[own]]] |= np.uint64(1 << o)
    back = np.empty(len(rows), np.uint64)
    back[row] = masks
    raw = back.view(np.uint8).reshape(-1, 8)[:, :5]
    out, lo = [], 0
    for p in parts:
        out.append(pa.compress(raw[lo : lo + len(p[4])].tobytes(), "zstd", asbytes=True))
        lo += len(p[4])
    return out


def covered(run: Run, contexts: Contexts, answers: dict[int, bytes]) -> np.ndarray:
    """Which bytes of a run are in a window that a smaller document has."""
    masks = np.zeros((len(contexts.ids), 8), np.uint8)
    for b, x in answers.items():
        lo, hi = contexts.border[b], contexts.border[b + 1]
        masks[lo:hi, :5] = np.frombuffer(pa.decompress(x, 5 * (hi - lo), "zstd", asbytes=True), np.uint8).reshape(-1, 5)
    mask = masks.view(np.uint64).ravel()[contexts.row]
    offsets = np.arange(REACH + 1)
    hit = (mask[:, None] >> offsets.astype(np.uint64) & np.uint64(1)).astype(bool)
    # the same row in a smaller document of this run: all its windows
    later = run.ids[contexts.doc] > contexts.ids[contexts.row]
    fits = (contexts.left[contexts.row][:, None] >= offsets) & (contexts.right[contexts.row][:, None] >= WIDTH - offsets)
    hit |= later[:, None] & fits
    which, o = np.nonzero(hit)
    edge = np.zeros(len(run.data) + 1, np.int64)
    start = contexts.place[which] - o
    edge += np.bincount(start, minlength=len(edge))
    edge -= np.bincount(start + WIDTH, minlength=len(edge))[: len(edge)]
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), one per document; kept, with texts, has the bytes left.

    docs needs doc_id and text; other columns are ignored. A null text counts as empty: nothing removed, digest of
    the empty string. A text under WIDTH bytes has no window. A null doc_id counts as greater than all. Rows with one
    doc_id are the same document to each other: neither removes the other's bytes.
    """
    runs = make_runs(docs)
    buckets = bucket_count(runs)

    def first(run, _):
        place, key = anchors(run.data, run.at)
        yield from ask_repeated(key, run.ids[np.searchsorted(run.at, place, "right") - 1], buckets)

    def around(run: Run, answers: dict[int, bytes]) -> Contexts:
        place, key = anchors(run.data, run.at)
        keep = repeated(key, answers, buckets)
        return Contexts(run, place[keep], key[keep], buckets)

    flags = ask(runs, first, answer_repeated, buckets)
    flagged = with_answers(runs, flags)
    masks = ask(flagged, lambda run, answers: around(run, answers).blobs(), answer_masks, buckets)
    both = flags.selectExpr("run_id", "bucket", "answer").unionByName(masks.selectExpr("run_id", "bucket + 1000000000 as bucket", "answer"))

    def finish(batches):
        for run, answers in read_runs(batches):
            contexts = around(run, {b: x for b, x in answers.items() if b < 1_000_000_000})
            gone = covered(run, contexts, {b - 1_000_000_000: x for b, x in answers.items() if b >= 1_000_000_000})
            yield kept_rows(run, gone, texts)

    return with_answers(runs, both).mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)


def kept_rows(run: Run, gone: np.ndarray, texts: bool) -> pa.RecordBatch:
    n = len(run.ids)
    total = np.concatenate([[0], np.cumsum(gone)])
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begins[run.at[:-1][np.diff(run.at) > 0]] |= gone[run.at[:-1][np.diff(run.at) > 0]]
    spans = np.concatenate([[0], np.cumsum(begins)])
    left = run.data[~gone].tobytes()
    at = (run.at - total[run.at]).tolist()
    kept = [left[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    columns = [pa.array(run.ids, mask=run.ids == NO_ID), pa.array(np.diff(run.at)), pa.array(np.diff(total[run.at])), pa.array(np.diff(spans[run.at])), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
    assert len(kept) == n
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())] if texts else columns, names=[*names, "kept"] if texts else names)
