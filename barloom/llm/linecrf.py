"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence is a table look-up of its own and its neighbours' binned features; a
transition weight ties neighbours. Only documents are labelled, so their lines' labels are hidden: after a start from
the documents' labels, training pulls each line towards its document's label by fixed log odds, takes the marginals
under that pull as what is expected of the lines, and lets lines that look otherwise keep their own label.
A document's quality is the mean of its lines' marginal probabilities of good, weighted by their length, and turned
into a probability by a rising logistic curve that is fitted on the labelled documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, mix, signed, slices, span_hashes, word_spans
from .langid import is_held_out

#: About this many labelled rows, drawn by a hash of doc_id, train the field, and up to so many lines of each.
ROWS, LINES = 4000, 500
BINS, COMMON = 8, 200
#: Steps in all, and how many of them take each line to have its document's label.
STEPS, START, RATE, DECAY = 150, 20, 0.08, 1e-3
#: Log odds by which a document's label pulls its lines.
PULL = 1.0
#: Greatest weight of equal neighbours: one label a document would drive it up until all its lines are alike.
MAX_STAY = 1.0

_KINDS = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": (32, 9, 11, 12, 13),
    "symbol": b"#*$%&|<>@^~_=+\\/{}[]",
    "stop": b".,;:!?",
    "far": range(128, 256),
}


def lines_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every line and the first line of each text; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    text = np.searchsorted(at, breaks, "right") - 1
    first = np.arange(len(at)) + np.searchsorted(breaks, at, "left")
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    starts[first[:-1]] = at[:-1]
    own = np.arange(len(breaks)) + text
    starts[own + 1], ends[own] = breaks + 1, breaks
    ends[first[1:] - 1] = at[1:]
    return starts, ends, first


def features(data: np.ndarray, at: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, k) of all lines, the first line of each text and the lines' sizes in bytes."""
    starts, ends, first = lines_of(data, at)
    size = (ends - starts).astype(np.float32)
    wide = np.maximum(size, 1)
    out = [np.log1p(size)]
    for own in _KINDS.values():
        table = np.zeros(256, np.int8)
        table[list(own)] = 1
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(table[data], out=total[1:], dtype=np.int32)
        out.append((total[ends] - total[starts]) / wide)
    ws, we, _ = word_spans(data, at)
    hashes = span_hashes(data, ws, we)
    lo, hi = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    count = (hi - lo).astype(np.float32)
    known = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(np.isin(hashes, common), out=known[1:])
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        near = np.zeros(len(hashes), bool)
        near[1:] |= hashes[1:] == hashes[:-1]
        near[2:] |= hashes[2:] == hashes[:-2]
        np.cumsum(near, out=same[1:])
    full = np.maximum(count, 1)
    out += [np.log1p(count), wide / full, (known[hi] - known[lo]) / full, (same[hi] - same[lo]) / full]
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    key = span_hashes(data, starts, np.maximum(ends, starts)) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, again, times = np.unique(key, return_inverse=True, return_counts=True)
    out.append(np.where(size > 0, np.log1p(times[again] - 1), 0))
    out.append(np.log1p(np.diff(first))[text])
    return np.stack(out, 1).astype(np.float32), first, size


class Field:
    """Weights look[offset + 1, feature, bin] of a line's and its neighbours' bins, and stay, the pull of equal neighbours."""

    def __init__(self, edges: np.ndarray, common: np.ndarray):
        self.edges, self.common = edges, common
        self.look = np.zeros((3, len(edges), BINS + 1))
        self.bias, self.stay = 0.0, 0.0
        self.slope, self.shift = 1.0, 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right").astype(np.int8) for k, e in enumerate(self.edges)], 1)

    def around(self, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bins (3, lines, k) of the line before, the line and the line after; BINS where there is none."""
        none = np.full((1, bins.shape[1]), BINS, bins.dtype)
        before, after = np.concatenate([none, bins[:-1]]), np.concatenate([bins[1:], none])
        before[first[:-1]], after[first[1:] - 1] = BINS, BINS
        return np.stack([before, bins, after])

    def evidence(self, near: np.ndarray) -> np.ndarray:
        k = np.arange(near.shape[2])
        return self.bias + sum(self.look[o, k, near[o]].sum(1) for o in range(3))

    def marginals(self, evidence: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and P(line and the next are equal) where a next one is, 0 elsewhere.

        The log odds of both passes run over all texts at once, the longest ones first, a line at a time.
        """
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        start, size = first[:-1][order], size[order]
        fwd, bwd = np.zeros(len(evidence)), np.zeros(len(evidence))
        # log odds that a message of log odds m carries over a link: log((e^s e^m + 1) / (e^m + e^s))
        pass_on = lambda m: np.logaddexp(self.stay + m, 0) - np.logaddexp(m, self.stay)
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if len(size) else []
        for t in range(1, len(live)):
            at = start[: live[t]] + t
            fwd[at] = pass_on(fwd[at - 1] + evidence[at - 1])
        for t in range(1, len(live)):
            at = start[: live[t]] + size[: live[t]] - 1 - t
            bwd[at] = pass_on(bwd[at + 1] + evidence[at + 1])
        good = 1 / (1 + np.exp(-np.clip(fwd + bwd + evidence, -500, 500)))
        equal = np.zeros(len(evidence))
        has = np.ones(len(evidence), bool)
        has[first[1:] - 1] = False
        i = np.flatnonzero(has)
        a, b = fwd[i] + evidence[i], bwd[i + 1] + evidence[i + 1]
        same = self.stay + np.logaddexp(a + b, 0)
        equal[i] = 1 / (1 + np.exp(np.clip(np.logaddexp(a, b) - same, -500, 500)))
        return good, equal

    def fit(self, x: np.ndarray, first: np.ndarray, label: np.ndarray, size: np.ndarray) -> Field:
        """Adam on the mean log likelihood of the documents' labels, less a penalty on the weights."""
        near = self.around(self.bins(x), first)
        y = np.repeat(label, np.diff(first)).astype(float)
        pull = PULL * (2 * y - 1)
        k = near.shape[2]
        flat = ((np.arange(3)[:, None, None] * k + np.arange(k)) * (BINS + 1) + near).astype(np.int32)
        n = len(y)
        linked = np.ones(n, bool)
        linked[first[1:] - 1] = False
        theta, m, v = np.zeros(3 * k * (BINS + 1) + 2), 0.0, 0.0
        theta[-2] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
        for t in range(1, STEPS + 1):
            theta[-1] = min(max(theta[-1], 0.0), MAX_STAY) if t > START else 0.0
            self._set(theta)
            evidence = self.evidence(near)
            good, equal = self.marginals(evidence, first)
            want, same = (y, 1.0) if t <= START else self.marginals(evidence + pull, first)
            gap = want - good
            g = np.zeros_like(theta)
            for o in range(3):
                g[:-2] += np.bincount(flat[o].ravel(), np.repeat(gap, k), minlength=len(theta) - 2)
            g[-2], g[-1] = gap.sum(), (same - equal)[linked].sum()
            g = g / n - DECAY * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        theta[-1] = min(max(theta[-1], 0.0), MAX_STAY)
        self._set(theta)
        good, _ = self.marginals(self.evidence(near), first)
        self._curve(self._mean(good, size, first), label.astype(float))
        return self

    @staticmethod
    def _mean(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of each text's mean marginal, lines weighing their bytes and one more."""
        weight = size + 1.0
        mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def _curve(self, odds: np.ndarray, label: np.ndarray) -> None:
        """Logistic curve of the labels over the log odds, by Newton steps with a small penalty; never falling."""
        w = np.array([1.0, 0.0])
        x = np.stack([odds, np.ones_like(odds)], 1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (label - p) - (w - [1.0, 0.0])
            w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), grad)
            w[0] = max(w[0], 0.05)
        self.slope, self.shift = float(w[0]), float(w[1])

    def _set(self, theta: np.ndarray) -> None:
        self.look, self.bias, self.stay = theta[:-2].reshape(self.look.shape), float(theta[-2]), float(theta[-1])

    def quality(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's probability of label 1; P(good) of all lines and the first line of each text."""
        x, first, size = features(data, at, self.common)
        good, _ = self.marginals(self.evidence(self.around(self.bins(x), first)), first)
        return 1 / (1 + np.exp(-np.clip(self.slope * self._mean(good, size, first) + self.shift, -500, 500))), good, first


def _counted(batches):
    """(word, n) of each slice's words, by hash."""
    for part in slices(batches):
        data, at = buffer_of(part.column("text"))
        starts, ends, _ = word_spans(data, at)
        value, times = np.unique(span_hashes(data, starts, ends), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(value)), pa.array(times)], names=["word", "n"])


def _stretch(lines: int, doc_id: int) -> slice:
    """The lines of a document that training takes: all, or LINES in a row from a place drawn by doc_id."""
    if lines <= LINES:
        return slice(0, lines)
    start = int(mix(np.array([doc_id], np.int64).view(np.uint64))[0] % np.uint64(lines - LINES + 1))
    return slice(start, start + LINES)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Field | None:
    """Fit on about rows labelled documents outside the held-out fifth, drawn by a hash of doc_id; None without any.

    Of each at most LINES neighbouring lines are taken. Tasks count the words and make the features; the driver gets no text, but
    COMMON words and the features of rows * LINES lines at most.
    """
    known = labels.where(~is_held_out() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    count = known.count()
    if not count:
        return None
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, rows / count) * (1 << 30)))
    # the draw is bounded by rows, so it may be broadcast
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    counts = chosen.mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), F.col("word").bitwiseXOR(F.lit(-(1 << 63)))).limit(COMMON).toArrow()
    common = np.sort(np.asarray(top.column("word").combine_chunks(), np.int64).view(np.uint64)) if top.num_rows else np.zeros(0, np.uint64)

    def measured(batches):
        for part in slices(batches):
            x, first, size = features(*buffer_of(part.column("text")), common)
            own = [slice(lo + t.start, lo + t.stop) for i, lo, hi in zip(part.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True) for t in [_stretch(hi - lo, i)]]
            blobs = [pa.array([a[t].astype("<f4").tobytes() for t in own], pa.binary()) for a in (x, size)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality").cast(pa.int32()), *blobs], names=["doc_id", "quality", "x", "size"])

    found = chosen.mapInArrow(measured, "doc_id long, quality int, x binary, size binary").toArrow().sort_by([("doc_id", "ascending")])
    if not found.num_rows:
        return None
    size = [np.frombuffer(b, "<f4") for b in found.column("size").to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(s) for s in size])])
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), "<f4").reshape(int(first[-1]), -1)
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    return Field(edges, common).fit(x, first, np.array(found.column("quality").to_pylist()) == 1, np.concatenate(size))


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """Rows (doc_id, score, line_scores), one per document; line_scores has P(good) of each \\n-split line.

    docs needs doc_id and text; other columns are ignored. A null text counts as empty, which is one empty line and
    is scored like any other. Where field is None every score is 0.5. Repeated rows are scored each.
    """

    def run(batches):
        for part in slices(batches):
            data, at = buffer_of(part.column("text"))
            if field is None:
                _, _, first = lines_of(data, at)
                q, good = np.full(part.num_rows, 0.5), np.full(int(first[-1]), 0.5)
            else:
                q, good, first = field.quality(data, at)
            own = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(good.astype(np.float32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.clip(q, 0, 1)), own], names=["doc_id", "score", "line_scores"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, score double, line_scores array<float>")
