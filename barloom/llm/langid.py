"""Language of a text by a byte convolutional network.

Bytes, folded to a small alphabet, go through filters of several widths, a max over each window, and a softmax.
The network is trained in numpy on a bounded sample of labelled rows; prediction covers whole texts in
non-overlapping windows and averages the windows' probabilities by the bytes they hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, slices

WINDOW, FILTERS, WIDTHS = 128, 16, (2, 3, 4)
#: At most about this many labelled rows of each language train the network, and this many windows of each row:
#: under one megabyte a language reaches the driver, however long the texts are.
ROWS_PER_LANG, WINDOWS_PER_ROW = 1200, 6
EPOCHS, BATCH, RATE = 12, 64, 0.01
UNKNOWN = "und"

PAD = 0
ALPHABET = 192


def _fold() -> np.ndarray:
    """Byte classes: letters without case, one class for digits, some for punctuation, each byte above 127 its own."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        out[b] = b - 128 + 64 if b >= 128 else ord(c.lower()) - 97 + 8 if c.isalpha() else 1 if c in " \t\n\r\v\f" else 2 if c.isdigit() else 3 if c in ".,;:!?" else 4 if c in "'\"`" else 5 if c == "-" else 6
    return out


_CLASS = _fold()


def windows_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class windows (k, WINDOW) of all texts, padded at each text's end; the windows' texts and byte counts."""
    sizes = np.diff(at)
    count = -(-sizes // WINDOW)
    first = np.cumsum(count) - count
    total = int(count.sum())
    flat = np.zeros(total * WINDOW, np.uint8)
    shift = np.repeat(first * WINDOW - at[:-1], sizes)
    flat[np.arange(len(data)) + shift] = _CLASS[data]
    doc = np.repeat(np.arange(len(sizes)), count)
    held = np.minimum(WINDOW, sizes[doc] - (np.arange(total) - first[doc]) * WINDOW)
    return flat.reshape(total, WINDOW), doc, held


class Net:
    """Filters as tables: a filter's answer at a place is the sum of one row of weights for each of its bytes."""

    def __init__(self, langs: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.tables = [rng.normal(0, 0.1, (w, ALPHABET, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def prepare(self) -> Net:
        """Tables of byte pairs, which halve the look-ups of prediction."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(ALPHABET * ALPHABET, FILTERS)
        two, three, four = self.tables
        self.pairs = [pair(two[0], two[1]), pair(three[0], three[1]), three[2], pair(four[0], four[1]), pair(four[2], four[3])]
        return self

    def _head(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(1, keepdims=True)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (k, languages) of class windows, in blocks that stay in the processor's cache."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        two, three, third, four, last = self.pairs
        for lo in range(0, len(x), 64):
            w = x[lo : lo + 64].astype(np.int32)
            n = len(w)
            pair = w[:, :-1] * ALPHABET + w[:, 1:]
            size = WINDOW - 3
            a = two.take(pair[:, :size].ravel(), 0).reshape(n, size, FILTERS).max(1)
            b = three.take(pair[:, :size].ravel(), 0)
            b += third.take(w[:, 2 : size + 2].ravel(), 0)
            c = four.take(pair[:, :size].ravel(), 0)
            c += last.take(pair[:, 2:].ravel(), 0)
            out[lo : lo + n] = self._head(np.concatenate([a, b.reshape(n, size, FILTERS).max(1), c.reshape(n, size, FILTERS).max(1)], 1))
        return out

    def _step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n, size = len(x), WINDOW - 3
        pooled, where = [], []
        for table in self.tables:
            z = sum(table[k][x[:, k : k + size]] for k in range(len(table)))
            best = z.argmax(1)
            where.append(best)
            pooled.append(np.take_along_axis(z, best[:, None, :], 1)[:, 0])
        hidden = np.concatenate(pooled, 1) + self.bias
        h = np.maximum(hidden, 0)
        z = h @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        dh = (p @ self.out.T) * (hidden > 0)
        grads = []
        for t, (table, best) in enumerate(zip(self.tables, where, strict=True)):
            own, g = dh[:, t * FILTERS : (t + 1) * FILTERS], np.zeros_like(table)
            for k in range(len(table)):
                np.add.at(g[k], (x[np.arange(n)[:, None], best + k], np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        return [*grads, dh.sum(0), h.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 6) -> Net:
        """Adam over EPOCHS passes, every language weighing the same by repeated draws."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        share = 1.0 / np.bincount(y, minlength=len(self.langs))[y]
        for _ in range(EPOCHS):
            order = rng.choice(len(y), len(y), p=share / share.sum())
            for lo in range(0, len(y), BATCH):
                own = order[lo : lo + BATCH]
                t += 1
                for k, g in enumerate(self._step(x[own], y[own])):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    params[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self.prepare()


def is_held_out() -> F.Column:
    """Whether a row is kept from learning: crc32 of doc_id as text leaves no remainder by five."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> Net | None:
    """Fit on about rows_per_lang labelled rows of each language, drawn by a hash of doc_id; None if there are none."""
    known = docs.where(~is_held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, int(min(1.0, rows_per_lang / n) * (1 << 30)))])
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")])
    rows = drawn.selectExpr("cast(doc_id as long) doc_id", "lang", "cast(text as string) text").mapInArrow(_drawn_windows, "doc_id long, lang string, windows binary").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("windows", "ascending")])
    made = rows.column("windows").to_pylist()
    x = np.frombuffer(b"".join(made), np.uint8).reshape(-1, WINDOW)
    if not len(x):
        return None
    langs = sorted(counts)
    code = {lang: k for k, lang in enumerate(langs)}
    y = np.repeat([code[k] for k in rows.column("lang").to_pylist()], [len(w) // WINDOW for w in made])
    return Net(langs).fit(x, y)


def _drawn_windows(batches):
    """At most WINDOWS_PER_ROW windows of 12 bytes or more from each whole text, drawn at random by its doc_id."""
    for part in slices(batches):
        x, doc, held = windows_of(*buffer_of(part.column("text")))
        border = np.searchsorted(doc, np.arange(part.num_rows + 1))
        out = []
        for k, doc_id in enumerate(part.column("doc_id").to_pylist()):
            own = np.arange(border[k], border[k + 1])
            own = np.random.default_rng([3, (doc_id or 0) & (1 << 63) - 1]).permutation(own[held[own] >= 12])
            out.append(x[np.sort(own[:WINDOWS_PER_ROW])].tobytes())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(out, pa.binary())], names=["doc_id", "lang", "windows"])


def identify(docs: DataFrame, net: Net | None) -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per document; score is the mean probability of lang_pred.

    docs needs doc_id and text; other columns are ignored. A text that is null, empty or without a letter, and
    every text where net is None, gets `und` and 0.0. Repeated rows are predicted each. Ties go to the first
    language in alphabetical order. The network, some hundred kilobytes, goes out with the tasks.
    """

    def run(batches):
        if net is not None:
            net.prepare()
        for part in slices(batches):
            data, at = buffer_of(part.column("text"))
            lettered = np.array(part.column("lettered").to_pylist(), bool)
            pred, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if net is not None and len(data):
                x, doc, held = windows_of(data, at)
                p = net.predict(x).astype(np.float64) * held[:, None]
                total = np.zeros((part.num_rows, p.shape[1]))
                has = np.diff(at) > 0
                total[has] = np.add.reduceat(p, np.searchsorted(doc, np.flatnonzero(has)), axis=0)
                total /= np.maximum(np.diff(at), 1)[:, None]
                for k in np.flatnonzero(has & lettered):
                    best = int(total[k].argmax())
                    pred[k], score[k] = net.langs[best], min(1.0, float(total[k, best]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    if net is not None:
        net.pairs = None
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", r"coalesce(text rlike '\\p{L}', false) lettered")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


#: A text whose best language has a mean probability under this is rejected, as is one without letters. All of 1 960
#: held-out texts of the 0.1 tables have 0.47 or more, a thousandth have under 0.62.
LEAST_SCORE = 0.42


def keep_identified(docs: DataFrame, net: Net | None) -> DataFrame:
    """The rows of docs, all columns in place, whose text has letters and a language with at least LEAST_SCORE.

    Where net is None (nothing to learn from), every text with a letter stays.
    """
    if net is None:
        return docs.where(r"coalesce(text rlike '\\p{L}', false)")
    net.pairs = None

    def run(batches):
        net.prepare()
        for part in slices(batches):
            data, at = buffer_of(part.column("text"))
            if not len(data):
                continue
            x, doc, held = windows_of(data, at)
            p = net.predict(x).astype(np.float64) * held[:, None]
            has = np.flatnonzero(np.diff(at) > 0)
            total = np.add.reduceat(p, np.searchsorted(doc, has), axis=0) / np.diff(at)[has][:, None]
            yield part.take(pa.array(has[total.max(1) >= LEAST_SCORE]))

    return docs.where(r"text rlike '\\p{L}'").mapInArrow(run, docs.schema)
