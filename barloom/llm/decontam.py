"""Benchmark passages in documents, found through a latent space and confirmed word by word.

A randomised SVD of the TF-IDF matrix of all document passages gives the space. A first pass multiplies the passages
with a random matrix and back; the products are summed level by level, and an orthonormal basis of the sum spans the
space. A second pass projects the weighted passages onto that basis; the eigenvectors of the small product of the
projections are the singular vectors. Passages near a benchmark passage by cosine are candidates; the longest common
subsequence of words, and for looser matches the item's rarest words (its answer-like part), decide. Of items over
LONG words a piece of PIECE words is a leak too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import APART, buffer_of, slices, word_hashes

FEATURES, RANK, BLOCKS = 1 << 14, 64, 16
#: Words of a half passage; a passage is two neighbouring halves.
HALF = 16
COSINE = 0.45
#: A word is common if its feature is in more than this share of passages; of an item passage's other words a
#: candidate must hold this share before the words are aligned.
COMMON, HELD = 0.2, 0.35
#: Share of an item's words in common order that proves a leak alone, and with RARE of its rarest words.
CERTAIN, LIKELY, RARE_WORDS, RARE = 0.7, 0.5, 6, 0.6
#: An item of more than LONG words leaks also if CERTAIN of PIECE of its consecutive words are there.
LONG, PIECE = 4 * HALF, 3 * HALF
#: Tasks whose partial sums are added first, before the sums of these meet.
LEVEL = 32
#: Items that one pass over the documents is held against.
ITEMS = 512


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*buffer_of(column), lower=True, space=APART)


def _feature(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)


def _starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of width-word pieces counted from each text's first word, the last one shorter; and their texts."""
    count = -(-np.diff(first) // width)
    doc = np.repeat(np.arange(len(count)), count)
    return first[doc] + (np.arange(len(doc)) - (np.cumsum(count) - count)[doc]) * width, doc


def _random() -> np.ndarray:
    """The random matrix, with a row of zeros behind."""
    g = np.random.default_rng(11).normal(size=(FEATURES + 1, RANK)).astype(np.float32)
    g[-1] = 0
    return g


def sum_rows(table: np.ndarray, index: np.ndarray, starts: np.ndarray, lanes: int) -> np.ndarray:
    """Sums of table[index] over the stretches that begin at starts; the table's last row must be zeros.

    Stretches are cut into pieces of lanes rows, and a lane of all pieces is added at a time.
    """
    if not len(starts):
        return np.zeros((0, table.shape[1]), table.dtype)
    size = np.diff(np.append(starts, len(index)))
    count = -(-size // lanes)
    first = np.cumsum(count) - count
    begin = np.repeat(starts, count) + (np.arange(int(count.sum())) - np.repeat(first, count)) * lanes
    end = np.repeat(starts + size, count)
    out = np.zeros((len(begin), table.shape[1]), table.dtype)
    for j in range(lanes):
        at = begin + j
        out += table.take(np.where(at < end, index[np.minimum(at, len(index) - 1)], len(table) - 1), 0)
    return out if len(out) == len(starts) else np.add.reduceat(out, first, axis=0)


def _products(batches):
    g = _random()
    total, df, n = np.zeros((FEATURES, RANK)), np.zeros(FEATURES, np.int64), 0
    for part in slices(batches):
        words, first = _words(part.column("text"))
        if not len(words):
            continue
        feature = _feature(words)
        starts, _ = _starts(first, 2 * HALF)
        y = np.vstack([sum_rows(g, feature, starts, 2 * HALF), np.zeros((1, RANK), np.float32)])
        passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
        key = np.sort(feature * len(starts) + passage)
        feature, passage = np.divmod(key, len(starts))
        edge = np.flatnonzero(np.diff(feature, prepend=-1))
        total[feature[edge]] += sum_rows(y, passage, edge, HALF)
        df += np.bincount(feature[np.flatnonzero(np.diff(key, prepend=-1))], minlength=FEATURES)
        n += len(starts)
    if n:
        size = FEATURES // BLOCKS
        rows = [total[k * size : (k + 1) * size].astype(np.float32).tobytes() for k in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS)), pa.array(rows, pa.binary()), pa.array([df[k * size : (k + 1) * size].tobytes() for k in range(BLOCKS)], pa.binary()), pa.array([n] * BLOCKS, pa.int64())], names=["block", "total", "df", "n"])


def _sums(batches):
    found: dict[int, list] = {}
    for batch in batches:
        for block, total, df, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = found.setdefault(block, [0.0, 0, 0])
            own[0] = own[0] + np.frombuffer(total, np.float32).astype(np.float64)
            own[1], own[2] = own[1] + np.frombuffer(df, np.int64), own[2] + n
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array([v[0].astype(np.float32).tobytes() for v in found.values()], pa.binary()), pa.array([v[1].tobytes() for v in found.values()], pa.binary()), pa.array([v[2] for v in found.values()], pa.int64())],
            names=["block", "total", "df", "n"],
        )


SUMS = "block long, total binary, df binary, n long"


def _added(parts: DataFrame) -> list:
    """One row a block: the sums of LEVEL neighbouring tasks first, then the sums of those."""
    first = parts.withColumn("level", F.shiftright(F.spark_partition_id(), LEVEL.bit_length() - 1)).repartition("block", "level").drop("level")
    return first.mapInArrow(_sums, SUMS).repartition(BLOCKS, "block").mapInArrow(_sums, SUMS).collect()


def latent_space(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES + 1, RANK) that take counts of features to the latent space, zeros behind, and each feature's idf.

    The driver gets two sums of fixed size, whatever the documents: FEATURES x RANK and RANK x RANK numbers.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    total, df, n = np.zeros((FEATURES, RANK)), np.zeros(FEATURES), 0
    size = FEATURES // BLOCKS
    for r in _added(texts.mapInArrow(_products, SUMS)):
        at = slice(r.block * size, (r.block + 1) * size)
        total[at], df[at], n = np.frombuffer(r.total, np.float32).reshape(size, RANK), np.frombuffer(r.df, np.int64), r.n
    idf = np.log((1 + n) / (1 + df)) + 0.1
    basis = np.linalg.qr(total * idf[:, None])[0] * idf[:, None]
    held = docs.sparkSession.sparkContext.broadcast(np.vstack([basis, np.zeros((1, RANK))]).astype(np.float32))

    def project(batches):
        gram, n = np.zeros((RANK, RANK)), 0
        for part in slices(batches):
            words, first = _words(part.column("text"))
            starts, _ = _starts(first, 2 * HALF)
            y = sum_rows(held.value, _feature(words), starts, 2 * HALF).astype(np.float64)
            gram, n = gram + y.T @ y, n + len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([gram.astype(np.float32).tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([n])], names=["block", "total", "df", "n"])

    sums = _added(texts.mapInArrow(project, SUMS))
    held.unpersist()
    gram = np.frombuffer(sums[0].total, np.float32).reshape(RANK, RANK).astype(np.float64) if sums else np.eye(RANK)
    square, turn = np.linalg.eigh((gram + gram.T) / 2)
    # divided by their singular values the directions are even, or a language's would rule them
    weights = basis @ turn / np.sqrt(np.maximum(square, max(1e-6 * square[-1], 1e-12)))
    return np.vstack([weights, np.zeros((1, RANK))]).astype(np.float32), idf


def _passages(words: np.ndarray, first: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of all passages, their first words and texts. A text of one half is one passage."""
    starts, doc = _starts(first, HALF)
    half = sum_rows(weights, _feature(words), starts, HALF)
    pair = np.flatnonzero(doc[:-1] == doc[1:])
    single = np.flatnonzero(np.bincount(doc, minlength=len(first) - 1)[doc] == 1)
    x = np.concatenate([half[pair] + half[pair + 1], half[single]])
    at = np.concatenate([pair, single])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return x, starts[at], doc[at]


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a machine word of places at a time."""
    places: dict = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := places.get(x):
            u = v & m
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class _Items:
    def __init__(self, ids: list, words: np.ndarray, first: np.ndarray, weights: np.ndarray, idf: np.ndarray):
        self.ids = ids
        self.words = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.lists = [w.tolist() for w in self.words]
        self.x, start, self.item = _passages(words, first, weights)
        self.begin = start - first[self.item]
        common = idf < np.log(1 / COMMON) + 0.1
        self.vocabulary = np.unique(words[~common[_feature(words)]])
        self.member = np.zeros((len(self.vocabulary) + 1, len(ids)), bool)
        number = self.numbers(words)
        self.member[number, np.repeat(np.arange(len(ids)), np.diff(first))] = True
        self.member[-1] = False
        inside = start[:, None] + np.arange(2 * HALF)
        known = (inside < first[self.item + 1][:, None]) & (number[np.minimum(inside, len(words) - 1)] < len(self.vocabulary))
        rare = known.sum(1)
        self.need = np.minimum(np.maximum(2, np.ceil(HELD * rare)), rare)
        self.rare = [set(sorted(set(w.tolist()), key=lambda h: (-idf[_feature(np.array([h], np.uint64))[0]], h))[:RARE_WORDS]) for w in self.words]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary; its size for other words."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, len(self.vocabulary))

    def confirm(self, item: int, region: np.ndarray) -> tuple[int, int, int, float] | None:
        """Ends of the stretch of region with most of the item's words in order, their count and share; None if no leak.

        Stretches are a few times the item's length and overlap, so that a long region gathers no more words by chance.
        """
        step = len(self.lists[item]) + 2 * HALF
        best = None
        for a in range(0, max(1, len(region) - 2 * step), step):
            part = region[a : a + 3 * step]
            if (got := self._shared(item, part)) and (best is None or got[0] > best[2]):
                best = a, a + len(part), *got
        return best

    def _shared(self, item: int, part: np.ndarray) -> tuple[int, float] | None:
        own, there = self.lists[item], part.tolist()
        around = set(there)
        if sum(w in around for w in own) < LIKELY * len(own):
            return None
        shared = lcs(own, there)
        share = shared / len(own)
        if share >= CERTAIN:
            return shared, share
        if share >= LIKELY:
            rare = self.rare[item]
            if len(rare & around) >= RARE * len(rare):
                return shared, share
        return None

    def piece(self, passage: int, around: np.ndarray) -> int:
        """Words in common order with the PIECE words of a long item from the passage on; 0 if under CERTAIN of them."""
        own = self.lists[self.item[passage]]
        at = min(int(self.begin[passage]), len(own) - PIECE)
        shared = lcs(own[at : at + PIECE], around.tolist())
        return shared if shared >= CERTAIN * PIECE else 0


def leaks(docs: DataFrame, benchmark: DataFrame, space: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Rows (doc_id, item_id, first_word, last_word, common_words, common_share, cosine), one per document and item.

    docs needs doc_id and text, benchmark item_id and text; other columns are ignored. Of several places with one
    item, the one with most common words counts, the first on ties. Null and empty texts and items leak nothing;
    repeated rows are searched each and give the same row once. Texts that share an item_id are searched each. Where a
    piece of a long item is all that leaks, common_words counts the piece's words and common_share is of the whole item.
    Items are taken ITEMS at a time; their words are broadcast, which is bounded by that count, and each block of
    items is one pass over all documents.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    weights, idf = space or latent_space(rows)
    items = benchmark.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").where("item_id is not null and text <> ''").distinct()
    schema = "doc_id long, item_id long, first_word long, last_word long, common_words long, common_share double, cosine double"
    spark, out, after = docs.sparkSession, None, None
    shared = spark.sparkContext.broadcast(weights)
    while True:
        block = (items if after is None else items.where(F.struct("item_id", "text") > F.struct(*map(F.lit, after)))).orderBy("item_id", "text").limit(ITEMS).toArrow()
        if not block.num_rows:
            break
        after = block.column("item_id")[-1].as_py(), block.column("text")[-1].as_py()
        words, first = _words(block.column("text"))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            held = spark.sparkContext.broadcast(_Items([block.column("item_id")[int(k)].as_py() for k in full], words, np.append(first[full], len(words)), weights, idf))
            found = rows.mapInArrow(_search(held, shared), schema)
            out = found if out is None else out.unionByName(found)
        if block.num_rows < ITEMS:
            break
    out = spark.createDataFrame([], schema) if out is None else out
    best = F.max_by(F.struct("first_word", "last_word", "common_words", "common_share", "cosine"), F.struct("common_words", -F.col("first_word")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def _search(held, shared):
    def run(batches):
        items, weights = held.value, shared.value
        for part in slices(batches):
            words, first = _words(part.column("text"))
            if not len(words):
                continue
            x, at, doc = _passages(words, first, weights)
            ids, rows = part.column("doc_id").to_pylist(), []
            spans: dict[tuple[int, int], list] = {}
            number = np.append(items.numbers(words), len(items.vocabulary))
            for lo in range(0, len(x), 4096):
                near = x[lo : lo + 4096] @ items.x.T
                p, q = np.nonzero(near >= COSINE)
                inside = at[lo : lo + 4096, None] + np.arange(2 * HALF)
                seen = number[np.where(inside < first[doc[lo : lo + 4096] + 1][:, None], inside, len(words))]
                count = np.zeros(len(p), np.int64)
                for a in range(0, len(p), 1 << 16):
                    own = slice(a, a + (1 << 16))
                    count[own] = items.member[seen[p[own]], items.item[q[own]][:, None]].sum(1)
                fits = count >= items.need[q]
                for p, q in zip(p[fits].tolist(), q[fits].tolist(), strict=True):
                    spans.setdefault((int(doc[lo + p]), int(items.item[q])), []).append((int(at[lo + p]), float(near[p, q]), q))
            for (d, item), hits in spans.items():
                room = len(items.words[item])
                hits.sort()
                begin = int(first[d])
                region = [hits[0]]
                for hit in [*hits[1:], None]:
                    lo, hi = region[0][0], region[-1][0]
                    if hit is None or hit[0] > hi + 2 * HALF + room:
                        a, b = max(begin, lo - room), min(int(first[d + 1]), hi + 2 * HALF + room)
                        best = max(cosine for _, cosine, _ in region)
                        if got := items.confirm(item, words[a:b]):
                            rows.append((ids[d], items.ids[item], a - begin + got[0], a - begin + got[1], *got[2:], best))
                        elif room > LONG:
                            for start, cosine, q in region:
                                a, b = max(begin, start - 2 * HALF), min(int(first[d + 1]), start + PIECE + 2 * HALF)
                                if common := items.piece(q, words[a:b]):
                                    rows.append((ids[d], items.ids[item], a - begin, b - begin, common, common / room, cosine))
                        region = []
                    region.append(hit)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["doc_id", "item_id", "first_word", "last_word", "common_words", "common_share", "cosine"])

    return run
