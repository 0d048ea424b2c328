"""Exact top-k by inner product with a pivot-distance index.

Components are floor(scale * x), so scores are whole numbers. A vector x becomes a point with one coordinate more,
sqrt(M - x.x) with M the largest x.x, a query one with 0 there; then d(q, x)^2 = q.q + M - 2 q.x, and the highest
scores are the nearest points. The index keys every vector by its nearest pivot and the distance to it, sorts by
these and cuts the order into shards, and shards into annuli of one pivot. For a query at distance D from a pivot,
points of an annulus [lo, hi] around it are at least max(lo - D, D - hi) away; an annulus beyond the query's k-th
best distance is left out.

A search has two rounds. First each query visits the shards in which it would lie itself; its k-th score there bounds the second
round, which visits every other annulus within the bound. Queries travel in packs, shards to the packs that
need them, so a task holds one shard and one pack, whatever the tables' sizes and however many vectors share a place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256
#: Pivots, the rows of the sample that they are fitted on, and rounds of fitting.
PIVOTS, SAMPLE, ROUNDS = 64, 4096, 8
#: Components of a shard's vectors and of a pack's queries, and vectors of an annulus: what bounds a task.
SHARD, PACK, ANNULUS = 2 << 20, 1 << 20, 1024
#: Queries that one block of scores covers.
BLOCK = 1024
_LONG = (1 << 63) - 1
#: The bound of a query with fewer than k scores so far.
NONE = -_LONG - 1


def whole(vectors: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which of a list column's vectors take part, and floor(scale * x) of those. Not: nulls, null or non-finite components."""
    size = np.diff(np.asarray(vectors.offsets)) if len(vectors) else np.zeros(0)
    flat = vectors.flatten()
    if len(size) and not vectors.null_count and not flat.null_count and (size == size[0]).all():
        with np.errstate(all="ignore"):
            x = np.floor(scale * np.asarray(flat, np.float64)).reshape(len(vectors), int(size[0]))
        good = np.isfinite(x).all(axis=1)
        return good, list(x[good])
    rows, good = [], np.zeros(len(vectors), bool)
    for k, v in enumerate(vectors):
        if not v.is_valid:
            continue
        x = v.values
        if x.null_count:
            continue
        with np.errstate(all="ignore"):
            x = np.floor(scale * np.asarray(x.cast(pa.float64()), np.float64))
        if np.isfinite(x).all():
            good[k] = True
            rows.append(x)
    return good, rows


def pack_vector(x: np.ndarray) -> bytes:
    """Whole numbers as 16-bit ones where they fit, with a mark of the width first."""
    return b"h" + x.astype("<i2").tobytes() if not len(x) or np.abs(x).max() < 1 << 15 else b"d" + x.astype("<f8").tobytes()


def unpack(column: pa.Array, width: int) -> np.ndarray:
    """Rows of packed vectors, shorter ones filled with zeros."""
    blobs = column.to_pylist()
    size = 1 + 2 * width
    if all(len(b) == size and b[:1] == b"h" for b in blobs):
        joined = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), size)
        return np.ascontiguousarray(joined[:, 1:]).view("<i2").astype(np.float64).reshape(len(blobs), width)
    out = np.zeros((len(blobs), width))
    for k, b in enumerate(blobs):
        x = np.frombuffer(b, "<i2" if b[:1] == b"h" else "<f8", offset=1)
        out[k, : len(x)] = x
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, exact: as doubles where all sums stay below 2^53, else as Python's whole numbers; at most and least a long's."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(queries.shape[1], 1)
    if top < 2.0**53:
        return (queries @ points.T).astype(np.int64)
    rows, columns = ([[int(v) for v in row] for row in a] for a in (queries, points))
    return np.array([[max(NONE + 1, min(_LONG, sum(map(int.__mul__, q, x)))) for x in columns] for q in rows], np.int64).reshape(len(queries), len(points))


@dataclass(frozen=True)
class Index:
    """The written index: rows (shard, pivot, distance, vec_id, vector), with what a search needs to know of it."""

    rows: DataFrame | None
    pivots: np.ndarray  # with the last coordinate
    sample: np.ndarray
    sample_ids: np.ndarray
    largest: float  # of x.x
    width: int
    scale: int

    def bare(self, sample: bool = False) -> Index:
        """What tasks need of it: no rows, and the sample only where it is asked for."""
        keep = len(self.sample) if sample else 0
        return replace(self, rows=None, sample=self.sample[:keep], sample_ids=self.sample_ids[:keep])

    @property
    def slack(self) -> float:
        """What rounding can add to a distance."""
        return 1e-6 * (1 + float(np.sqrt(self.largest)) + float(np.sqrt(_norms(self.pivots).max(initial=0))))


def _pack(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows (vec_id, vector, norm, width) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = whole(batch.column("embedding"), scale)
            ids = batch.column("vec_id").filter(pa.array(good))
            with np.errstate(over="ignore"):
                norms = [float(x @ x) for x in rows]
            yield pa.RecordBatch.from_arrays([ids, pa.array(map(pack_vector, rows), pa.binary()), pa.array(norms, pa.float64()), pa.array(map(len, rows), pa.int32())], names=["vec_id", "vector", "norm", "width"])

    wanted = vectors.where("vec_id IS NOT NULL").selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding")
    return wanted.mapInArrow(run, "vec_id long, vector binary, norm double, width int")


def _points(x: np.ndarray, largest: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(largest - _norms(x), 0))[:, None]], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_norms(x)[:, None] + _norms(pivots) - 2 * (x @ pivots.T), 0))


def fit(points: np.ndarray, pivots: int = PIVOTS, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of points, begun from ones spread by distance."""
    chosen = points[:1]
    while 0 < len(chosen) < pivots:
        far = distances(points, chosen).min(axis=1)
        if far.max() <= 0:
            break
        chosen = np.concatenate([chosen, points[[int(far.argmax())]]])
    for _ in range(rounds if len(points) else 0):
        own = distances(points, chosen).argmin(axis=1)
        chosen = np.array([points[own == k].mean(axis=0) if (own == k).any() else chosen[k] for k in range(len(chosen))])
    return chosen


def build(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, scale: int = SCALE) -> Index:
    """Index every row (vec_id, embedding) of vectors; pivots are fitted on the sample rows of least hash.

    Vectors that are null, or hold null or non-finite components, before or after scaling, take no part, nor do rows without vec_id. Shorter
    vectors count as filled with zeros. Repeated rows are all indexed; extra columns are ignored; an empty table has an empty index.
    """
    rows = materialize(_pack(vectors, scale), "vectors")
    known = rows.agg(F.count("vec_id"), F.max("norm"), F.max("width")).first()
    count, largest, width = known[0], known[1] or 0.0, known[2] or 0
    some = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample).toArrow()
    fitted = unpack(some.column("vector").combine_chunks(), width) if some.num_rows else np.zeros((0, width))
    plain = np.isfinite(largest) and largest < 1e300
    centres = fit(_points(fitted, largest), pivots) if plain else np.zeros((1, width + 1))
    if not len(centres):
        centres = np.zeros((1, width + 1))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpack(batch.column("vector"), width)
            apart = distances(_points(x, largest), centres) if plain else np.zeros((len(x), 1))
            own = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(apart[np.arange(len(own)), own]), batch.column("vec_id"), batch.column("vector")], names=["pivot", "distance", "vec_id", "vector"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, shard, np.int32)), *batch.columns], names=["shard", *batch.schema.names])

    keyed = rows.select("vec_id", "vector").mapInArrow(key, "pivot int, distance double, vec_id long, vector binary")
    parts = max(-(-count * max(width, 1) // SHARD), min(2 * vectors.sparkSession.sparkContext.defaultParallelism, -(-count // (2 * ANNULUS))), 1)
    # ids part the order where a third of all vectors lie at one distance
    ordered = keyed.repartitionByRange(parts, "pivot", "distance", "vec_id", F.xxhash64("vector")).sortWithinPartitions("pivot", "distance", "vec_id")
    table = materialize(ordered.mapInArrow(number, "shard int, pivot int, distance double, vec_id long, vector binary"), "annuli", "zstd")
    ids = np.asarray(some.column("vec_id").combine_chunks(), np.int64) if some.num_rows else np.zeros(0, np.int64)
    return Index(table, centres, fitted, ids, largest if plain else np.inf, width, scale)


def best(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of a row of scores and their ids, ties to the smaller id."""
    if len(found) > 4 * k:
        near = np.flatnonzero(found >= np.partition(found, len(found) - k)[len(found) - k])
        found, ids = found[near], ids[near]
    order = np.lexsort((ids, -found))[:k]
    return found[order], ids[order]


def _reach(bound: np.ndarray, norms: np.ndarray, largest: float) -> np.ndarray:
    """The distance within which points have a score of bound or more."""
    with np.errstate(all="ignore"):
        return np.where(bound == NONE, np.inf, np.sqrt(np.maximum(norms + largest - 2 * bound.astype(np.float64), 0)))


def rings(pivot: np.ndarray, distance: np.ndarray, size: int = ANNULUS) -> np.ndarray:
    """Starts of the annuli of a shard's ordered rows, and its end: each of one pivot and at most size rows."""
    change = np.flatnonzero(np.diff(pivot)) + 1
    edges = np.concatenate([[0], change, [len(pivot)]])
    return np.unique(np.concatenate([*[np.arange(a, b, size) for a, b in zip(edges[:-1], edges[1:], strict=True)], [len(pivot)]])).astype(np.int64)


def _to_pivots(index: Index, queries: np.ndarray) -> np.ndarray:
    if not np.isfinite(index.largest):
        return np.zeros((len(queries), len(index.pivots)))
    return distances(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1), index.pivots)


def search_shard(index: Index, shard: dict, pack: dict, k: int, first: bool) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a pack that visits the shard: its id and up to k best ids and scores there.

    Queries carry bound, the k-th score known so far. In the first round those visit that lie in the shard by their own
    pivot and distance; in the second, all but those. Annuli are taken from near to far, and each only by queries whose k-th
    distance reaches it.
    """
    cuts = rings(shard["pivot"], shard["distance"])
    pivot, lo, hi = shard["pivot"][cuts[:-1]], shard["distance"][cuts[:-1]], shard["distance"][cuts[1:] - 1]
    home = np.zeros(len(pack["ids"]), bool)
    for p in np.unique(pivot):
        home |= (pack["pivot"] == p) & (pack["distance"] >= lo[pivot == p].min()) & (pack["distance"] <= hi[pivot == p].max())
    part = np.flatnonzero(home == first)
    if not len(part):
        return []
    queries, names, bound = pack["x"][part], pack["ids"][part], pack["bound"][part].copy()
    norms, apart = _norms(queries), _to_pivots(index, queries)
    # by the triangle inequality, and since a point's own pivot is the nearest to it
    away = np.maximum(lo[None] - apart[:, pivot], apart[:, pivot] - hi[None])
    away = np.maximum(away, (apart[:, pivot] - apart.min(axis=1)[:, None]) / 2)
    reach = _reach(bound, norms, index.largest)
    tops: list[tuple | None] = [None] * len(part)
    for ring in np.argsort(away.min(axis=0), kind="stable"):
        rows = slice(int(cuts[ring]), int(cuts[ring + 1]))
        near = np.flatnonzero(~(away[:, ring] > reach + index.slack))
        for a in range(0, len(near), BLOCK):
            few = near[a : a + BLOCK]
            table, ids = scores(queries[few], shard["x"][rows]), shard["ids"][rows]
            for r in np.flatnonzero(table.max(axis=1) >= bound[few]).tolist():
                q = int(few[r])
                take = np.flatnonzero((table[r] >= bound[q]) & (ids != names[q]))
                if not len(take):
                    continue
                line, who = table[r][take], ids[take]
                if tops[q] is not None:
                    line, who = np.concatenate([tops[q][0], line]), np.concatenate([tops[q][1], who])
                tops[q] = best(line, who, k)
                if len(tops[q][0]) == k and tops[q][0][-1] > bound[q]:
                    bound[q] = tops[q][0][-1]
                    reach[q] = _reach(bound[q : q + 1], norms[q : q + 1], index.largest)[0]
    return [(int(names[q]), t[1], t[0]) for q, t in enumerate(tops) if t is not None]


_QUERY = "query_id long, vector binary, pivot int, distance double, bound long"
_PACKED = "pack long, ids binary, vectors array<binary>, bounds binary, pivots binary, distances binary, reaches array<struct<pivot: int, low: double, high: double>>"


def _placed(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """Queries (query_id, vector) with their nearest pivot, its distance and a first bound: their k-th score in the fitting sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, names = unpack(batch.column("vector"), index.width), np.asarray(batch.column("query_id"), np.int64)
            apart, bound = _to_pivots(index, x), np.full(len(x), NONE)
            for a in range(0, len(x) if len(index.sample) >= k else 0, BLOCK):
                table = scores(x[a : a + BLOCK], index.sample)
                table[names[a : a + BLOCK, None] == index.sample_ids[None]] = NONE
                bound[a : a + BLOCK] = np.partition(table, table.shape[1] - k, axis=1)[:, table.shape[1] - k]
            own = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vector"), pa.array(own.astype(np.int32)), pa.array(apart[np.arange(len(own)), own]), pa.array(bound)], names=["query_id", "vector", "pivot", "distance", "bound"])

    index = index.bare(True)
    return queries.select("query_id", "vector").mapInArrow(run, _QUERY)


def _packs(queries: DataFrame, index: Index, count: int, first: bool) -> DataFrame:
    """Queries packed with near ones, and what each pack reaches around each pivot: its queries' own places, or all within their bounds."""
    wanted = max(-(-count * max(index.width, 1) // PACK), 1)
    parts = max(wanted, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    together = parts // wanted

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() // together
        for few in batches:
            if not few.num_rows:
                continue
            x, bound, own, at = unpack(few.column("vector"), index.width), *(np.asarray(few.column(c)) for c in ("bound", "pivot", "distance"))
            if first:
                reaches = [{"pivot": int(p), "low": float(at[own == p].min()), "high": float(at[own == p].max())} for p in np.unique(own)]
            else:
                apart, reach = _to_pivots(index, x), _reach(bound, _norms(x), index.largest)[:, None] + index.slack
                within = ~((apart - apart.min(axis=1)[:, None]) / 2 > reach)
                low, high = np.where(within, apart - reach, np.inf).min(axis=0), np.where(within, apart + reach, -np.inf).max(axis=0)
                reaches = [{"pivot": p, "low": float(low[p]), "high": float(high[p])} for p in np.flatnonzero(within.any(axis=0)).tolist()]
            row = {"pack": number, "ids": np.asarray(few.column("query_id"), "<i8").tobytes(), "vectors": few.column("vector").to_pylist()}
            row |= {"bounds": bound.astype("<i8").tobytes(), "pivots": own.astype("<i4").tobytes(), "distances": at.astype("<f8").tobytes(), "reaches": reaches}
            around = pa.list_(pa.struct([("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))
            kinds = {"pack": pa.int64(), "vectors": pa.list_(pa.binary()), "reaches": around}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(c, kinds.get(c, pa.binary())) for c in row]))

    index = index.bare()
    near = queries.repartitionByRange(parts, "pivot", "distance", "query_id").sortWithinPartitions("pivot", "distance", "query_id")
    return near.mapInArrow(pack, _PACKED)


def _visit(index: Index, packs: DataFrame, k: int, first: bool) -> DataFrame:
    """Rows (query_id, vec_id, score): up to k of each query and each shard that it visits."""
    directory = index.rows.groupBy("shard", "pivot").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"))
    wanted = packs.select("pack", F.inline("reaches")).join(directory, "pivot").where("low <= hi AND high >= lo").select("pack", "shard").distinct()
    wanted = materialize(wanted, "cells")
    # the shards of the index travel to the packs that need them
    left = index.rows.join(wanted, "shard").select("shard", "pack", "pivot", "distance", "vec_id", "vector")
    right = packs.drop("reaches").join(wanted, "pack").select("shard", "pack", "ids", "vectors", "bounds", "pivots", "distances")
    index = index.bare()

    def cell(rows: pa.Table, query: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and query.num_rows:
            column = lambda t, c: t.column(c).combine_chunks()
            rows = rows.sort_by([("pivot", "ascending"), ("distance", "ascending")])
            shard = {c: np.asarray(column(rows, c)) for c in ("pivot", "distance")} | {"ids": np.asarray(column(rows, "vec_id")), "x": unpack(column(rows, "vector"), index.width)}
            whole_ = lambda c, kind: np.frombuffer(b"".join(query.column(c).to_pylist()), kind)
            pack = {"ids": whole_("ids", "<i8"), "bound": whole_("bounds", "<i8"), "pivot": whole_("pivots", "<i4"), "distance": whole_("distances", "<f8"), "x": unpack(column(query, "vectors").flatten(), index.width)}
            found = search_shard(index, shard, pack, k, first)
        size = [len(f[1]) for f in found]
        joined = lambda k_: np.concatenate([f[k_] for f in found]) if found else np.zeros(0, np.int64)
        return pa.table({"query_id": np.repeat(np.array([f[0] for f in found], np.int64), size), "vec_id": joined(1), "score": joined(2)})

    return left.groupBy("shard", "pack").cogroup(right.groupBy("shard", "pack")).applyInArrow(cell, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k highest inner products of each row (vec_id, embedding) of queries with the index.

    Rows of the query's own vec_id are no candidates; ties go to the smaller vec_id; fewer than k where there are no more. Queries
    take part as vectors do in build(); of queries that repeat a vec_id one, the greatest as packed, is taken. Every other row is a
    candidate, so repeated rows can each have a rank. Scores outside of a long count as its nearest value.
    """
    own = _pack(queries, index.scale).groupBy(F.col("vec_id").alias("query_id")).agg(F.max("vector").alias("vector"))
    placed = materialize(_placed(own, index, k), "queries")
    count = placed.count()
    near = materialize(_visit(index, materialize(_packs(placed, index, count, True), "packs"), k, True), "near")
    known = _ranked(near, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("known"))
    bounded = placed.join(known, "query_id", "left").withColumn("bound", F.greatest("bound", "known")).drop("known")
    rest = _visit(index, materialize(_packs(bounded, index, count, False), "packs"), k, False)
    return _ranked(near.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
