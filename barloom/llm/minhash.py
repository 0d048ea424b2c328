"""Near-duplicate documents by one-permutation hashing.

One hash of each word shingle falls into one of BINS bins; a bin keeps its least value. Empty bins take the
value of a donor bin drawn for each bin alone (optimal densification), so that bins agree with the probability
of the sets' similarity. Bands of ROWS bins are buckets. A bucket gives star-shaped candidates: its least
document against each other member. Where these links leave a bucket's members in several components, all members
of different components are compared by sketches of all bins, also those that the centre links: in one group up to
GROUP members, in tiles of blocks of half as many beyond, where the largest component is not compared with itself.
Large buckets that share members are one where that is less work. Members with a near sketch in another component
then meet in their tile with their full sets; a tile gives at most one link for each component that it joins to
another, so what leaves it grows with its members and not with their pairs. There is one such round, whatever the texts.
No bucket is capped, and only pairs that are connected already are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, materialize, mix, signed, slices, window_hashes, word_hashes
from .components import components

WIDTH, BINS, ROWS = 5, 384, 6
PERCENT = 75
#: Members of a bucket that one task compares among themselves.
GROUP = 400
#: Share of equal bins from which a pair is a candidate. With 384 bins a similarity of 0.75 falls under it with odds
#: of one in a hundred thousand.
NEAR = 0.65
_PRIORITY = np.random.default_rng(97).random((BINS, BINS), dtype=np.float32)


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z folded; a text of fewer words is one shingle, none is empty."""
    words, first = word_hashes(data, at, lower=True)
    windows = window_hashes(words, width)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= width:
            own = np.sort(windows[lo : hi - width + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif hi > lo:
            out.append(mix(window_hashes(words[lo:hi], hi - lo) + np.uint64(hi - lo)))
        else:
            out.append(words[:0])
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """BINS values of a non-empty sorted set; a bin's number is the hash scaled, so sorting has sorted the bins."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    own, first = np.unique(bins, return_index=True)
    out = np.empty(BINS, np.uint64)
    out[own] = shingles[first]
    if len(own) < BINS:
        empty = np.ones(BINS, bool)
        empty[own] = False
        idx = np.flatnonzero(empty)
        out[idx] = shingles[first[_PRIORITY[np.ix_(idx, own)].argmin(1)]]
    return out


def _bands(rows: np.ndarray) -> np.ndarray:
    """Bucket keys (documents, bands) of values (documents, bands, ROWS)."""
    keys = np.zeros(rows.shape[:2], np.uint64)
    for j in range(rows.shape[2]):
        keys = mix(keys * np.uint64(31) + rows[:, :, j])
    return signed(mix(keys + np.arange(rows.shape[1], dtype=np.uint64)))


def _sketch(batches):
    for part in slices(batches):
        sets = shingle_sets(*buffer_of(part.column("text")))
        sigs = np.array([signature(s) for s in sets if len(s)], np.uint64).reshape(-1, BINS // ROWS, ROWS)
        keys = _bands(sigs)
        sizes = np.array([len(s) for s in sets], np.int64)
        ends = np.concatenate([[0], np.cumsum((sizes > 0) * keys.shape[1])]).astype(np.int32)
        low = iter((sigs.reshape(-1, BINS) >> np.uint64(3)).astype(np.uint8))
        bytes_of = [next(low).tobytes() if n else None for n in sizes.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(sizes),
                pa.array(signed(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64))),
                pa.array(signed(np.array([np.bitwise_xor.reduce(mix(s + np.uint64(7))) if len(s) else 0 for s in sets], np.uint64))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                pa.array(bytes_of, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "k1", "k2", "bands", "sketch"],
        )


def near_pairs(sketches: np.ndarray, roots: np.ndarray, sides: np.ndarray) -> list[np.ndarray]:
    """For each of a group's documents the later ones of other roots, and in a tile of the other side, with a near sketch."""
    tile = len(np.unique(sides)) > 1
    out = []
    for i in range(len(roots)):
        js = i + 1 + np.flatnonzero((roots[i + 1 :] != roots[i]) & ((sides[i + 1 :] != sides[i]) | (not tile)))
        out.append(js[np.count_nonzero(sketches[i] == sketches[js], axis=1) >= NEAR * BINS] if len(js) else js)
    return out


def links(sets: list[np.ndarray], roots: np.ndarray, pairs: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of roots that links on full sets connect, fewer than there are roots. Connected roots are not compared again."""
    size = np.array([len(s) for s in sets])
    first = np.concatenate([[0], np.cumsum(size)])
    value, number = np.unique(np.concatenate(sets), return_inverse=True)
    mine, label = np.zeros(len(value), bool), np.unique(roots, return_inverse=True)[1]
    out = []
    for i, js in enumerate(pairs):
        js = js[label[js] != label[i]]
        if not len(js):
            continue
        mine[number[first[i] : first[i + 1]]] = True
        there = np.concatenate([number[first[j] : first[j + 1]] for j in js.tolist()])
        shared = np.add.reduceat(mine[there], np.cumsum(size[js]) - size[js], dtype=np.int64)
        mine[number[first[i] : first[i + 1]]] = False
        for j in js[100 * shared >= PERCENT * (size[i] + size[js] - shared)].tolist():
            if label[j] != label[i]:
                out.append((int(roots[i]), int(roots[j])))
                label[label == label[j]] = label[i]
    return out


def _groups(batches):
    """Record batches of one tile each, whose rows follow each other. Holds one batch and one group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.asarray(batch.column(0))
        edges = (np.flatnonzero(np.diff(key)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(key)], strict=True):
            if held and held[0].column(0)[0].as_py() != key[lo]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def _compared(group: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
    roots = np.asarray(group.column("root"))
    return roots, near_pairs(sketches, roots, np.asarray(group.column("side")))


def _blocks(batches):
    """Rows (tile, doc, root, side, sketch) of batches (tile, side, members), in their order."""
    for batch in batches:
        size = batch.column("members").value_lengths()
        each = np.repeat(np.arange(batch.num_rows), np.asarray(size))
        doc, root, sketch = batch.column("members").flatten().flatten()
        yield pa.RecordBatch.from_arrays([batch.column("tile").take(each), doc, root, batch.column("side").take(each), sketch], names=["tile", "doc", "root", "side", "sketch"])


def _members(batches):
    """The members of tiles that have a near partner in the tile."""
    for group in _groups(_blocks(batches)):
        _, pairs = _compared(group)
        near = np.array([len(p) > 0 for p in pairs])
        for js in pairs:
            near[js] = True
        if near.any():
            yield group.filter(pa.array(near))


def _linked(batches):
    """Links between roots that a tile's documents make."""
    for group in _groups(batches):
        roots, pairs = _compared(group)
        sets = [s for part in slices([group]) for s in shingle_sets(*buffer_of(part.column("text")))]
        if found := links(sets, roots, pairs):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])


def _sizes(label: DataFrame) -> DataFrame:
    """Each bucket of several roots: members n, its largest root main and that one's members most."""
    roots = label.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    sizes = roots.groupBy("bucket").agg(F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.count("*").alias("roots"))
    return sizes.where("roots > 1").drop("roots")


def _families(label: DataFrame) -> DataFrame:
    """label(bucket, doc, root) with one bucket for large ones that share members, where that takes fewer comparisons.

    Texts on one template meet in most of their buckets; so each pair of them is compared once.
    """
    large = materialize(_sizes(label).where(F.col("n") > GROUP).select("bucket", (F.col("n") * (F.col("n") - F.col("most"))).alias("cost")), "large")
    if large.isEmpty():
        return label
    rows = label.join(large, "bucket")
    least = materialize(rows.groupBy("bucket").agg(F.min("doc").alias("a"), F.first("cost").alias("cost")), "least")
    family = components(rows.join(least.select("bucket", "a"), "bucket").select("a", F.col("doc").alias("b")))
    family = least.join(family, F.col("a") == F.col("node")).select("bucket", "cost", F.xxhash64(F.lit("family"), "root").alias("family"))
    whole = rows.select("bucket", "doc", "root").join(family, "bucket").select(F.col("family").alias("bucket"), "doc", "root").distinct()
    whole = materialize(whole, "families")
    costs = family.groupBy("family").agg(F.sum("cost").alias("cost"))
    less = _sizes(whole).join(costs, F.col("bucket") == F.col("family")).where(F.col("n") * (F.col("n") - F.col("most")) < F.col("cost")).select("family")
    less = materialize(less, "less")
    gone = family.join(less, "family").select("bucket")
    return label.join(gone, "bucket", "left_anti").unionByName(whole.join(less, whole.bucket == less.family, "left_semi"))


def _tiles(label: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tile, side, members) of label(bucket, doc, root): each two documents of a bucket and of different roots meet in a tile.

    A bucket of at most GROUP members is one tile and one row: the first table. In a larger one the members outside the bucket's largest root
    make the first blocks, which meet all blocks; the blocks of the largest root do not meet each other. A block is one row,
    so there are (members / GROUP * 2) squared rows at most, and as many tiles as pairs of blocks.
    """
    rows = label.join(_sizes(label), "bucket").join(sketches, "doc")
    members = F.collect_list(F.struct("doc", "root", "sketch")).alias("members")
    small = rows.where(F.col("n") <= GROUP).groupBy(F.col("bucket").alias("tile"), F.lit(0).alias("side")).agg(members)
    half = max(1, GROUP // 2)
    others, mains = F.ceil((F.col("n") - F.col("most")) / half), F.ceil(F.col("most") / half)
    mixed = F.xxhash64("doc")
    own = F.when(F.col("root") != F.col("main"), F.pmod(mixed, F.col("others"))).otherwise(F.col("others") + F.pmod(mixed, F.col("mains")))
    large = rows.where(F.col("n") > GROUP).withColumns({"others": others, "mains": mains}).withColumn("own", own)
    large = large.groupBy("bucket", "own", "others", "mains").agg(members)
    end = F.col("others") + F.when(F.col("own") < F.col("others"), F.col("mains")).otherwise(0) - 1
    large = large.where(end >= 0).select("bucket", "own", "members", F.explode(F.sequence(F.lit(0).cast("long"), end)).alias("other"))
    tile = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    large = large.select(tile.alias("tile"), (F.col("own") > F.col("other")).cast("int").alias("side"), "members")
    return small, large.repartition("tile").sortWithinPartitions("tile")


def _confirm(batches):
    for part in slices(slices(batches, "text_a"), "text_b"):
        a, b = (shingle_sets(*buffer_of(part.column(c))) for c in ("text_a", "text_b"))
        ok = []
        for x, y in zip(a, b, strict=True):
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            ok.append(100 * shared >= PERCENT * (len(both) - shared))
        yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """pairs(a, b) with ok: whether the full sets reach the similarity."""
    texts = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    with_b = pairs.join(texts, "b")
    texts = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return with_b.join(texts, "a").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long, ok boolean")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    docs needs doc_id and text; other columns are ignored. Null and empty texts have an empty set, are linked
    with nothing and kept. Rows that repeat a doc_id are reported each. Documents with equal sets are one class,
    whose least doc_id stands for it in the candidate search; links are confirmed on full sets. A task holds the
    full sets of one tile's members, up to GROUP documents.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialize(docs.mapInArrow(_sketch, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch binary"), "sketch")
    key = ["n_shingles", "k1", "k2"]
    classes = sketch.where("n_shingles > 0").groupBy(key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    first = sketch.where("n_shingles > 0").join(classes, (sketch.doc_id == classes.rep) & (sketch.k1 == classes.k1), "left_semi").dropDuplicates(["doc_id"])
    sketches = first.select(F.col("doc_id").alias("doc"), "sketch")
    member = first.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("bucket"))
    centre = member.groupBy("bucket").agg(F.min("doc").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = materialize(member.join(centre, "bucket").where("doc > a").select("bucket", "a", F.col("doc").alias("b")), "buckets")
    stars = materialize(_confirmed(star.select("a", "b").distinct(), docs).where("ok"), "checked")
    roots = components(stars.select("a", "b"))
    label = star.select("bucket", F.col("b").alias("doc")).join(roots, F.col("doc") == F.col("node"), "left")
    label = materialize(label.select("bucket", "doc", F.coalesce("root", "doc").alias("root")), "labels")
    rows = "tile long, doc long, root long, side int, sketch binary"
    small, large = (tiles.select("tile", "side", "members").mapInArrow(_members, rows) for tiles in _tiles(_families(label), sketches))
    near = materialize(small.unionByName(large), "near")
    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    near = near.join(texts, "doc").select("tile", "doc", "root", "side", "sketch", "text").repartition("tile").sortWithinPartitions("tile")
    joined = components(near.mapInArrow(_linked, "a long, b long")).select(F.col("node").alias("part"), F.col("root").alias("whole"))
    roots = classes.join(roots, classes.rep == roots.node, "left").select(*key, F.coalesce("root", "rep").alias("part"))
    classes = roots.join(joined, "part", "left").select(*key, F.coalesce("whole", "part").alias("class_root"))
    out = sketch.drop("bands", "sketch").join(classes, key, "left")
    root = F.coalesce("class_root", "doc_id")
    return out.select("doc_id", "n_shingles", root.alias("component_id"), F.coalesce(F.col("doc_id") == root, F.lit(True)).alias("kept"))
