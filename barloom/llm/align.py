"""Align two tokenizers' ids of the same text by the ends of their bytes.

Both tokenize a slice of documents; the ends of the tokens' bytes are two ascending arrays. Where the arrays agree at a
shift of their indices, the tokens match one to one: probes of doubling length compare the arrays along that diagonal and jump
over the stretch. At the first difference a window is resolved by itself, its common ends become groups, and the
shift is set anew. Tokenizers see each distinct stretch of text once: pieces that neither can join with what lies before them.

Pairs of ids that end together are counted over all documents: each slice sends its distinct pairs with their counts, and
gets back the totals of those. What a slice sends is cut into small rows, since Spark's readers and writers of Parquet hold
thousands of rows at once, whatever their width.
"""

from __future__ import annotations

import functools
import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, materialize, slices
from .packing import _Ids as Ragged
from .packing import _Numbering as Numbering

#: Bytes of text in a slice, and distinct pieces, and bytes of them, that a worker remembers before it starts over.
SLICE, REMEMBERED, REMEMBERED_BYTES = 2 << 20, 400_000, 32 << 20
#: Links in a row of a document; more are rows of their own.
PART = 4096
#: New pieces that one call of a tokenizer encodes.
JOINED = 4096
#: Length of the first probe along a diagonal, and least and greatest window of an irregular group.
PROBE, LEAST, GREATEST = 16, 64, 8192
#: Token B's share of a pair's code: a pair is a * PAIR + b.
PAIR = 1 << 20


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _unprintable() -> dict[str, int]:
    """The bytes that stand for themselves in byte-level tokens, and the characters from U+0100 on for the others, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Both:
    """Ids and byte lengths of texts by both tokenizers, piece by piece."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _unprintable()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in word) if all(c in byte for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # a piece of text may begin at a blank or line end behind other bytes if no token of B holds one there
        self.apart = not any(" " in p[1:].lstrip(" ") or "\n" in p for p in (x.replace("▁", " ") for x in pieces))
        self.space = self.b.piece_to_id("▁")
        self.sizes = [np.fromiter(map(len, t), np.int64, len(t)) for t in (self.bytes_a, self.bytes_b)]
        self.reset()

    def reset(self) -> None:
        self.known = Numbering()
        self.known.numbers([b""])
        self.known.take()
        self.held = 0
        self.ids, self.fits = (Ragged(), Ragged()), [True]
        for table in self.ids:
            table.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _encode_b(self, texts: list[str]) -> list[list[int]]:
        """B's ids of texts that follow others: its leading blank is the text's own, or goes."""
        found = self.b.encode([t[1:] if t.startswith(" ") else t for t in texts], num_threads=1)
        return [ids if t.startswith(" ") else ids[1:] if ids[:1] == [self.space] else [0] for t, ids in zip(texts, found, strict=True)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Number new pieces and add their ids; many are encoded as one text, whose tokens end where the pieces do."""
        self.held += sum(map(len, pieces))
        # behind a piece that ends in a blank, and before one that doesn't begin with one, others could join
        plain = [p for p in pieces if p[-1:] > b" " and p[0] in (32, 10)]
        for lo in range(0, len(plain), JOINED):
            some = plain[lo : lo + JOINED]
            self.known.numbers(some)
            if not self._learn_joined(some):
                self._learn_each(some)
        odd = [p for p in pieces if not (p[-1:] > b" " and p[0] in (32, 10))]
        self.known.numbers(odd)
        self._learn_each(odd)
        self.known.take()

    def _learn_each(self, pieces: list[bytes]) -> None:
        for piece in pieces:
            text = piece.decode("utf-8", "replace")
            a, b = self.a.encode(text, add_special_tokens=False).ids, self._encode_b([text])[0]
            self._add(a, b, self._gives(a, b, piece))

    def _learn_joined(self, pieces: list[bytes]) -> bool:
        whole = b"".join(pieces)
        if not self.apart:
            return False
        text = whole.decode("utf-8", "replace")
        both = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self._encode_b([text])[0]
        if not self._gives(*both, whole):
            return False
        ends, rows = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), []
        for ids, size in zip(both, self.sizes, strict=True):
            ids = np.array(ids, np.uint32)
            after = np.cumsum(size[ids])
            last = np.searchsorted(after, ends)
            if (after[last] != ends).any():
                return False
            rows.append((ids, np.diff(last, prepend=-1)))
        for table, row in zip(self.ids, rows, strict=True):
            table.add(*row)
        self.fits += [True] * len(pieces)
        return True

    def _gives(self, a: list[int], b: list[int], text: bytes) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == text == b"".join(map(self.bytes_b.__getitem__, b))

    def _add(self, a: list[int], b: list[int], fits: bool) -> None:
        for table, ids in zip(self.ids, (a, b), strict=True):
            table.add(np.array(ids, np.uint32), np.array([len(ids)]))
        self.fits.append(fits)

    def _whole(self, text: bytes) -> int:
        """The number of one text's ids, taken without cutting it; 0 if either tokenizer's bytes aren't the text's."""
        said = text.decode("utf-8", "replace")
        a, b = self.a.encode(said, add_special_tokens=False).ids, self.b.encode(said[1:], num_threads=1)
        if not self._gives(a, b, text):
            return 0
        self.known.numbers([(text,)])  # under a key that no piece has
        self.known.take()
        self.held += len(text)
        self._add(a, b, True)
        return len(self.fits) - 1

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts by A and by B, and the n + 1 places of each text's in them. Empty texts have none."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.reset()
        data, at = buffer_of(texts)
        count = len(at) - 1
        # a blank before each text that has bytes
        size = np.diff(at)
        full = size > 0
        lead = np.cumsum(full) - full
        out = np.full(len(data) + int(full.sum()), 32, np.uint8)
        out[np.arange(len(data)) + np.repeat(lead + 1, size)] = data
        at = np.concatenate([[0], np.cumsum(size + full)])
        cut = self._cuts(out, at)
        doc = np.searchsorted(at, cut, "right") - 1
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(np.append(cut, len(out)).astype(np.int64)), pa.py_buffer(out)]).dictionary_encode()
        names = column.dictionary.to_pylist()
        self._learn([n for n in names if n not in self.known])
        known = self.known.numbers(names)
        number = known[np.asarray(column.indices)] if len(cut) else known
        fits = np.array(self.fits)[number]
        for d in np.unique(doc[~fits]).tolist():  # a piece doesn't come back as it was: the whole text decides
            lo, hi = np.searchsorted(doc, [d, d + 1])
            number[lo:hi] = 0
            number[lo] = self._whole(out[at[d] : at[d + 1]].tobytes())
        ids, places = [], []
        for table in self.ids:
            own, length = table.get(number)
            ids.append(own)
            places.append(np.concatenate([[0], np.cumsum(length)])[np.searchsorted(doc, np.arange(count + 1))])
        return ids, places

    def _cuts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of pieces: of each text, and of each run of blanks and line ends behind a visible character."""
        first = at[:-1][np.diff(at) > 0]
        if not self.apart or not len(data):
            return first
        gap = (data == 32) | (data == 10)
        solid = (data > 32) & (data != 127)
        solid[1:] &= ~((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)))
        wide = (data >= 0xE1) & (data <= 0xE3)  # the last byte of blanks of other scripts
        solid[2:] &= ~(wide[:-2] & ((data[1:-1] == 0x9A) | (data[1:-1] == 0x80) | (data[1:-1] == 0x81)))
        start = np.zeros(len(data), bool)
        start[1:] = gap[1:] & solid[:-1]
        start[first] = True
        return np.flatnonzero(start)


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices i and j of all equal ends of two ascending arrays whose last ends are equal.

    Probes of doubling length run along the current shift j - i; where they differ, a window is matched by itself, and grows while
    there is nothing but irregular groups.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    i = j = 0
    window = LEAST
    while i < len(ends_a) and j < len(ends_b):
        start, probe = i, PROBE
        while True:
            size = min(probe, len(ends_a) - i, len(ends_b) - j)
            apart = ends_a[i : i + size] != ends_b[j : j + size]
            same = int(apart.argmax()) if size and apart.any() else size
            i, j = i + same, j + same
            if same < size or not size:
                break
            probe *= 2
        if i > start:
            run = np.arange(start, i)
            found.append((run, run + (j - i)))
        if i == len(ends_a) or j == len(ends_b):
            break
        window = LEAST if i - start >= PROBE else min(2 * window, GREATEST)
        size = window
        while True:
            a, b = ends_a[i : i + size], ends_b[j : j + size]
            where = np.minimum(np.searchsorted(b, a), len(b) - 1)
            hit = np.flatnonzero(b[where] == a)
            if len(hit) or (size > len(ends_a) - i and size > len(ends_b) - j):
                break
            size *= 2
        if not len(hit):
            break
        found.append((i + hit, j + where[hit]))
        i, j = i + int(hit[-1]) + 1, j + int(where[hit[-1]]) + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


@functools.cache
def _decimals(most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of the numbers 0 to most: how many digits, and the digit of each place from the right, as text."""
    number = np.arange(most + 1)
    size = sum(((number >= 10**k).astype(np.int64) for k in range(1, len(str(most)))), np.ones(most + 1, np.int64))
    return size, [(48 + number // 10**k % 10).astype(np.uint8) for k in range(len(str(most)))]


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs a * PAIR + b, which of them each pair is, and how often each occurs."""
    ua, ra = np.unique(a, return_inverse=True) if len(a) < 1 << 12 else _renumbered(a)
    ub, rb = np.unique(b, return_inverse=True) if len(b) < 1 << 12 else _renumbered(b)
    code = ra.astype(np.int64) * max(len(ub), 1) + rb
    if len(ua) * len(ub) > 8 * len(a) + (1 << 20):
        found, link, times = np.unique(code, return_inverse=True, return_counts=True)
    else:
        counts = np.bincount(code, minlength=len(ua) * len(ub))
        found = np.flatnonzero(counts)
        place = np.zeros(len(counts), np.int64)
        place[found] = np.arange(len(found))
        link, times = place[code], counts[found]
    if not len(found):
        return found.astype(np.int64), link, times
    return ua[found // len(ub)].astype(np.int64) * PAIR + ub[found % len(ub)], link, times


def _renumbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros(int(x.max()) + 1, bool)
    seen[x] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[x]


def spelled(ids: list[np.ndarray], last: list[np.ndarray], doc_groups: np.ndarray) -> list[bytes]:
    """For each text `a1,a2|b1;a3|b2,b3`: its groups' ids in decimal. last: for A and B, each group's last place."""
    groups = len(last[0])
    each = [np.diff(x, prepend=-1) for x in last]
    # places of the ids in the joined order: a group's A ids, then its B ids
    before = [np.concatenate([[0], np.cumsum(x)])[:-1] for x in each]
    total = each[0] + each[1]
    start = np.concatenate([[0], np.cumsum(total)])
    joined = np.empty(int(start[-1]), np.int32)
    joined[np.repeat(start[:-1] - before[0], each[0]) + np.arange(len(ids[0]))] = ids[0]
    joined[np.repeat(start[:-1] + each[0] - before[1], each[1]) + np.arange(len(ids[1]))] = ids[1]
    mark = np.full(len(joined), ord(","), np.uint8)
    mark[start[:-1] + each[0] - 1] = ord("|")
    mark[start[1:] - 1] = ord(";")
    digits, places = _decimals(int(joined.max(initial=0)))
    size = digits[joined]
    ends = np.cumsum(size + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    for k, table in enumerate(places):
        some = np.flatnonzero(size > k)
        out[ends[some] - 2 - k] = table[joined[some]]
    border = np.concatenate([[0], ends])[start[doc_groups]]
    assert len(doc_groups) and doc_groups[-1] == groups
    blob = out.tobytes()
    return [blob[a : max(a, b - 1)] for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]


_known: dict[tuple[str, str], Both] = {}
_ROW = {"slice": pa.int64(), "k": pa.int32(), "pair": pa.int64(), "n": pa.int64(), "doc": pa.int32()}
_ROW |= {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "sha": pa.string(), "links": pa.binary()}
_ROWS = "slice long, k int, pair long, n long, doc int, doc_id long, n_a long, n_b long, n_groups long, sha string, links binary"


def _rows(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    """Rows of an aligned slice; columns that aren't given are null."""
    size = len(columns["slice"])
    arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in _ROW.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_ROW))


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Slices of docs (doc_id, text), aligned, in rows of two kinds, both with the number of their slice. Where doc is null: the
    k-th of the slice's distinct pairs of ids that end together, and its count n there. Else of its doc-th document up to PART
    links, as numbers k; a document's first row has doc_id, n_a, n_b, n_groups and sha (of the groups' spelling) too.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens. Repeated rows
    are aligned each; extra columns are ignored; a very long text is a slice of its own. paths: the tokenizers' files on every executor.
    """

    def run(batches):
        own = paths or default_paths()
        both = _known.get(own) or _known.setdefault(own, Both(*own))
        base = TaskContext.get().partitionId() << 32
        for k, part in enumerate(slices(batches, limit=SLICE)):
            ids, places = both.encode(part.column("text"))
            ends = [np.cumsum(t[i]) for t, i in zip(both.sizes, ids, strict=True)]
            last = diagonal(*ends)
            groups = np.searchsorted(last[0], places[0])
            said = spelled(ids, list(last), groups)
            pairs, link, times = distinct(ids[0][last[0]], ids[1][last[1]])
            sha = [hashlib.sha256(s).hexdigest() if s else "" for s in said]
            yield _rows({"slice": np.full(len(pairs), base + k), "k": np.arange(len(pairs)), "pair": pairs, "n": times})
            doc, start = parts(groups)
            first = np.diff(doc, prepend=-1) > 0
            whole = {c: x[doc] for c, x in (("n_a", np.diff(places[0])), ("n_b", np.diff(places[1])), ("n_groups", np.diff(groups)))}
            columns = {c: pa.array(x, pa.int64(), mask=~first) for c, x in whole.items()}
            columns["doc_id"] = part.column("doc_id").cast(pa.int64()).take(pa.array(np.where(first, doc, 0), mask=~first))
            columns["sha"] = pa.array(sha, pa.string()).take(pa.array(np.where(first, doc, 0), mask=~first))
            columns["links"] = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((np.append(start, len(link)) * 4).astype(np.int32)), pa.py_buffer(link.astype("<u4"))])
            yield _rows({"slice": np.full(len(doc), base + k), "doc": doc, **columns})

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, _ROWS)


def parts(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows that n documents' links are cut into, the document and the first link. groups: the n + 1 borders of their links."""
    size = np.diff(groups)
    rows = np.maximum(1, -(-size // PART))
    doc = np.repeat(np.arange(len(size)), rows)
    return doc, groups[doc] + PART * (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows (a, b, n, best): how many links of all documents join the ids a and b, and whether no other a has more with b."""
    counts = aligned.where("doc is null").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b", F.col("pair") % PAIR)
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(top, "b").select(F.expr(f"pair div {PAIR}").alias("a"), "b", "n", (F.col("n") == F.col("top")).alias("best"))


def digest(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. The cases are those of align()."""
    aligned = materialize(align(docs, paths), "aligned", "zstd")
    counts = materialize(pair_counts(aligned), "pairs").select((F.col("a") * PAIR + F.col("b")).alias("pair"), F.col("n").alias("all"), "best")
    known = aligned.where("doc is null").select("slice", "k", "pair").join(counts, "pair").select(F.col("slice").alias("own"), "k", "all", "best")

    def sums(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _DIGEST.items()})
        n, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        at = np.asarray(found.column("k"))
        n[at], best[at] = np.asarray(found.column("all")), np.asarray(found.column("best").cast(pa.int64()))
        data, ends = buffer_of(rows.column("links"))
        link, ends, doc = data.view("<u4"), ends // 4, np.asarray(rows.column("doc"))

        def summed(x: np.ndarray) -> np.ndarray:
            out = np.zeros(int(doc.max()) + 1, np.int64)
            np.add.at(out, doc, np.diff(np.concatenate([[0], np.cumsum(x)])[ends]))
            return out

        first = rows.filter(rows.column("n_a").is_valid())
        own = np.asarray(first.column("doc"))
        sent = [first.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
        columns = [*sent, *(pa.array(summed(x)[own]) for x in (np.ones(len(link), np.int64), best[link], n[link])), first.column("sha")]
        return pa.table(dict(zip(_DIGEST, columns, strict=True)))

    kept = aligned.where("doc is not null").drop("k", "pair", "n").groupBy("slice").cogroup(known.groupBy("own"))
    return kept.applyInArrow(sums, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


_DIGEST = {c: pa.int64() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")} | {"groups_sha256": pa.string()}
