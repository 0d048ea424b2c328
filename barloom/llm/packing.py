"""Pack tokenised documents into fixed windows, in order.

Each partition is one stream of its documents' ids. A dynamic program picks the window cuts among document
ends, sentence and line ends and, in very long sentences, evenly spaced places. The cost is padding plus a
penalty for a cut inside a document; the best predecessor of a place is the front of a monotone queue over the
places one window back. The stream is solved in blocks, so a task holds one block whatever its input.
"""

from __future__ import annotations

import os
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import SLICE_BYTES, SPACE, buffer_of, give_back, slices, word_spans

WINDOW = 2048
END_ID = 1
#: Penalties in tokens of padding for a cut at a sentence end inside a document, and inside a sentence.
SENTENCE_CUT, WORD_CUT = 2, 6
#: A stretch without a sentence end gets a place to cut each so many tokens.
STRIDE = 32
#: Tokens that one run of the dynamic program covers.
BLOCK = 128 * WINDOW
#: Distinct pieces that a worker remembers before it starts over; and of their parts; that is some 130 MB.
REMEMBERED = 250_000
#: Parts that one call of the tokenizer encodes.
JOINED = 4096

_PLAIN = "^[!-;=-~À-ÖØ-öø-ÿ]+$"
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+|\n")
_SENTENCE_END = "[.!?…][\"')”]?$"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Numbering(dict):
    """Numbers keys as they first appear and keeps the new ones until they are taken."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def take(self) -> list:
        new, self.new = self.new, []
        return new


class _Ids:
    """Ragged table of ids by number."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 16, np.uint16), 0
        self.start, self.size, self.rows = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(size) > len(self.size):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        if len(ids) and ids.max() > np.iinfo(self.flat.dtype).max:
            self.flat = self.flat.astype(np.uint32)
        self.flat[self.used : self.used + len(ids)] = ids
        at = slice(self.rows, self.rows + len(size))
        self.start[at], self.size[at] = self.used + np.cumsum(size) - size, size
        self.used, self.rows = self.used + len(ids), self.rows + len(size)

    def get(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[number].astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.start[number] - ends + size, size)], size


class Words:
    """Ids of texts, by way of the blank-separated pieces seen before.

    The tokenizer drops white space and never joins across it, so pieces can be encoded alone and remembered; Arrow
    finds a slice's distinct pieces. Pieces of plain Latin letters are split as the tokenizer splits them and their
    parts remembered too. New parts are encoded many at a time: the last id of a part, and no other, ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Let go of all that was learned; the tokenizer stays."""
        self.parts = None
        self.reset()

    def reset(self) -> None:
        if self.parts is None or len(self.parts) > REMEMBERED:
            self.parts, self.part_ids = _Numbering(), _Ids()
            self.parts.numbers(["\n"])
            self.parts.take()
            self.part_ids.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))
        self.pieces, self.ids = _Numbering(), _Ids()
        self.pieces.numbers([None])
        self.pieces.take()
        self.ids.add(np.array([END_ID], np.uint32), np.array([1]))
        self.stop = np.zeros(1 << 14, bool)
        self.stop[0] = True

    def _encode(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = [e.ids for e in self.tokenizer.encode_batch_fast(keys, add_special_tokens=False)]
        size = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter(chain.from_iterable(own), np.uint32, int(size.sum())), size

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, _ = self._encode([" ".join(parts[k : k + JOINED]) for k in range(0, len(parts), JOINED)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(parts) or ends[-1] != len(ids):  # a vocabulary without word ends
            return self._encode(parts)
        return ids, np.diff(ends, prepend=0)

    def _learn(self, new: list[str]) -> None:
        column = pa.array(new, pa.string())
        plain = np.asarray(pc.match_substring_regex(column, _PLAIN))
        size = np.zeros(len(new), np.int64)
        number = self.parts.numbers(_PARTS.findall("\n".join([*compress(new, plain), ""]).lower()))
        if fresh := self.parts.take():
            self.part_ids.add(*self._encode_parts(fresh))
        ids, each = self.part_ids.get(number)
        ends = np.cumsum(each)[number == 0]
        size[plain] = np.diff(ends, prepend=0)
        if not plain.all():
            odd, odd_size = self._encode(list(compress(new, ~plain)))
            size[~plain] = odd_size
            both = np.empty(len(ids) + len(odd), np.uint32)
            from_plain = np.repeat(plain, size)
            both[from_plain], both[~from_plain] = ids, odd
            ids = both
        while self.ids.rows + len(new) > len(self.stop):
            self.stop = np.concatenate([self.stop, np.zeros_like(self.stop)])
        self.stop[self.ids.rows : self.ids.rows + len(new)] = np.asarray(pc.match_substring_regex(column, _SENTENCE_END))
        self.ids.add(ids, size)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with END_ID after each; the texts' ends; the places of sentence, line and text ends."""
        if len(self.pieces) > REMEMBERED:
            self.reset()
        data, at = buffer_of(texts)
        starts, ends, doc = word_spans(data, at)
        border = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        body = np.ascontiguousarray(data[~SPACE[data]])
        seen = pa.StringArray.from_buffers(len(starts), pa.py_buffer(border), pa.py_buffer(body)).dictionary_encode()
        known = self.pieces.numbers(seen.dictionary.to_numpy(zero_copy_only=False).tolist())
        if new := self.pieces.take():
            self._learn(new)
        number = np.zeros(len(starts) + len(at) - 1, np.int64)  # 0 stands for END_ID behind each text
        place = np.arange(len(starts)) + doc
        number[place] = known[np.asarray(seen.indices)]
        stop = self.stop[number]
        breaks = np.flatnonzero(data == 10)
        last = np.searchsorted(starts, breaks) - 1  # the word before a line end, if it is of the same text
        last = last[(last >= 0) & (starts[last] >= at[np.searchsorted(at, breaks, "right") - 1])] if len(starts) else last[:0]
        stop[place[last]] = True
        ids, size = self.ids.get(number)
        after = np.cumsum(size)
        return ids.astype(np.uint32), after[number == 0], after[stop]


def places(doc_ends: np.ndarray, ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window may end, ascending, and the penalty of each."""
    marks = np.unique(ends[ends > 0])
    gaps = np.diff(marks, prepend=0)
    if len(long := np.flatnonzero(gaps > 2 * stride)):
        more = [np.arange(marks[k] - gaps[k] + stride, marks[k] - stride // 2, stride) for k in long]
        inner = np.concatenate(more)
    else:
        inner = marks[:0]
    where = np.concatenate([marks, inner])
    price = np.concatenate([np.where(np.isin(marks, doc_ends), 0, SENTENCE_CUT), np.full(len(inner), WORD_CUT)])
    order = np.argsort(where, kind="stable")
    return where[order], price[order]


def cut(where: np.ndarray, price: np.ndarray, window: int = WINDOW, last: bool = True) -> list[int]:
    """Cheapest ascending cuts with at most window tokens between two; where has no gap above window.

    last: the final place must be a cut; else the cheapest of the places in the final window ends the path.
    """
    pos, pen = [0, *where.tolist()], [0, *price.tolist()]
    best, came = [0] * len(pos), [0] * len(pos)
    # the queue's live part begins at front: costs plus places, ascending, and their numbers
    level, number, front = [0], [0], 0
    for j in range(1, len(pos)):
        p = pos[j]
        least = p - window
        while pos[number[front]] < least:
            front += 1
        came[j] = number[front]
        best[j] = cost = level[front] - least + pen[j]
        cost += p
        while len(level) > front and level[-1] >= cost:
            level.pop()
            number.pop()
        level.append(cost)
        number.append(j)
    j = len(pos) - 1
    if not last:
        tail = [k for k in range(len(pos) - 1, 0, -1) if pos[k] >= pos[-1] - window]
        j = min(tail, key=lambda k: (best[k], -k))
    out = []
    while j:
        out.append(pos[j])
        j = came[j]
    return out[::-1]


def powers(size: int) -> list[int]:
    """Ends of windows whose sizes are the powers of two in size: none of them needs padding."""
    out, at = [], 0
    for bit in range(size.bit_length() - 1, -1, -1):
        if size >> bit & 1:
            at += 1 << bit
            out.append(at)
    return out


class _Stream:
    def __init__(self, part: int, window: int):
        self.window, self.next = window, part << 40
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []  # id, tokens, end in ids; the first may have begun before ids[0]
        self.marks = [np.zeros(0, np.int64)]

    def add(self, doc_ids: list, ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> None:
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.docs += zip(doc_ids, np.diff(doc_ends, prepend=0).tolist(), (doc_ends + base).tolist(), strict=True)
        self.marks.append(ends + base)

    def flush(self, last: bool) -> pa.RecordBatch | None:
        if not len(self.ids):
            return None
        doc_ends = np.array([d[2] for d in self.docs], np.int64)
        marks = np.concatenate(self.marks)
        cuts = cut(*places(doc_ends, marks, min(STRIDE, self.window // 2)), self.window, last=False)
        if last:
            done = cuts[-1] if cuts else 0
            if len(self.ids) - done > self.window:
                raise AssertionError("the final window is too long")
            cuts += [done + x for x in powers(len(self.ids) - done)]
        out = self._pieces(np.array(cuts, np.int64), doc_ends)
        done = cuts[-1]
        keep = int(np.searchsorted(doc_ends, done, "right"))
        self.docs = [(i, n, e - done) for i, n, e in self.docs[keep:]]
        self.ids, self.marks = self.ids[done:], [marks[marks > done] - done]
        self.next += len(cuts)
        return out

    def _pieces(self, cuts: np.ndarray, doc_ends: np.ndarray) -> pa.RecordBatch:
        stops = np.union1d(cuts, doc_ends[doc_ends < cuts[-1]])
        begins = np.concatenate([[0], stops[:-1]])
        seq = np.searchsorted(cuts, begins, "right")
        doc = np.searchsorted(doc_ends, begins, "right")
        tokens = np.array([d[1] for d in self.docs], np.int64)
        opened = np.concatenate([[0], cuts[:-1]])
        data = self.ids[: cuts[-1]].astype("<u4").view(np.uint8)
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer((np.concatenate([[0], stops]) * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
        doc_id = pa.array([self.docs[k][0] for k in doc.tolist()], pa.int64())
        columns = [doc_id, begins - (doc_ends - tokens)[doc], stops - begins, tokens[doc], seq + self.next, begins - opened[seq], (cuts - opened)[seq]]
        arrays = [x if isinstance(x, pa.Array) else pa.array(x.astype(np.int64)) for x in columns]
        return pa.RecordBatch.from_arrays([*arrays, blobs], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "ids"])


_known: dict[str, Words] = {}


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, start, length, doc_tokens, sequence_id, offset, sequence_tokens, ids), one per piece.

    docs needs doc_id and text; other columns are ignored. ids are the piece's token ids as little-endian
    32-bit integers. A null text counts as empty: its only id is END_ID. Documents keep the table's order within
    a partition and sequences never mix partitions; the last tokens of a partition fill windows whose sizes are
    powers of two. Repeated rows are packed each. tokenizer: path of the vocabulary file on every executor.
    window must be 2 or more.
    """
    if window < 2:
        raise ValueError("a window has two tokens at least")

    def run(batches):
        path = tokenizer or default_tokenizer()
        words = _known.get(path) or _known.setdefault(path, Words(path))
        stream = _Stream(TaskContext.get().partitionId(), window)
        # a text's ids and their places take many times its bytes
        for part in slices(batches, limit=SLICE_BYTES // 2):
            ids, doc_ends, ends = words.encode(part.column("text"))
            stream.add(part.column("doc_id").to_pylist(), ids, doc_ends, ends)
            if len(stream.ids) >= BLOCK and (out := stream.flush(False)):
                yield out
        if out := stream.flush(True):
            yield out
        # the worker lives on, and runs tasks of other stages
        words.forget()
        give_back()

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, ids binary"
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)
