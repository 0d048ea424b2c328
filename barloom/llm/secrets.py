"""Secrets in text: fixed patterns, and credential values that would be costly to guess.

The guess cost of a value is the least total over all ways to cut it into words, dates, repeats, keyboard walks
and brute-force characters, found by a dynamic program over its characters. Words are ranked: common words of
passwords first, then the words commonest in the corpus. Every value in a credential context is costed, also those
that the fixed patterns hold. All patterns and the program take time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

# The kinds and patterns that results must follow.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")

#: Names that make the value after them a credential; the base names are among them.
CONTEXT = re.compile(
    r"""(?<![a-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?key|auth(?:orization)?|bearer)"""
    r"""["']?[ \t]*+(?::=|=>|[:=])[ \t]*+(?:["'`]|bearer[ \t]+|basic[ \t]+)?([^\s"'`,;<>(){}\[\]]{6,})""",
    re.IGNORECASE | re.ASCII,
)
URL_LOGIN = re.compile(r"://[^\s/:@]++:([^\s/:@]{6,}+)@", re.ASCII)
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer", "://")
#: A context value from so many bits on is reported.
MIN_BITS = 36.0
#: A repeat that goes on for so many characters is not cut inside.
SKIP = 64

#: Common words of passwords, commonest first.
WORDS = """password admin login user welcome letmein master secret dragon monkey football baseball shadow sunshine princess
qwerty iloveyou hello test demo example sample changeme default root guest access token value string none null true false
your my the key pass api app dev prod local server data system super magic summer winter spring autumn love star blue
red green black white orange silver gold tiger eagle lion""".split()
#: Words of the corpus that are ranked behind these, and their sizes.
DICTIONARY, SHORTEST, LONGEST = 10_000, 3, 20
#: The rarest word that is ranked is one of so many.
SHARE = 200_000
_LEET = str.maketrans("013457@$!", "oleastasi")
# The rows of a keyboard, and sequences that hands type as easily.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_STEP = {a + b for row in ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:], strict=False)}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
_BITS = {"digit": math.log2(10), "lower": math.log2(26), "upper": math.log2(26), "other": math.log2(33), "far": 7.0}


def _kind(c: str) -> str:
    return "far" if c > "\x7f" else "digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "other"


def ranks(words: list[str]) -> dict[str, float]:
    """Bits that guess each of a list of words, commonest first."""
    out: dict[str, float] = {}
    for w in words:
        out.setdefault(w, math.log2(len(out) + 2))
    return out


_BUILT_IN = ranks(WORDS)


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> dict[str, float]:
    """WORDS and then the size commonest words of docs(text), ties in alphabetical order, with the bits that guess them.

    All documents are counted. Only words that make up one in SHARE of all words are ranked, so that at most SHARE
    words are sorted whatever the documents; the driver gets size of them.
    """
    words = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(SHORTEST, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(words, "dictionary")
    total = words.agg(F.sum("n")).first()[0] or 0
    words = words.where(F.col("n") >= total / SHARE)
    return ranks([*WORDS, *(r.word for r in words.orderBy(F.desc("n"), "word").limit(size).collect())])


def _reach(same: np.ndarray, n: int) -> list[int]:
    """For each of n places how many True follow each other from it on."""
    stop = np.where(same, n, np.arange(len(same)))
    stop = np.minimum.accumulate(np.append(stop, len(same))[::-1])[::-1]
    return np.pad(stop - np.arange(len(stop)), (0, n + 1 - len(stop))).tolist()


def guess_bits(value: str, words: dict[str, float] | None = None, enough: float = math.inf) -> float:
    """Base-2 logarithm of the guesses that the cheapest segmentation of value needs; 0 for an empty value.

    Repeats of 1 to 4 characters and keyboard walks reach as far as they go. No cut is made inside of a repeat that
    goes on for SKIP characters. A cost from enough on may be any number from enough on.
    """
    words = _BUILT_IN if words is None else words
    n = len(value)
    low = value.lower()
    low = low if len(low) == n else value
    plain = low.translate(_LEET)
    kind = [_kind(c) for c in value]
    bits = [_BITS[k] for k in kind]
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    again = {u: _reach(code[:-u] == code[u:] if n > u else np.zeros(0, bool), n) for u in (1, 2, 3, 4)}
    walk = _reach(np.fromiter((a + b in _STEP for a, b in zip(low, low[1:], strict=False)), bool, max(0, n - 1)), n)
    cost = [0.0] + [math.inf] * n
    far = 0
    for i in range(n):
        base = cost[i]
        if base == math.inf or (i >= 4 and any(again[u][i - u] >= SKIP for u in again)):
            continue
        if i % 32 == 0 and min(cost[i : max(far, i) + 1]) >= enough:
            return min(cost[i : max(far, i) + 1])
        # brute force; a change of kind costs a bit
        reached = [(i + 1, bits[i] + (1.0 if i and kind[i] != kind[i - 1] else 0.0))]
        for j in range(i + SHORTEST, min(n, i + LONGEST) + 1):
            rank = words.get(plain[i:j])
            if rank is not None:
                changed = sum(a != b for a, b in zip(low[i:j], plain[i:j], strict=True))
                capitals = sum(c.isupper() for c in value[i:j])
                reached.append((j, rank + 2.0 + changed + capitals))
        if kind[i] == "digit" and (m := _DATE.match(value, i)):
            reached.append((m.end(), 7.0 if m.end() - i == 4 else 15.5))
            if value[i : i + 2] in ("19", "20"):
                reached.append((i + 4, 7.0))
        for u, reach in again.items():
            if reach[i] >= u:
                size = reach[i] // u * u + u
                reached.append((i + size, sum(bits[i : i + u]) + math.log2(size) + 1.0))
        if walk[i] >= 2:
            reached.append((i + walk[i] + 1, bits[i] + math.log2(walk[i] + 1) + 2.0))
        for j, more in reached:
            if base + more < cost[j]:
                cost[j] = base + more
                far = max(far, j)
    return cost[n]


def find(text: str, words: dict[str, float] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of every span, by start then kind; end is exclusive, both count code points."""
    low = text.lower()
    out = []
    if any(x in low for x in _ASSIGN_HINTS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if any(x in low for x in _CONTEXT_HINTS):
        values = sorted({m.span(1) for pattern in (CONTEXT, URL_LOGIN) for m in pattern.finditer(text)})
        end = 0
        for s, e in values:
            if s >= end and guess_bits(text[s:e], words, MIN_BITS) >= MIN_BITS:
                out.append((s, e, 3))
                end = e
    return sorted(out)


def _rows(batches, words):
    for part in slices(batches):
        spans = [find(t, words) if t else [] for t in part.column("text").to_pylist()]
        said = [[f"{KINDS[k]}:{s}:{e}" for s, e, k in own] for own in spans]
        base = [",".join(x for x, (_, _, k) in zip(a, b, strict=True) if k < 3) for a, b in zip(said, spans, strict=True)]
        count = [[sum(k == kind for _, _, k in own) for own in spans] for kind in range(4)]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                *(pa.array(c, pa.int64()) for c in count),
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                pa.array([",".join(x) for x in said]),
            ],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"],
        )


def scan(docs: DataFrame, words: dict[str, float] | None = None) -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans), one per document.

    docs needs doc_id and text; other columns are ignored. Null and empty texts have no spans: counts of 0, an
    empty string and its digest. Repeated rows are scanned each. Spans of kind guess are the values of credential
    contexts, within pattern spans or not, whose guess cost reaches MIN_BITS; of overlapping ones the first counts.
    words, as dictionary gives them, are broadcast: some hundred kilobytes.
    """
    held = docs.sparkSession.sparkContext.broadcast(words)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(lambda batches: _rows(batches, held.value), schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", words: dict[str, float] | None = None) -> DataFrame:
    """docs, all columns in place, with mark for every span (overlapping spans share one) and n_chars, if there, counted anew.

    Null and empty texts stay as they are; repeated rows are redacted each.
    """
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            for k, text in enumerate(texts):
                spans = find(text, held.value) if text else []
                done, end = [], 0
                for s, e, _ in spans:
                    if s >= end:
                        done += [text[end:s], mark]
                    end = max(end, e)
                if spans:
                    texts[k] = "".join([*done, text[end:]])
            yield part.set_column(names.index("text"), "text", pa.array(texts, part.column("text").type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out
