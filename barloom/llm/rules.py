"""Quality rules, with DataFrame functions alone.

Base rules count words, symbols, repeated lines and repeated five-word runs. Then two histograms of a document,
of its character classes and of the words commonest in its language, are held against the language's own by
Jensen-Shannon distance. Short documents and languages with little text are guarded from that verdict.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Base rules.
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
#: Words of a language's reference; the rest share one more bin.
COMMON = 32
#: Flags that tell most other words from a language's common ones.
SLOTS = 1024
#: Documents with fewer words, and languages with fewer in all, are not judged by distance.
GUARD_WORDS, GUARD_LANG_WORDS = 60, 2000
#: Greatest distances (square roots of divergences in bits) that a kept document may have.
MAX_CLASS, MAX_COMMON = 0.30, 0.45
#: References of at most so many languages are broadcast (a few kilobytes each); more are joined by shuffle.
BROADCAST_LANGS = 4096

BLANK = r"[\x20\x09-\x0D]"
#: Character classes; what is in none of them is the last class.
CLASSES = {"upper": r"\p{Lu}", "letter": r"[\p{L}&&[^\p{Lu}]]", "digit": r"\p{Nd}", "blank": BLANK, "mark": r"[.,;:!?'\"()\-]"}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def run_hashes(hashes: Column) -> Column:
    """A hash of each run of REPEAT_WINDOW neighbours of an array of word hashes, by the run's start."""
    inner = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(REPEAT_WINDOW)])
    return F.when(F.size(hashes) < REPEAT_WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(hashes) - REPEAT_WINDOW), inner))


def repeated_words(runs: Column) -> Column:
    """Words that lie in a run of REPEAT_WINDOW words found more than once, from the hashes of all runs."""
    width = REPEAT_WINDOW

    def covered(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(keys, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = _let(pairs, lambda s: F.filter(s, lambda e, j: ((j > 0) & (F.get(s, j - 1)["x"] == e["x"])) | (F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False)))))
        at = F.array_sort(F.transform(again, lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        add = lambda acc, q: F.struct((acc["n"] + F.least(F.lit(width), q - acc["last"])).alias("n"), q.alias("last"))
        return F.aggregate(at, start, add, lambda acc: acc["n"])

    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), 0).otherwise(covered(runs))


def common_counts(hashes: Column, common: Column, slots: Column) -> Column:
    """How often each of the common words (their hashes, up to COMMON) is among an array of word hashes, COMMON counts.

    slots, one flag for each remainder of a hash by SLOTS, tells most other words apart at one look-up. The rest
    turn into a letter each, so that counting is taking a letter out of a short string.
    """
    letters = F.array(*[F.lit(chr(64 + k) if k else "") for k in range(COMMON + 1)])
    likely = F.filter(hashes, lambda h: F.get(slots, F.pmod(h, F.lit(SLOTS)).cast("int")))
    said = F.array_join(F.transform(likely, lambda h: F.get(letters, F.array_position(common, h).cast("int"))), "")
    return _let(said, lambda x: F.transform(F.sequence(F.lit(1), F.lit(COMMON)), lambda k: F.length(x) - F.length(F.replace(x, F.get(letters, k), F.lit("")))))


def _left(text: Column, pattern: str) -> Column:
    """Characters of text that pattern, a class, takes."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def common_words(docs: DataFrame) -> DataFrame:
    """Per language its COMMON commonest words (ties by word), their counts and the count of all its words."""
    counts = docs.where("lang is not null and text is not null").select("lang", F.explode(words(F.col("text"))).alias("word"))
    counts = materialize(counts.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rank = F.expr("row_number() over (partition by lang order by n desc, word)")
    top = counts.withColumn("rank", rank).where(F.col("rank") <= COMMON)
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    return top.join(total, "lang").select("lang", F.col("top.word").alias("ref_words"), F.col("top.n").alias("ref_counts"), "total")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts with positive sums."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    share = lambda x: _let(total(x), lambda t: F.transform(x, lambda v: v / t))

    def half(a: Column, b: Column) -> Column:
        return total(F.zip_with(a, b, lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))))

    return _let(share(p), lambda a: _let(share(q), lambda b: F.sqrt(F.greatest(F.lit(0.0), (half(a, b) + half(b, a)) / 2))))


def judge(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, common_distance, kept).

    docs needs doc_id, text and lang; other columns are ignored. A null text counts as empty: no words, so the base
    rules fail it. Distances are null, and the base rules decide alone, where lang is null or under a guard. Rows
    are judged each, repeated or not. The references are counted over all rows with text and lang.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(text as string), '') text", "cast(lang as string) lang")
    refs = materialize(common_words(docs), "references").where(F.col("total") >= GUARD_LANG_WORDS)
    small = F.broadcast if refs.count() <= BROADCAST_LANGS else (lambda df: df)
    known = refs.select("lang", F.transform("ref_words", lambda x: F.xxhash64(x)).alias("common"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.exists("common", lambda h: F.pmod(h, F.lit(SLOTS)) == k))
    known = known.select("lang", "common", flags.alias("slots"))
    none = {"common": F.array().cast("array<bigint>"), "slots": F.array().cast("array<boolean>")}
    text = F.col("text")
    own = docs.join(small(known), "lang", "left").select("doc_id", "lang", "text", *[F.coalesce(k, v).alias(k) for k, v in none.items()])
    # each step's columns are worked out once, and outside of lambdas their functions are compiled
    own = own.withColumns({"h": F.transform(words(text), lambda x: F.xxhash64(x)), "rest": F.regexp_replace(text, f"{CLASSES['letter']}+", "")})
    own = own.withColumn("runs", run_hashes(F.col("h")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars, rest = F.length(text), F.col("rest")
    classes = [(chars - F.length(rest) if c == "letter" else _left(rest, p)).alias(c) for c, p in CLASSES.items()]
    own = own.select(
        "doc_id",
        "lang",
        F.size("h").alias("n_words"),
        _left(rest, r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("runs")).cast("long").alias("n_repeat_words"),
        chars.alias("n_chars"),
        *classes,
        common_counts(F.col("h"), F.col("common"), F.col("slots")).alias("found"),
    )
    others = F.col("n_words") - F.aggregate("found", F.lit(0), lambda a, b: a + b)
    hist = F.transform(F.concat(F.array(others), F.col("found")), lambda n: n.cast("double")).alias("hist")
    word_chars = (F.col("n_chars") - F.col("blank")).cast("long").alias("word_chars")
    counted = own.select("doc_id", "lang", F.col("n_words").cast("long").alias("n_words"), word_chars, "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", *CLASSES, hist)
    counted = materialize(counted, "counted")
    classes = list(CLASSES)
    rest = F.col("n_chars") - sum(F.col(c) for c in classes)
    as_array = lambda cols: F.array(*[c.cast("double") for c in cols])
    by_lang = counted.groupBy("lang").agg(*[F.sum(c).alias(c) for c in classes], F.sum(rest).alias("rest"))
    by_lang = by_lang.select("lang", as_array([F.col(c) for c in [*classes, "rest"]]).alias("ref_classes"))
    ref = refs.join(by_lang, "lang").select("lang", "ref_classes", F.transform("ref_counts", lambda n: n.cast("double")).alias("rc"), F.col("total").cast("double").alias("total"))
    other = F.col("total") - F.aggregate("rc", F.lit(0.0), lambda a, b: a + b)
    ref = ref.select("lang", "ref_classes", F.concat(F.array(other), F.col("rc")).alias("ref_hist"))
    out = counted.join(small(ref), "lang", "left")
    sized = F.col("ref_hist").isNotNull() & (F.col("n_words") >= GUARD_WORDS)
    # a language with fewer words than COMMON has a shorter reference; the missing bins are empty on both sides
    short = F.concat(F.col("ref_hist"), F.array_repeat(F.lit(0.0), F.lit(COMMON + 1) - F.size("ref_hist")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumns(
        {
            "base_failed": failed,
            "class_distance": F.when(sized, distance(as_array([*[F.col(c) for c in classes], rest]), F.col("ref_classes"))),
            "common_distance": F.when(sized, distance(F.col("hist"), short)),
        }
    )
    near = F.coalesce(F.col("class_distance") <= MAX_CLASS, F.lit(True)) & F.coalesce(F.col("common_distance") <= MAX_COMMON, F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "common_distance", (~F.col("base_failed") & near).alias("kept"))
