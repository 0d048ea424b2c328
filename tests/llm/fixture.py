"""Small documents with the cases that every operator must stand: nulls, empties, ties, repeats, long texts, clashing names."""

import hashlib
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, rank int, bucket long, a long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    pool = [f"w{rng.randrange(vocabulary)}{'aeiou'[k % 5]}" for k in range(words)]
    for k in range(9, words, 10):
        pool[k] += "."
    for k in range(37, words, 38):
        pool[k] += "\nNext"
    return " ".join(pool)


def texts() -> dict[int, str | None]:
    base = {k: prose(k, 60 + 7 * k) for k in range(12)}
    base[12] = None
    base[13] = ""
    base[14] = " \n\t "
    base[15] = base[3]  # exact copies
    base[16] = base[3]
    base[17] = base[5].replace("w1", "W1", 3)  # the same but for case
    words = base[7].split(" ")
    words[10] = "changed"
    base[18] = " ".join(words)  # a near copy
    base[19] = base[8][:300] + " " + base[2][40:400]  # shares passages
    base[20] = "one two three"
    base[21] = "ONE two three"
    base[22] = "again and again " * 60
    base[23] = prose(99, 20_000)  # very long
    base[24] = base[23][5000:9000]
    base[25] = "ÄÖÜ ß é 漢字 🙂 word-with\u00a0nbsp " * 20
    base[26] = "x" * 3000
    return base


def documents(spark, rows: dict[int, str | None] | None = None):
    rows = texts() if rows is None else rows
    data = [(i, t, [None, "en", "fr"][i % 3], "s", None if t is None else len(t), "w", 1, 2, 3) for i, t in rows.items()]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
