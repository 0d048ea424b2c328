"""Packing, secrets, rules, language, quality, pages and decontamination."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import decontam, langid, linecrf, packing, rules, secrets, wrapper

from .fixture import SCHEMA, documents, prose, sha, texts


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    rows = texts()
    got = packing.pack(documents(spark, rows)).toPandas()
    t = Tokenizer.from_file(packing.default_tokenizer())
    for i, text in rows.items():
        own = got[got.doc_id == i].sort_values("start")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in own.ids]).tolist()
        assert ids == [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert own.start.tolist() == np.cumsum([0, *own.length[:-1]]).tolist() and set(own.doc_tokens) == {len(ids)}
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == np.cumsum([0, *own.length[:-1]]).tolist() and own.length.sum() <= packing.WINDOW
    sizes = got.groupby("sequence_id").length.sum()
    assert sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in sizes) < 0.05 * sizes.sum()
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_are_the_tokenizers():
    rng = np.random.default_rng(8)
    bits = ["don't", "it'S", "naïve", "e\u0301a", "Straße", "x<y", "<|endoftext|>", "12ab", "a.b!?", "…”", "日本", "🙂👍", "\u00a0", "\u0085", "\t", "\n", "\r\n", "\x0b", " ", "  ", "\u0301", "İ", "ÀÖ", "×÷", "'", "'ll", "_", "\x7f", "\x00", "ﬁ"]
    texts = ["".join(bits[k] + " " * int(rng.integers(0, 2)) for k in rng.integers(0, len(bits), n)) for n in rng.integers(0, 30, 2000)]
    words = packing.Words(packing.default_tokenizer())
    ids, ends, stops = words.encode(pa.array(texts))
    own = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [[*x, 1] for x in own]
    assert set(ends) <= set(stops)


def test_small_windows(spark):
    rows = {1: prose(1, 300), 2: None, 3: "word " * 50}
    got = packing.pack(documents(spark, rows), window=32).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 32
    assert got.groupby("doc_id").length.sum().equals(got.groupby("doc_id").doc_tokens.max())
    twice = packing.pack(documents(spark, rows).unionByName(documents(spark, rows))).toPandas()
    assert (twice.groupby("doc_id").length.sum() == 2 * twice.groupby("doc_id").doc_tokens.max()).all()


@pytest.mark.parametrize("seed", range(5))
def test_cuts_cost_least(seed):
    rng = np.random.default_rng(seed)
    where = np.cumsum(rng.integers(1, 5, 12))
    price = rng.integers(0, 4, 12)
    window = 9

    def cost(cuts):
        return sum(window - (b - a) + price[list(where).index(b)] for a, b in zip([0, *cuts], cuts, strict=False))

    best, every = None, {0: (0, [])}
    for j, p in enumerate(where.tolist()):
        every[p] = min(((every[a][0] + window - (p - a) + price[j], [*every[a][1], p]) for a in every if 0 < p - a <= window), key=lambda x: x[0])
    best = every[int(where[-1])][0]
    assert cost(packing.cut(where, price, window)) == best


def test_secret_spans(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    rows = {
        1: f"my password = 'hunter2hunter2' and {key} and {'0af9' * 10}",
        2: "secret: token: abcdefghij",  # the short value takes the rest away
        3: "PassWd=short API_KEY: longenough1",
        4: "db_pwd = zQ8#kV2!mT7pLx9 and client-key: password123",
        5: None,
        6: "ÄÖ🙂 token=abcdefgh",
        7: "",
    }
    got = rows_of(secrets.scan(documents(spark, rows)))
    base = {
        1: ["assign:3:29", "access:35:55", "hex:60:100"],
        2: [],
        3: ["assign:13:33"],
        4: [],
        5: [],
        6: ["assign:4:18"],
        7: [],
    }
    for i, want in base.items():
        assert got[i].base_sha256 == sha(",".join(want).encode()), got[i]
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 1)
    assert got[4].spans == "guess:9:24" and got[6].spans == "assign:4:18"
    strong = secrets.find("x token=q9Zr7LwX2vTb1")
    assert strong == [(2, 21, 0), (8, 21, 3)]  # a value inside a pattern's span is costed too
    clean = rows_of(secrets.redact(documents(spark, rows)))
    assert clean[6].text == "ÄÖ🙂 [SECRET]" and clean[6].n_chars == len(clean[6].text) and clean[5].text is None and clean[2].text == rows[2]
    assert secrets.redact(spark.createDataFrame([], SCHEMA)).count() == 0


def segment_bits(value, i, j, words):
    """Least cost of value[i:j] as one segment, read off the definitions."""
    bits, low, part = secrets._BITS, value.lower(), value[i:j]
    kinds = [secrets._kind(c) for c in value]
    plain = "".join(dict(zip("013457@$!", "oleastasi", strict=True)).get(c, c) for c in low)
    out = [np.inf]
    if j == i + 1:
        out.append(bits[kinds[i]] + (i > 0 and kinds[i] != kinds[i - 1]))
    if plain[i:j] in words:
        out.append(words[plain[i:j]] + 2 + sum(a != b for a, b in zip(low[i:j], plain[i:j], strict=True)) + sum(c.isupper() for c in part))
    if re.fullmatch(r"(19|20)\d\d", part):
        out.append(7.0)
    elif re.fullmatch(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d", part):
        out.append(15.5)
    for u in (1, 2, 3, 4):
        unit, times = low[i : i + u], (j - i) // u
        if len(unit) == u and times > 1 and low[i:j] == unit * times and low[j : j + u] != unit:
            out.append(sum(bits[k] for k in kinds[i : i + u]) + np.log2(j - i) + 1)
    steps = [low[k : k + 2] in secrets._STEP for k in range(len(value))]
    if j - i > 2 and all(steps[i : j - 1]) and not (j < len(value) and steps[j - 1]):
        out.append(bits[kinds[i]] + np.log2(j - i) + 2)
    return min(out)


@pytest.mark.parametrize("seed", range(4))
def test_guess_costs_over_all_segmentations(seed):
    rng = np.random.default_rng(seed)
    words = secrets.ranks(["pass", "cat", "tor", "abc"])
    bits = ["pass", "P4s", "s", "cat", "C", "1999", "12", "ab", "qwe", "aaa", "x", "é", "7", "_", "2001-02-03"]
    for _ in range(60):
        value = "".join(bits[k] for k in rng.integers(0, len(bits), 5))[:13]
        n, best = len(value), np.inf
        known = {(i, j): segment_bits(value, i, j, words) for i in range(n) for j in range(i + 1, n + 1)}
        for cuts in range(1 << (n - 1)):
            at = [0, *(k + 1 for k in range(n - 1) if cuts >> k & 1), n]
            total = 0.0
            for i, j in zip(at, at[1:], strict=False):
                total += known[i, j]
                if total >= best:
                    break
            best = min(best, total)
        assert secrets.guess_bits(value, words) == pytest.approx(best), value


def test_long_values_take_little_time():
    for text in ("7" * 1_000_000, "a" * 1_000_000, "ab" * 500_000, "key=" + "x" * 1_000_000, "token: " + "12" * 500_000, "key " + "1" * 300_000):
        began = time.process_time()
        secrets.find("key " + text)
        assert time.process_time() - began < 5
    assert secrets.guess_bits("ab" * 500_000) < 40
    digits = "".join(map(str, np.random.default_rng(1).integers(0, 10, 200_000)))
    assert secrets.find("password=" + digits)[-1] == (9, 9 + len(digits), 3)


def test_dictionary(spark):
    docs = documents(spark, {1: "zebra Zebra lion the_zebra", 2: None, 3: "lion x1 apple"})
    words = secrets.dictionary(docs, 2)
    assert list(words)[-1] == "zebra" and "apple" not in words and words["zebra"] > words["lion"]
    assert secrets.dictionary(spark.createDataFrame([], SCHEMA)) == secrets.ranks(secrets.WORDS)
    twice = secrets.scan(docs.unionByName(docs), words)
    assert twice.count() == 6 and secrets.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_guess_costs_are_ordered():
    weak = ["password", "qwertyuiop", "aaaaaaaaaaaa", "19991231", "abcabcabc", "P4ssw0rd"]
    assert max(map(secrets.guess_bits, weak)) < secrets.MIN_BITS < secrets.guess_bits("zQ8#kV2!mT7p")
    assert secrets.guess_bits("") == 0
    # no segmentation is cheaper than brute force on a text without patterns
    assert secrets.guess_bits("xvkw") == pytest.approx(4 * np.log2(26))


def base_counts(text):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w, seen, again = word.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if word.search(line):
            again += line in seen
            seen.add(line)
    runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    inside = {j for k in range(len(w) - 4) if runs[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(inside), failed


def test_rules(spark):
    rows = texts() | {30: "a b\na b\n\n\nc # $ 漢\na b", 31: "### " * 200}
    got = rows_of(rules.judge(documents(spark, rows)))
    for i, text in rows.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(text), i
        assert not (r.kept and r.base_failed)
    assert got[3].kept and got[3].class_distance is None  # its lang is null
    assert rules.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_distance(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        rules.distance(F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(3.0), F.lit(3.0))).alias("same"),
        rules.distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))).alias("apart"),
    )
    assert tuple(row.first()) == pytest.approx((0.0, 1.0))


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(docs)
    got = langid.identify(docs, net).withColumn("held", langid.is_held_out()).join(docs.select("doc_id", "lang"), "doc_id").where("held").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = rows_of(langid.identify(documents(spark, {1: None, 2: "", 3: "12 34 !?", 4: "e"}), net))
    assert [odd[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and odd[4].lang_pred != "und"
    assert {r.doc_id for r in langid.keep_identified(documents(spark, {1: None, 2: "12", 3: docs.first().text}), net).collect()} == {3}
    nothing = spark.createDataFrame([], SCHEMA)
    assert langid.train(nothing) is None and langid.identify(nothing, net).count() == 0
    assert {r.lang_pred for r in langid.identify(documents(spark), None).collect()} == {"und"}


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = linecrf.train(docs, labels)
    got = linecrf.score(docs, field).withColumn("held", langid.is_held_out()).join(labels, "doc_id").where("held").toPandas()
    assert got[got.quality == 1].score.mean() - got[got.quality == 0].score.mean() > 0.5
    rows = rows_of(linecrf.score(documents(spark), field))
    for i, text in texts().items():
        assert len(rows[i].line_scores) == (text or "").count("\n") + 1 and 0 <= rows[i].score <= 1
    assert linecrf.train(docs, labels.limit(0)) is None
    assert {r.score for r in linecrf.score(documents(spark), None).collect()} == {0.5}
    assert linecrf.score(spark.createDataFrame([], SCHEMA), field).count() == 0


def test_lines_differ_within_a_document(spark):
    """Only documents are labelled; stretches of junk in good documents and of prose in bad ones are told apart."""
    rng = np.random.default_rng(5)
    rows, labels, junk = {}, [], {}
    for i in range(300):
        bad = i % 2
        lines, marks = [], []
        while len(lines) < 24:
            of_junk = rng.random() < (0.65 if bad else 0.15)
            for _ in range(int(rng.integers(2, 6))):
                lines.append("$$ #%& 12 <<>> ** 99 |" if of_junk else prose(int(rng.integers(1 << 30)), 12).replace("\n", " "))
                marks.append(of_junk)
        rows[i], junk[i] = "\n".join(lines), np.array(marks)
        labels.append((i, 1 - bad))
    docs = documents(spark, rows)
    field = linecrf.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = rows_of(linecrf.score(docs.unionByName(docs), field))
    for bad in (0, 1):
        own = [i for i in rows if i % 2 == bad]
        good, worse = (np.concatenate([np.array(got[i].line_scores)[junk[i] == k] for i in own]).mean() for k in (False, True))
        assert good - worse > 0.1, (bad, good, worse)
    assert np.mean([(got[i].score >= 0.5) == (i % 2 == 0) for i in rows]) > 0.85


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    field = linecrf.Field(np.zeros((1, 7)), np.zeros(0, np.uint64))
    field.stay = 0.8
    evidence, first = rng.normal(size=6), np.array([0, 1, 4, 6])
    good, equal = field.marginals(evidence, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        total, up, same = 0.0, np.zeros(n), np.zeros(n)
        for bits in range(1 << n):
            y = np.array([bits >> k & 1 for k in range(n)])
            w = np.exp((evidence[a:b] * y).sum() + field.stay * (y[1:] == y[:-1]).sum())
            total, up = total + w, up + w * y
            same[:-1] += w * (y[1:] == y[:-1])
        assert good[a:b] == pytest.approx(up / total) and equal[a : b - 1] == pytest.approx(same[:-1] / total)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>{0} &amp; more</h1><p>{1} <b>bold</b>
 text<br>{1}<p>Share this page<ul><li>x{0}<li>y{0}</ul><form><input>f</form><div class=comments><p>c</div></article><aside>s</aside><footer>&copy;</footer>"""


def test_pages(spark):
    pages = [(k, f"http://h.example/{k}", PAGE.format(f"Title{k}", f"Body {k}"), 1) for k in range(6)]
    pages += [(10, "http://one.example/a", PAGE.format("A", "B"), 1), (11, None, "<p>a</p> b", 1), (12, "u", None, 1), (13, "http://h.example/", "", 1), (14, "x://y", "plain &lt;text&gt;&nbsp;here", 1)]
    got = rows_of(wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string, host int")), "page_id")
    for k in range(6):
        assert got[k].text == f"Title{k} & more\nBody {k} bold text Body {k}\nxTitle{k}\nyTitle{k}"
    assert "Share this page" in got[10].text and got[11].text == "a\nb" and got[12].text == got[13].text == "" and got[14].text == "plain <text> here"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def heaviest(a, b):
    """Weight of a heaviest match by trying all order-preserving pairings of children."""
    if a.name != b.name:
        return 0
    if a.name == "":
        return 2 if a.key == b.key else 1

    def lists(x, y):
        if not x or not y:
            return 0
        return max(lists(x[1:], y), lists(x, y[1:]), heaviest(x[0], y[0]) + lists(x[1:], y[1:]))

    return 1 + lists(a.children, b.children)


def random_tree(rng, depth=0):
    if depth == 3 or rng.random() < 0.3:
        return f"#{rng.integers(0, 3)},5,5 "
    return "abp"[rng.integers(0, 3)] + "(" + "".join(random_tree(rng, depth + 1) for _ in range(rng.integers(0, 4))) + ")"


@pytest.mark.parametrize("cells", [wrapper.CELLS, 0])
def test_tree_matching(monkeypatch, cells):
    monkeypatch.setattr(wrapper, "CELLS", cells)
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (wrapper.unpack_tree("r(" + "".join(random_tree(rng) for _ in range(4)) + ")") for _ in range(2))
        total, pairs = wrapper.match(a, b)
        assert all(u.name == v.name for u, v in pairs) and len({u.number for u, _ in pairs}) == len({v.number for _, v in pairs}) == len(pairs)
        assert total == sum(2 if u.name == "" and u.key == v.key else 1 for u, v in pairs)
        assert total == heaviest(a, b) or not cells  # wide elements pair their children kind by kind
    assert wrapper.match(wrapper.unpack_tree("a(#1,1,1 )"), wrapper.unpack_tree("b(#1,1,1 )")) == (0, [])


def test_wrapper_finds_the_region_without_element_rules(spark):
    """Menus, adverts and footers whose words differ on every page, in elements without telling names."""
    rng = np.random.default_rng(6)
    said = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 900, n))
    pages, want = [], {}
    for k in range(14):
        body = [said(8)] + [said(int(n)) for n in rng.integers(5, 60, 5)]
        wide = "".join(f"<p>{x}</p>" for x in body[1:])
        links = "".join(f'<li><a href="#">{said(2)}</a></li>' for _ in range(6))
        core = f'<div id="c{k}"><h2>{body[0]}</h2><div>{wide}</div></div>' if k < 8 else f"<section><h2>{body[0]}</h2>{wide}</section>"
        pages.append((k, f"https://h.example/{k}", f"<html><body><div class=m><ul>{links}</ul></div><div>{said(9)}</div>{core}<div class=z>(c) {said(7)}</div></body></html>"))
        want[k] = "\n".join(body)
    pages += [(100 + k, "https://h.example/e", "") for k in range(5)] + [(0, pages[0][1], pages[0][2])] * 3
    got = wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), rules=False).collect()
    assert len(got) == len(pages) and all(r.text == want.get(r.page_id, "") for r in got)


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 10_000 + "deep" + "</div>" * 10_000
    wide = "".join(f"<p>{k}</p>" for k in range(3000))
    pages = [(k, f"http://h.example/{k}", (deep if k % 2 else wide) + f"<p>own {k}</p>") for k in range(12)]
    got = rows_of(wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")), "page_id")
    assert all(got[k].text.endswith(f"own {k}") for k in range(12))
    marked = '<body class="x"><div class="content has-sidebar"><article><p>in</p></article></div><nav><article><p>out</p></article></nav></body>'
    assert wrapper.extract(spark.createDataFrame([(1, "u", marked)], "page_id long, url string, html string")).first().text == "in"


def test_leaks(spark):
    rng = np.random.default_rng(2)
    pool = [f"term{k}x" for k in range(3000)]
    plain = {k: " ".join(rng.choice(pool, 150)) for k in range(120)}
    items = {k: " ".join(rng.choice(pool, 30 + k)) for k in range(8)}
    item = items[3].split(" ")
    plain[200] = plain[5][:200] + " " + items[1] + " " + plain[6][:300]
    plain[201] = plain[7] + " " + " ".join(w for k, w in enumerate(item) if k % 5)  # a fifth of the words is gone
    plain[202] = items[2].upper()
    plain[203], plain[204] = None, ""
    bench = spark.createDataFrame([*items.items(), (90, None), (91, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(documents(spark, plain), bench).collect()}
    assert got == {(200, 1), (201, 3), (202, 2)}
    assert decontam.leaks(documents(spark, plain), bench.limit(0)).count() == 0
    assert decontam.leaks(spark.createDataFrame([], SCHEMA), bench).count() == 0


def test_recall_of_paraphrases(spark):
    """Against the common subsequence of every item and document: at least nine in ten, and no clean document."""
    rng = np.random.default_rng(12)
    pool = np.array([f"term{k}x" for k in range(4000)])
    odds = 1 / np.arange(1, 4001)
    said = lambda n: rng.choice(pool, n, p=odds / odds.sum()).tolist()
    items = {k: said(int(rng.integers(20, 60))) for k in range(40)}
    rows = {k: said(250) for k in range(80)}
    for k, words in items.items():
        changed = [str(rng.choice(pool)) if rng.random() < 0.2 else w for w in words]
        rows[1000 + k] = said(100) + changed + said(80)
    want = {(i, k) for i, there in rows.items() for k, own in items.items() if i >= 1000 and i - 1000 == k and decontam.lcs(own, there) >= decontam.CERTAIN * len(own)}
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    docs = documents(spark, {i: " ".join(v) for i, v in rows.items()})
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs.unionByName(docs), bench).collect()}
    assert len(want) > 30 and len(got & want) >= 0.9 * len(want)
    assert not {i for i, _ in got if i < 1000}


def test_leaks_of_long_items_and_of_shared_ids(spark):
    """Sixty words of an item of two hundred leak; so does each text of an item_id; a long text of common words doesn't."""
    rng = np.random.default_rng(4)
    said = lambda n: [f"term{k}x" for k in rng.integers(0, 3000, n)]
    long, one, two = said(200), said(30), said(30)
    few = [f"term{k}x" for k in range(25)]
    rows = {k: said(200) for k in range(40)}
    rows[100] = said(70) + long[75:135] + said(70)
    rows[101], rows[102] = said(50) + one + said(50), said(50) + two + said(50)
    rows[103] = [w for _ in range(40) for w in rng.permutation(few)]
    items = [(1, long), (2, one), (2, two), (3, few)]
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items], "item_id long, text string")
    docs = documents(spark, {i: " ".join(v) for i, v in rows.items()})
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()} - {(103, 3)} == {(100, 1), (101, 2), (102, 2)}
    items = decontam._Items([3], *decontam._words(pa.array([" ".join(few)])), *decontam.latent_space(docs))
    there, _ = decontam._words(pa.array([" ".join(rows[103] + few)]))
    first, last, common, _ = items.confirm(0, there)
    assert common == 25 and last - first <= 3 * (25 + 2 * decontam.HALF) and last == len(there)


def test_lcs():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 90)).tolist()
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.lcs(a, b) == table[-1][-1]


def test_crc_of_ids(spark):
    row = packing.pack(documents(spark, {1: "hello"})).selectExpr("crc32(ids) c", "ids").first()
    assert row.c == zlib.crc32(bytes(row.ids)) and prose(1, 3)


def test_wide_elements_match_as_narrow_ones(monkeypatch):
    """The size of a table decides how it is kept, not what it says: not even which of equal matches is found."""
    rng = np.random.default_rng(8)
    for _ in range(100):
        a, b = (wrapper.unpack_tree("r(" + "".join(random_tree(rng) for _ in range(6)) + ")") for _ in range(2))
        found = []
        for cells in (wrapper.CELLS, 6, 0):
            with monkeypatch.context() as patch:
                patch.setattr(wrapper, "CELLS", cells)
                total, pairs = wrapper.match(a, b)
            found.append((total, [(u.number, v.number) for u, v in pairs]))
        assert found[0] == found[1] == found[2] and found[0][0] == heaviest(a, b)


def test_a_wide_element_that_starts_with_more(monkeypatch):
    """Paired in their order, no two of these rows would say the same."""
    row = lambda k: f"tr(td(#1,5,5 )td(#{k + 10},5,5 ))"
    a, b = (wrapper.unpack_tree("r(" + "".join(row(k) for k in range(lo, lo + 600)) + ")") for lo in (0, 7))
    assert wrapper.match(a, b)[0] == 1 + 593 * 7
