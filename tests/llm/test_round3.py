"""Tokenizer alignment, exact top-k search and conversation repair against plain versions and hard cases."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barloom.llm import align, annuli, langid, packing, turns, wrapper

from .fixture import documents, prose

# --- alignment

ODD = [None, "", " ", "  a  b", "\nx y", "a\tb  ", "a \n b", "ｆｕｌｌ ① é", "▁x <s> <0x41> </s>", "a b c  \nd", "a　 b", "<|endoftext|> x", "x" * 5000, "a;\r\nb {\r c"]
ODD += ["   \n q", "é è \u0085 x", "don't we'll  \n\n\n  x", "🙂 🙂\n🙂", "a\x00b", "a\x7f b", "\x1c \x1d x", "￼ 字 漢字", "end \n", "\n", prose(3, 9000)]


def plain_alignment(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    stands = align._unprintable()
    seen, links, count = {}, {}, Counter()
    for doc, text in rows:
        said, groups, links[doc], ids_a, ids_b = " " + (text or ""), [], [], [], []
        if text:
            enc, ids_b = a.encode(said, add_special_tokens=False), b.encode(text)
            ids_a = enc.ids
            bytes_a = [bytes(stands[c] for c in t) for t in enc.tokens]
            pieces = [b.id_to_piece(i) for i in ids_b]
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
            if not b"".join(bytes_a) == said.encode() == b"".join(bytes_b):
                ids_a, ids_b = [], []
        if ids_a:
            ends = dict(zip(np.cumsum([len(x) for x in bytes_a]).tolist(), range(len(ids_a)), strict=True))
            i = j = 0
            for k, end in enumerate(np.cumsum([len(x) for x in bytes_b]).tolist()):
                if end in ends:
                    links[doc].append((ids_a[ends[end]], ids_b[k]))
                    groups.append(",".join(map(str, ids_a[i : ends[end] + 1])) + "|" + ",".join(map(str, ids_b[j : k + 1])))
                    i, j = ends[end] + 1, k + 1
        count.update(links[doc])
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        seen[doc] = (len(ids_a), len(ids_b), len(groups), len(links[doc])), sha
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return {(doc, *n, sum(count[x] == top[x[1]] for x in links[doc]), sum(count[x] for x in links[doc]), sha) for doc, (n, sha) in seen.items()}


def test_alignment_of_odd_texts(spark):
    rows = dict(enumerate(ODD))
    got = align.digest(documents(spark, rows)).collect()
    assert {tuple(r) for r in got} == plain_alignment(rows.items())


def test_alignment_sends_narrow_rows(spark):
    rows = {k: prose(k, 9000) for k in range(4)} | {4: None, 5: "", 6: "a b"}
    docs = documents(spark, rows).coalesce(1)
    aligned = align.align(docs)
    wide = [f"octet_length({c})" for c, kind in aligned.dtypes if kind in ("string", "binary")]
    assert not [c for c, kind in aligned.dtypes if "<" in kind]
    assert max(aligned.selectExpr(f"max(greatest({', '.join(wide)}))").first()) <= 16384 < aligned.where("doc is not null").selectExpr("sum(octet_length(links))").first()[0]
    assert {tuple(r) for r in align.digest(docs).collect()} == plain_alignment(rows.items())


def test_alignment_remembers_so_many_bytes(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED_BYTES", 50_000, raising=False)
    both = align.Both(*align.default_paths())
    for k in range(12):  # pieces without a blank
        ids, places = both.encode(pa.array([f"{k}" + "字漢é" * 1500]))
        text = b"".join(both.bytes_a[i] for i in ids[0].tolist())
        assert text.decode() == f" {k}" + "字漢é" * 1500 and places[0][-1] == len(ids[0])
        assert sum(len(x if isinstance(x, bytes) else x[0]) for x in both.known) < 70_000


def test_alignment_of_repeated_rows_and_no_rows(spark):
    docs = documents(spark, {1: "one two", 2: None})
    assert align.digest(docs.where("false")).count() == 0
    twice = align.digest(docs.union(docs)).where("doc_id = 1").collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].count_sum == 2 * twice[0].n_links


@pytest.mark.parametrize("seed", range(6))
def test_diagonal_finds_all_common_ends(seed):
    rng = np.random.default_rng(seed)
    for size in (1, 2, 17, 300, 40_000):
        ends = np.arange(1, size + 1)
        keep = [np.union1d(ends[rng.random(size) < p], [size]) for p in ((0.9, 0.95), (0.1, 0.02), (1.0, 1.0), (0.5, 0.999), (0.01, 0.01), (1.0, 0.03))[seed]]
        i, j = align.diagonal(*keep)
        common = np.intersect1d(*keep)
        assert (keep[0][i] == common).all() and (keep[1][j] == common).all()


def test_distinct_pairs():
    rng = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 5), (5000, 9), (6000, 50_000)):
        a, b = rng.integers(0, top, n).astype(np.uint32), rng.integers(0, top, n).astype(np.uint32)
        pairs, link, times = align.distinct(a, b)
        assert (pairs[link] == a.astype(np.int64) * align.PAIR + b).all() and (np.diff(pairs) > 0).all()
        assert (np.bincount(link, minlength=len(pairs)) == times).all()


# --- top-k


def plain_top(rows, k=5):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(256.0 * x) for x in v):
            good.append((i, [int(np.floor(256.0 * x)) for x in v]))
    out = set()
    for q in {i for i, _ in good if i % 50 == 0}:
        own = max((annuli.pack_vector(np.array(v, float)), v) for i, v in good if i == q)[1]
        scored = sorted((-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(own, v, strict=False)))), i) for i, v in good if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def searched(spark, rows, pivots=8, sample=64):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = annuli.search(annuli.build(df, pivots, sample), df.where("vec_id % 50 = 0")).collect()
    assert len({(r.query_id, r["rank"]) for r in found}) == len(found)
    return {tuple(r) for r in found}


def test_top_k_of_near_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(annuli, "SHARD", 3000)
    monkeypatch.setattr(annuli, "ANNULUS", 40)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + rng.normal(scale=0.2, size=8)).tolist()) for i in range(-100, 900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(400)]  # a third at one place, in ties
    assert searched(spark, rows) == plain_top(rows)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, None), (50, [1.0, float("nan")]), (100, [1.0, None]), (150, [float("inf"), 0.0]), (None, [1.0, 1.0]), (200, []), (250, [1.0, -2.0]), (300, [3.0]), (7, [1e305, 0.0])]
    rows += [(1, [0.25, 0.5]), (2, [0.25, 0.5]), (2, [0.25, 0.5]), (350, [2.0, 2.0]), (350, [2.5, 2.0]), (3, [-1e17, 4.0]), (4, [1e9, 3e9, 1.0])]
    assert searched(spark, rows) == plain_top(rows)


def test_top_k_of_few_rows(spark):
    assert searched(spark, [(50, [1.0, 2.0]), (51, [0.0, 1.0])]) == {(50, 1, 51, 131072)}
    assert searched(spark, [(50, [1.0])]) == set()
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, score string")
    assert annuli.search(annuli.build(df), df).count() == 0


# --- conversations


def best_repair(rows):
    """Cost, audit and output of the cheapest repair, by trying all edits: rows are (role, text, must go, truncated)."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    name = {"u": "user", "a": "assistant"}

    @cache
    def go(i, place, put):
        found = []
        if i == len(rows):
            if place in (0, 3):
                found.append((0, "", ()))
        else:
            role, text, must, cut = rows[i]
            cost, audit, out = go(i + 1, place, 0)
            found.append((4 + cost, "D" + audit, out))
            if not must:
                if role[:1] in after[place]:
                    cost, audit, out = go(i + 1, after[place][role[:1]], 0)
                    found.append((3 * cut + cost, "K" + audit, ((role, text), *out)))
                for c in set(after[place]) & set("ua"):
                    cost, audit, out = go(i + 1, after[place][c], 0)
                    found.append((3 + 3 * cut + cost, "R" + audit, ((name[c], text), *out)))
        if put < 3:
            for c in set(after[place]) & set("ua"):
                cost, audit, out = go(i, after[place][c], put + 1)
                found.append((3 + cost, "I" + audit, ((name[c], ""), *out)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    return go(0, 0, 0)


def plain_audit(rows):
    """The query's rows from undamaged (conv_id, turn, role, text), and the repaired turns."""
    out, repaired = set(), {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        mine.sort(key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
        seen, marked, count = set(), [], Counter()
        for _, _, role, text in mine:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t for known, t, _, _ in mine if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, turns_ = best_repair(tuple(marked))
        repaired[conv] = list(turns_)
        text = "\n".join(f"{r}:{t}" for r, t in turns_)
        out.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out, repaired


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, rng.choice(["Yes.", "No!", "open", " \t\n", "", None, f"Turn {turn}.", "x. ", "é?\v"])))
    rows += [(None, 1, "user", "hello."), (None, 2, "assistant", "so."), (-4, None, None, None)]
    return rows + rows[:20]


def test_repair_against_all_edits(spark, monkeypatch):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x").repartition(5)
    want, repaired = plain_audit(rows)
    damaged = turns.damage(df.selectExpr("*", "'k' key", "1 code", "2 nth"))
    for size in ("10000", "7"):  # conversations over several Arrow batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert {tuple(r) for r in turns.audit(damaged).collect()} == want
            got: dict = {}
            for r in turns.repair(damaged).orderBy("conv_id", "place").collect():
                got.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == {c: [(k + 1, *t) for k, t in enumerate(ts)] for c, ts in repaired.items() if ts}


def test_repair_of_no_rows_and_a_giant(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert turns.audit(df).count() == turns.repair(df).count() == 0
    rows = spark.range(60_000).selectExpr("'one' conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat(id, '.') text")
    (one,) = turns.audit(rows).collect()
    text = "\n".join(f"{'user' if k % 2 == 0 else 'assistant'}:{k}." for k in range(60_000))
    assert one.audit == "K" * 60_000 and one.cost == 0 and one.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


# --- broken pages

HOSTILE = ["<a ", '<a "', "<a '\"", "<div>", "</p>", "</li>", "<div></p>", "<td>", "<!", "<x", "<script>", '<div x="', "<!--", "<dt><ul>"]


@pytest.mark.parametrize("bit", HOSTILE)
def test_a_megabyte_of_broken_markup_is_parsed_in_linear_time(bit):
    took = []
    for size in (250_000, 1_000_000):
        began = time.process_time()
        wrapper.parse(bit * (size // len(bit)))
        took.append(time.process_time() - began)
    assert took[1] < 4 and took[1] < 10 * took[0] + 0.5


def test_tags_end_outside_of_quotes():
    def said(page):
        return [n.text for n, _ in wrapper.texts_of(wrapper.parse(page))]

    assert said("<p title='a > b'>one</p><p title=\"c>\">two") == ["one", "two"]
    assert said('<div "><p>kept</p>') == ['<div ">', "kept"]  # the quote never ends, so the first is no tag
    assert said("<a <p>x</p>") == ["x"]
    assert said("1 < 2 <!-- <p>no</p> --> 3<!-- open <p>") == ["1 < 2 3"]
    assert said("<div>" * 300 + "deep" + "</p>" * 300 + "</div>" * 10) == ["deep"]


# --- the language net


def _small_net(seed):
    rng = np.random.default_rng(seed)
    net = langid.Net(["a", "b", "c"], seed)
    net.tables, net.out = [t.astype(np.float64) for t in net.tables], net.out.astype(np.float64)
    net.bias, net.out_bias = rng.normal(0, 0.1, net.bias.shape), rng.normal(0, 0.1, 3)
    x = rng.integers(0, langid.ALPHABET, (5, langid.WINDOW)).astype(np.uint8)
    return net, x, rng.integers(0, 3, 5)


def _plain_net(net, x):
    """Probabilities by a loop over windows, filters' widths and places."""
    out = []
    for w in x:
        pooled = []
        for table in net.tables:
            answers = [sum(table[k][w[i + k]] for k in range(len(table))) for i in range(langid.WINDOW - 3)]
            pooled.append(np.max(answers, axis=0))
        z = np.maximum(np.concatenate(pooled) + net.bias, 0) @ net.out + net.out_bias
        e = np.exp(z - z.max())
        out.append(e / e.sum())
    return np.array(out)


def test_net_against_a_plain_loop():
    net, x, _ = _small_net(1)
    assert net.prepare().predict(x) == pytest.approx(_plain_net(net, x), abs=1e-5)


def test_gradient_against_finite_differences():
    net, x, y = _small_net(2)
    loss = lambda: -np.log(_plain_net(net, x)[np.arange(len(y)), y]).mean()
    rng = np.random.default_rng(0)
    for p, g in zip([*net.tables, net.bias, net.out, net.out_bias], net._step(x, y), strict=True):
        strong = np.argsort(-np.abs(g).ravel())[:3]
        for k in {*strong.tolist(), int(rng.integers(p.size))}:
            at = np.unravel_index(k, p.shape)
            kept, step = p[at], 1e-6
            p[at] = kept + step
            up = loss()
            p[at] = kept - step
            down = loss()
            p[at] = kept
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


def test_packing_leaves_nothing_in_its_worker(monkeypatch):
    """Workers outlive their stages: what a task has learned would count against the stages after it."""

    class Direct:
        selectExpr = lambda self, *_: self
        mapInArrow = lambda self, run, _: run
        partitionId = lambda self: 0

    monkeypatch.setattr(packing.TaskContext, "get", classmethod(lambda _: Direct()))
    most, encode = [], packing.Words.encode
    monkeypatch.setattr(packing.Words, "encode", lambda self, texts: most.append(texts.nbytes) or encode(self, texts))
    texts = [" ".join(f"w{k}x{j}" for j in range(2000)) for k in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tokens = sum(b.column("length").to_numpy().sum() for b in packing.pack(Direct())(iter([batch])))
    assert tokens > 200 * 2000 and 1 < len(most) and max(most) < 1.2e6
    words = packing._known[packing.default_tokenizer()]
    assert len(words.pieces) == len(words.parts) == 1
