"""Near-duplicate, suffix and de Bruijn operators against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import components, debruijn, minhash, suffixes

from .fixture import SCHEMA, documents, prose, sha, texts


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def classes(rows):
    sets, parent = {i: shingles(t) for i, t in rows.items()}, {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in rows:
        for j in rows:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in rows}


def chain() -> dict[int, str]:
    """Each text is near the next, the ends are far apart; one bucket's centre is not near to all."""
    words, out = prose(5, 200).split(" "), {}
    for k in range(8):
        for j in range(4):
            words[(k * 31 + j) % len(words)] = f"new{k}{j}"
        out[100 + k] = " ".join(words)
    return out


def test_near_duplicates(spark):
    rows = texts() | chain()
    got, want = rows_of(minhash.near_duplicates(documents(spark, rows))), classes(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_near_duplicates_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP", 2)
    rows = chain() | {k: prose(1, 80) + prose(k, 30) for k in range(30)}
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == classes(rows)


@pytest.mark.parametrize("operator", [minhash.near_duplicates, suffixes.remove_repeats, debruijn.remove_repeats])
def test_empty_tables_repeats_and_null_ids(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (1, prose(1, 50), "en", "s", 1, "w", 1, 2, 3)
    assert operator(spark.createDataFrame([row, row, (None, prose(2, 50), "en", "s", 1, "w", 1, 2, 3)], SCHEMA)).count() == 3


def brute_bytes(rows, width=50):
    seen, out = set(), {}
    for i in sorted(rows):
        b = (rows[i] or "").encode()
        gone, own = [False] * len(b), []
        for s in range(len(b) - width + 1):
            if b[s : s + width] in seen:
                gone[s : s + width] = [True] * width
            own.append(b[s : s + width])
        seen.update(own)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def test_suffixes(spark):
    rows = texts()
    got = rows_of(suffixes.remove_repeats(documents(spark, rows)))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute_bytes(rows)
    kept = rows_of(suffixes.remove_repeats(documents(spark, rows), texts=True))
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in kept.values())


def brute_words(rows, width=20):
    seen, out = set(), {}
    for i in sorted(rows):
        w = (rows[i] or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        out[i] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_debruijn(spark):
    rows = texts() | {40: "a b " * 40, 41: "b a " * 40, 42: prose(3, 40) + " " + prose(4, 40), 43: prose(4, 40) + " " + prose(3, 40)}
    got = rows_of(debruijn.remove_repeats(documents(spark, rows)))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == brute_words(rows)


def test_debruijn_paths_with_equal_ends(spark):
    """Paths that agree in all hashes of edges but not in words are told apart, and repeats within a run go."""
    passage = [f"p{k}" for k in range(60)]
    rows = {k: " ".join([f"a{k}", *passage, f"b{k}", *passage]) for k in range(5)}
    assert [r.n_removed for _, r in sorted(rows_of(debruijn.remove_repeats(documents(spark, rows))).items())] == [60, 120, 120, 120, 120]
    data = b"".join(b" ".join(b"%s%02d" % (c, k) for k in range(22)).ljust(90) for c in (b"x", b"y", b"x"))
    run = debruijn.Run(1, np.array([7, 7, 3], np.int64).tobytes(), np.array([0, 90, 180, 270], np.int64).tobytes(), pa.compress(data, "zstd", asbytes=True), 270)
    words = debruijn.Words(run)
    edges = debruijn.Edges(words, np.ones(len(words.window), bool))
    edges.hash[:] = 1
    got = debruijn._paths(run, words, edges, np.ones(len(edges.at), np.uint8)).to_pylist()
    assert sorted((r["doc_id"], r["start"], r["edges"], r["places"], r["n_least"]) for r in got) == [(3, 0, 3, [44, 0], 1), (7, 0, 3, [22], 1)]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 1), (5, 5)] + [(k, k + 1) for k in range(20, 60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {k: 20 for k in range(20, 61)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(words: list[str], rng, n: int, tag: str) -> list[str]:
    """The words with n of them, apart from each other, replaced."""
    out = list(words)
    for k in sorted(rng.sample(range(len(words) // 5), n)):
        out[5 * k + 2] = f"{tag}{k}"
    return out


def test_near_duplicates_of_a_base_in_the_middle(spark):
    """Each edit is near to the base and not to another edit; in most buckets the centre is an edit."""
    rng = random.Random(4)
    base = prose(11, 400, 100_000).split(" ")
    rows = {k: " ".join(base if k == 150 else edited(base, rng, 9, f"e{k}x")) for k in range(300)}
    want = classes(rows)
    assert len({root for _, root in want.values()}) == 1
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


def two_clusters(seed: int) -> dict[int, str]:
    """Two tight clusters; of all pairs across only that of the last documents reaches the threshold, by a hair."""
    rng = random.Random(seed)
    base = [f"s{seed}n{k}" for k in range(1200)]
    common, places = range(20), {0: range(40, 240, 2), 1: range(41, 240, 2)}
    out = {}
    for i in range(80):
        words, mine = list(base), rng.sample(places[i % 2], 7 if i >= 78 else 8)
        for k in mine + (list(common) if i % 2 else []):
            words[5 * k + 2] = f"s{seed}c{k}" if k in common else f"s{seed}d{i}k{k}"
        out[1000 * seed + i] = " ".join(words)
    return out


def test_near_duplicates_of_one_link_between_clusters(spark):
    rows = {i: t for seed in range(1, 5) for i, t in two_clusters(seed).items()}
    sets = {i: shingles(t) for i, t in rows.items()}
    across = [(i, j) for i in rows for j in rows if i < j and i // 1000 == j // 1000 and (j - i) % 2 and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert across == [(1000 * seed + 78, 1000 * seed + 79) for seed in range(1, 5)]
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: r.component_id for i, r in got.items()} == {i: i // 1000 * 1000 for i in rows}


def test_candidates_leave_out_no_near_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, minhash.BINS, dtype=np.uint8)
    sketches = np.repeat(base[None], 60, 0)
    for i in range(60):
        if i % 2:
            sketches[i, :90] += 1  # the second cluster
        sketches[i, rng.choice(np.arange(90, minhash.BINS), 12, replace=False)] += 7
    found = minhash.near_pairs(sketches, np.arange(60), np.zeros(60, np.int64))
    for i in range(60):
        for j in range(i + 1, 60):
            assert (j in found[i]) == ((sketches[i] == sketches[j]).mean() >= minhash.NEAR)
    across = minhash.near_pairs(sketches, np.arange(60) // 2, np.arange(60) % 2)
    assert all((i + j) % 2 and i // 2 != j // 2 for i in range(60) for j in across[i])


def test_links_of_a_tile_span_its_components():
    rng = np.random.default_rng(3)
    for _ in range(20):
        pool = rng.integers(0, 1 << 60, 60).astype(np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(20, 60), replace=False)) for _ in range(40)]
        roots = np.arange(40) // 2
        pairs = [np.array([j for j in range(i + 1, 40) if roots[i] != roots[j]], np.int64) for i in range(40)]
        found = minhash.links(sets, roots, pairs)
        own, want = list(range(20)), list(range(20))

        def merge(at, a, b):
            x, y = at[a], at[b]
            return [x if z == y else z for z in at]

        for a, b in found:
            assert own[a] != own[b]  # no link is said twice
            own = merge(own, a, b)
        for i in range(40):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if roots[i] != roots[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    want = merge(want, roots[i], roots[j])
        assert len(set(own)) == len(set(want)) and all((own[a] == own[b]) == (want[a] == want[b]) for a in range(20) for b in range(20))


def test_near_duplicates_of_a_hub(spark):
    """Eighty long edits that only their body links, and a part of the body that only the body links."""
    body = prose(7, 420, 100_000).replace("\n", " ").split(" ")
    rows = {k: " ".join([*body, *prose(1000 + k, 80, 100_000).split()]) for k in range(1, 81)}
    rows[500], rows[600] = " ".join(body), " ".join(body[:350])
    want = classes(rows)
    assert len({root for _, root in want.values()}) == 1
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


@pytest.mark.parametrize("seed", range(2))
def test_random_texts_near_the_threshold(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash, "GROUP", [400, 2][seed])
    rng = random.Random(seed)
    rows = {}
    for family in range(8):
        base = prose(100 * seed + family, 200, 100_000).split()
        for k in range(30):
            rows[1000 * rng.randrange(1000) + family * 30 + k] = " ".join(edited(base, rng, rng.randrange(3, 9), f"f{family}e{k}x"))
    want = classes(rows)
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


def test_near_duplicates_on_a_template_take_one_round(spark, monkeypatch):
    """Texts on one template below the threshold meet in most buckets; only one pair is linked."""
    made, rng = [], random.Random(8)

    def counted(df, name, materialize=minhash.materialize):
        made.append(name)
        assert len(made) < 20
        return materialize(df, name)

    monkeypatch.setattr(minhash, "GROUP", 10)
    monkeypatch.setattr(minhash, "materialize", counted)
    base = prose(11, 400, 100_000).split(" ")
    rows = {k: " ".join(base[:330] + prose(100 + k, 70, 100_000).split(" ")) for k in range(100)}
    rows[100] = " ".join(edited(rows[50].split(" "), rng, 3, "last"))
    want = classes(rows)
    assert len({root for _, root in want.values()}) == 100
    got = rows_of(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
