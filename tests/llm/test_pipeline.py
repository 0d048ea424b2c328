"""Every stage of the pipeline on its own input, against a plain version; and the whole run."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from barloom.llm import minhash, secrets

from .fixture import SCHEMA, documents, prose, texts
from .test_dedup import classes

STAGE = dict(corpus_pipeline.STAGES)
BENCH = {1: prose(501, 40), 2: prose(502, 60), 3: None, 4: ""}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = texts()
    rows[30] = prose(30, 100) + "\n" + BENCH[1] + "\n" + prose(31, 100)
    rows[31] = "my password = q9Zr7LwX2vTb1 and " + prose(32, 60)
    rows[32] = "12 34 -- 99"
    documents(spark, rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(BENCH.items()), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]


def test_stages(spark, folder):
    at, rows = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    kept = lambda df: {r.doc_id: r for r in df.collect()}

    got = STAGE["language_id"](spark, docs, at)
    assert got.columns == columns
    assert set(kept(got)) == {i for i, t in rows.items() if t and any(c.isalpha() for c in t)}

    got = STAGE["near_dedup"](spark, docs, at)
    assert got.columns == columns
    assert set(kept(got)) == {i for i, (_, root) in classes(rows).items() if i == root}

    got = STAGE["decontamination"](spark, docs, at)
    assert got.columns == columns and set(rows) - set(kept(got)) == {30}

    got = STAGE["secret_scan"](spark, docs, at)
    assert got.columns == columns
    found = kept(got)
    assert set(found) == set(rows) and "q9Zr" not in found[31].text and "[SECRET]" in found[31].text
    for i, t in rows.items():
        assert found[i].text == t or secrets.find(t)

    got = STAGE["packing"](spark, docs, at).toPandas()
    from tokenizers import Tokenizer

    from barloom.llm import packing

    t = Tokenizer.from_file(packing.default_tokenizer())
    for i, text in rows.items():
        own = got[got.doc_id == i].sort_values("start")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in own.ids])
        assert ids.tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert [zlib.crc32(b) for b in own.ids] == own.ids_crc32.tolist()


def test_stages_on_empty_tables_and_repeats(spark, folder):
    at, _ = folder
    docs = documents(spark, {1: prose(1, 80), 2: None})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), at).count() == 0
        assert stage(spark, docs.unionByName(docs).drop("n_chars"), at).select("doc_id").distinct().count() == (1 if name == "language_id" else 2)


def test_run(spark, folder):
    at, rows = folder
    got = {r.doc_id for r in corpus_pipeline.run(spark, at).select("doc_id").distinct().collect()}
    lettered = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    assert got == {i for i, (_, root) in classes(lettered).items() if i == root} - {30}
    assert minhash.PERCENT == 75
