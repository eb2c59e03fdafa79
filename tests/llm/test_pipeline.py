"""The pipeline's stages against plain versions, and the published queries as a whole."""

from __future__ import annotations

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as P
from tools.check import connect, difference
from zonepulse.llm.oracles import SQL

from . import brute


DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def data():
    return DATA


@pytest.fixture(scope="module")
def stages(spark, data):
    """Each stage's input and output, through Parquet as run() has it."""
    from zonepulse.session import materialise

    docs, out = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, stage in P.STAGES:
        made = materialise(stage(spark, docs, data))
        out[name] = (docs, made)
        docs = made
    return out


def test_names_and_columns(stages, spark, data):
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "secrets", "mixing", "encoding"]
    documents = spark.read.parquet(f"{data}/documents.parquet").dtypes
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.dtypes == documents, name


def test_language_keeps_clean_documents(stages):
    before, after = stages["language_id"]
    assert after.count() >= 0.98 * before.count()
    assert after.exceptAll(before).count() == 0


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    groups = brute.jaccard_components([(r.doc_id, r.text) for r in before.collect()], 5, (4, 5), False)
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in groups.values()})
    assert after.count() < before.count()
    assert after.exceptAll(before).count() == 0


def test_repeated_and_missing_ids(spark, data):
    """Unlike texts under one id stay, and copies without id are copies."""
    long = lambda w: " ".join(f"{w}{i}" for i in range(40))
    rows = [
        (1, long("a"), "en", "s", 1),
        (1, long("b"), "en", "s", 1),
        (1, long("b"), "de", "s", 1),  # equal in id and text
        (2, long("b"), "en", "s", 1),
        (None, long("c"), "en", "s", 1),
        (None, long("c"), "en", "s", 1),
        (None, long("a"), "en", "s", 1),
        (None, long("d"), "en", "s", 1),
        (3, long("d") + " tail", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{data}/documents.parquet").schema)
    want = [rows[0], rows[2], rows[4], rows[8]]
    for d in (docs, docs.repartition(5)):
        assert sorted(map(tuple, P.drop_near_duplicates(spark, d, data).collect()), key=str) == sorted(want, key=str)


def test_secrets_are_gone_and_nothing_else(stages, spark, data):
    from .test_ledger import expected

    planted = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" password=hunter2222"))).otherwise(F.col("text"))
    before = stages["secrets"][0].withColumn("text", planted)
    after = P.redact_secrets(spark, before, data)
    texts = {r.doc_id: r.text for r in after.collect()}
    assert len(texts) == before.count()
    hit = 0
    for r in before.collect():
        if expected(r.text):
            hit += 1
            assert "[REDACTED]" in texts[r.doc_id] and not expected(texts[r.doc_id])
        else:
            assert texts[r.doc_id] == r.text
    assert hit


def test_mix_is_what_the_operator_takes(stages):
    from zonepulse.llm.mixing import mix, taken_words
    from zonepulse.llm.text import n_words

    before, after = stages["mixing"]
    wanted = {r.source: r.t for r in mix(before, n_words(F.col("text"))).groupBy("source").agg(F.sum(taken_words()).alias("t")).collect()}
    got = {}
    for r in after.collect():
        got[r.source] = got.get(r.source, 0) + len(brute.words(r.text))
        assert r.n_chars is not None
    assert got == {s: t for s, t in wanted.items() if t}


def test_encoding(stages):
    before, after = stages["encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == expected


def test_run_equals_the_stages(stages, spark, data):
    got = P.run(spark, data)
    want = stages["encoding"][1]
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stages_take_messy_and_empty_tables(spark, messy, nothing, data):
    for docs in (messy, nothing):
        docs = docs.unionByName(docs.limit(2))
        for _, stage in P.STAGES:
            docs = stage(spark, docs.withColumn("spans", docs["doc_id"]), data)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, data, name):
    assert difference(contract.queries()[name](spark, data), connect(data), SQL[name]) is None


def test_all_numbered_queries_are_published():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [f"op{i}_" for i in (1, 5, 8, 9, 10)])
def test_one_row_per_document(spark, data, name):
    full = next(n for n in contract.queries() if n.startswith(name))
    got = contract.queries()[full](spark, data)
    ids = spark.read.parquet(f"{data}/documents.parquet").select("doc_id")
    assert got.select("doc_id").exceptAll(ids).count() == 0 and got.count() == ids.count()
