"""A training-data pipeline over ``documents``: each stage calls one operator of ``zonepulse.llm``.

Every stage takes all its predecessor kept and returns the columns of ``documents``, the
last one the encoded texts. Between stages the rows are written as Parquet in the shared
folder and read again. Columns that ``documents`` has beyond its own are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.blob_ledger import redacted, scan_paths
from zonepulse.llm.jaccard_join import jaccard_components
from zonepulse.llm.language_spans import fit, held_out, predict
from zonepulse.llm.mixing import mix, repeat_texts
from zonepulse.llm.text import n_words
from zonepulse.llm.trie_bpe import encode_texts, read_vocabulary
from zonepulse.session import materialise, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if its main language has at least this share of its letters.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, NULL ones too, and texts no one language prevails in."""
    model = fit(docs.filter(~held_out()), "doc_id", "text", "lang")
    found = predict(docs, model, keep=("text", "lang", "source", "n_chars"))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word n-grams the one with
    the smallest id stays, once; those without id come last.

    Rows are told apart by a 64-bit hash of id and text, so unlike texts under one id are
    documents of their own and copies without id are copies. Of rows equal in both, the one
    with the smallest other columns stays."""
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    keyed = docs.select(*COLUMNS, key.alias("_key"))
    groups = materialise(jaccard_components(keyed, k=5, threshold=(4, 5), id_col="_key"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    firsts = groups.join(keyed.select("_key", "doc_id").distinct(), "_key").groupBy("component_id").agg(F.min_by("_key", order).alias("_key"))
    least = F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("row")
    return keyed.join(firsts.select("_key"), "_key", "left_semi").groupBy("_key").agg(least).select("row.*").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mask; no document goes."""
    found = scan_paths(docs.select(*COLUMNS), scratch_path(spark, "ledger"))
    clean = found.withColumn("text", redacted(F.col("text"), F.col("spans")))
    hit = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, left out or, one per source, cut."""
    mixed = mix(docs.select(*COLUMNS), n_words(F.col("text")))
    cut = (F.col("mix_part") > 0) & (F.col("mix_part") < F.col("mix_size"))
    rows = repeat_texts(mixed.withColumn("_cut", cut), [*COLUMNS, "_cut"])
    return rows.withColumn("n_chars", F.when(F.col("_cut"), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: (doc_id, lang, source, n_tokens, ids)."""
    vocabulary = read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = encode_texts(docs, vocabulary, keep=("lang", "source"))
    ids = F.when(F.col("n_tokens") > 0, F.split("ids", ",")).otherwise(F.array().cast("array<string>")).cast("array<int>")
    return coded.select("doc_id", "lang", "source", "n_tokens", ids.alias("ids"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Learning, components of links and encoding have no SQL form; the tests hold each stage
#: against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
