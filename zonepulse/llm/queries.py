"""The published queries of the numbered operators: thin digests over their results."""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .blob_ledger import RULES, listed, scan_paths
from .collisions import near_vectors
from .hilbert import Dim, hilbert_shards
from . import language_spans, multi_index, outliers
from .jaccard_join import jaccard_components
from .merkle import digest, fold, manifest, proof_text
from .mixing import mix, taken_words
from .oracles import SQL
from .relative_lz import remove_repeats
from .text import n_words
from .token_alignment import align, read_tokenizers
from .trie_bpe import encode_texts, read_vocabulary
from .warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def published(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@published
def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return outliers.judge(docs).select(*columns)


@published
def op2_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = multi_index.usable(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return multi_index.search(vectors, vectors.filter("id % 20 = 0"), k=20)


@published
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = archive_pages(spark, table(spark, folder, "pages"), least_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@published
def op4_relative_lz(spark: SparkSession, folder: str) -> DataFrame:
    parsed = remove_repeats(table(spark, folder, "documents"), window=13)
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@published
def op5_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mix(docs, n_words(F.col("text")))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        taken_words().alias("taken"),
    )


@published
def op6_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over all documents from one ledger: first the base rules, the hex rule in a
    version before, then all rules as they are. The second run scans only pairs that the
    ledger does not have, and the findings of both are joined."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = scratch_path(spark, "ledger")
    scan_paths(docs, ledger, tuple(replace(r, version=0) if r.kind == "hex" else r for r in RULES if r.base))
    found = scan_paths(docs, ledger)
    base = [r.kind for r in RULES if r.base]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(listed(own), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@published
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), k=4, threshold=(85, 100), lower=True)


@published
def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        "lang",
        "source",
    )
    dims = {
        "source": Dim(F.col("source"), "name"),
        "lang": Dim(F.col("lang"), "name"),
        "size": Dim(F.col("size"), "log"),
        "doc_id": Dim(F.col("doc_id")),
    }
    placed = hilbert_shards(rows, dims, shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@published
def op9_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    coded = encode_texts(table(spark, folder, "documents"), read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json")))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@published
def op10_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language_spans.identify(docs)
    return found.select("doc_id", language_spans.held_out().alias("held_out"), "lang_pred", "score")


@published
def op11_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"), threshold=0.98)


@published
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lower]))
    leaf = digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    proved = manifest(docs.select("doc_id", "source", leaf.alias("leaf"), changed.alias("changed")), keep=("changed",))
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    out = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@published
def op13_fragment_monoid(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = read_tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align(table(spark, folder, "documents"), files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
