"""Secret scans: spans against Python's own matches, the ledger's increments, redaction."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from zonepulse.llm import queries
from zonepulse.llm.blob_ledger import RULES, Ledger, Rule, blob_of, listed, redacted, scan_paths, texts_of

KEY = "AKIA" + "A1B2" * 5
TEXTS = [
    None,
    "",
    "nothing here",
    'Password = "hunter22" and TOKEN:abcdefgh',
    "password: token = abcdefgh",  # the first match takes the name of the second
    "api_key=short apikey='longer/+._=-1'",
    f"x{KEY} AKIA123 {KEY}",
    "0123456789abcdef01234567 and deadbeef",
    "é日本😀 secret=äbc secret=abcdef1 " + "f" * 30,
    "mark \x01 and \x03 passwd=\x01abcdefg passwd=abcdefg\x01",
    "ghp_" + "a1" * 15 + " -----BEGIN RSA PRIVATE KEY-----",
    "secret=" + "0123456789abcdef" * 3,
    "password=abcdef " * 300,
]
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def expected(text):
    text = text or ""
    found = []
    for place, rule in enumerate(RULES):
        pattern = ASSIGN if rule.kind == "assign" else re.compile(rule.pattern)
        for m in pattern.finditer(text):
            if len(m[0]) >= rule.least and (not rule.least_group or len(m[2]) >= rule.least_group):
                found.append((m.start(), place, rule.kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def docs_of(spark, texts=TEXTS):
    rows = [(i, t, "extra") for i, t in enumerate([*texts, texts[3]])]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_spans(spark, tmp_path):
    got = scan_paths(docs_of(spark), str(tmp_path / "ledger"))
    assert {r.doc_id: r.s for r in got.select("doc_id", listed(F.col("spans")).alias("s")).collect()} == {
        i: expected(t) for i, t in enumerate([*TEXTS, TEXTS[3]])
    }


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rules = (Rule("hex", r"[0-9a-f]{24,}", least=24),)
    versions = docs_of(spark).select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    ledger.update(versions, rules)
    n = len({t or "" for t in TEXTS})
    assert ledger.scanned().count() == n
    first = ledger.found().count()
    ledger.update(versions, rules)
    assert ledger.scanned().count() == n and ledger.found().count() == first
    more = versions.unionByName(spark.createDataFrame([(hashlib.sha256(b"new").hexdigest(), "new")], "blob string, text string"))
    ledger.update(more, rules)
    assert ledger.scanned().count() == n + 1
    newer = (Rule("hex", r"[0-9a-f]{30,}", version=2),)
    ledger.update(more, newer)
    assert ledger.scanned().filter("version = 2").count() == n + 1
    assert ledger.findings(rules).count() == 4 and ledger.findings(newer).count() == 3


def test_texts_of_seen_blobs_stay_where_they_are(spark):
    rows = spark.range(2000).select(F.concat(F.lit("text "), "id").alias("text")).withColumn("blob", blob_of(F.col("text")))
    versions = rows.select("blob", "text")
    assert texts_of(versions, versions.select("blob").limit(0)).count() == 0
    new = versions.filter("text IN ('text 7', 'text 1900')")
    near = {r.text for r in texts_of(versions, new.select("blob")).collect()}
    assert {"text 7", "text 1900"} <= near and len(near) < 20
    assert texts_of(versions, versions.select("blob")).count() == 2000


def test_query_scans_in_two_runs(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "ledger")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: folder)
    docs_of(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.spans for r in queries.op6_blob_ledger(spark, str(tmp_path)).collect()}
    assert got == {i: expected(t) for i, t in enumerate([*TEXTS, TEXTS[3]])}
    n = len({t or "" for t in TEXTS})
    counts = {(r.rule, r.version): r["count"] for r in Ledger(spark, folder).scanned().groupBy("rule", "version").count().collect()}
    assert counts == {**{(r.kind, 1): n for r in RULES}, ("hex", 0): n}  # nothing is scanned twice
    files = Ledger(spark, folder).scanned().inputFiles()
    assert len(files) == 2  # one append a run


def test_empty(spark, nothing, tmp_path):
    got = scan_paths(nothing, str(tmp_path / "ledger"))
    assert got.count() == 0 and got.columns == [*nothing.columns, "spans"]


def test_redaction(spark, tmp_path):
    got = scan_paths(docs_of(spark), str(tmp_path / "ledger"))
    out = {r.doc_id: r.t for r in got.select("doc_id", redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert out[0] is None and out[2] == "nothing here"
    assert out[3] == "[REDACTED]\" and [REDACTED]"
    assert out[11] == "[REDACTED]"  # two kinds over one another
    assert out[8] == "é日本😀 secret=äbc [REDACTED] [REDACTED]"
    assert out[12] == "[REDACTED] " * 300


def test_no_python_in_the_plan(spark, tmp_path):
    got = scan_paths(docs_of(spark), str(tmp_path / "ledger"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
