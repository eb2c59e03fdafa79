"""Secret scans over an incremental ledger of blobs, in DataFrame expressions only.

Every version of every path is addressed by the hash of its content. The ledger is two
Parquet tables: ``scanned`` holds the (blob, rule, version) that were scanned, ``found``
the spans. A run scans only pairs of a blob and a rule version that are not in ``scanned``,
appends to both tables, and joins the spans back to all paths that hold the blob.

Spans are in code points, end exclusive. To place matches inside expressions, each one is
put between marks by one replacement, the text is split at the marks, and the lengths of
the pieces are added up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .filters import sketch, split_by


@dataclass(frozen=True)
class Rule:
    """A pattern, the least length of its match and of its second group (0: has none)."""

    kind: str
    pattern: str
    least: int = 1
    least_group: int = 0
    version: int = 1
    base: bool = False


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api")) + "_?" + _any_case("key")
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least_group=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", least=24, base=True),
    Rule("token", r"(?:gh[pousr]|xox[abprs]|sk|pk|rk)[_-][A-Za-z0-9_-]{20,}", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BLOBS_PER_FILE = 1_000_000
_MARK, _GROUP, _PLAIN = "\x01", "\x03", "\x02"


def _pieces(text: Column, rule: Rule) -> Column:
    """(characters, passes) of each piece of a text; every second piece is a match.

    Marks in the text itself become another character that no rule's pattern matches.
    """
    clean = F.replace(F.replace(text, F.lit(_MARK), F.lit(_PLAIN)), F.lit(_GROUP), F.lit(_PLAIN))
    group = "$2" if rule.least_group else ""
    marked = F.regexp_replace(clean, rule.pattern, f"{_MARK}$0{_GROUP}{group}{_MARK}")

    def piece(x: Column) -> Column:
        whole = F.substring_index(x, _GROUP, 1)
        match = F.contains(x, F.lit(_GROUP))
        long = F.char_length(whole) >= rule.least
        if rule.least_group:
            long = long & (F.char_length(F.substring_index(x, _GROUP, -1)) >= rule.least_group)
        return F.struct(F.char_length(whole).alias("n"), (match & long).alias("passes"))

    return F.transform(F.split(marked, _MARK), piece)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, start, end) of the rules named in each row's ``todo``."""
    each = [
        F.when(F.array_contains("todo", rule.kind), F.struct(F.lit(rule.kind).alias("rule"), _pieces(F.col("text"), rule).alias("pieces")))
        for rule in rules
    ]
    # A piece list of one is a text without match.
    lists = F.filter(F.array(*each), lambda x: F.size(x["pieces"]) > 1)
    rows = blobs.select("blob", F.inline(lists)).select("blob", "rule", F.posexplode("pieces").alias("at", "piece"))
    until = F.sum("piece.n").over(Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.select("blob", "rule", "piece.passes", until.alias("end"), (until - F.col("piece.n")).alias("start"))
    return placed.filter("passes").select("blob", "rule", "start", "end")


def texts_of(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of ``versions`` (blob, text) the rows whose blob may be in ``wanted`` (blob).

    Looked up in a sketch before any text is moved. The sketch is of fixed size: a crowded
    one lets seen blobs through, it loses none.
    """
    near, _ = split_by(versions, "blob", materialise(sketch(wanted, "blob"), files=1))
    return near


class Ledger:
    """A ledger in a folder; it begins to exist with the first run."""

    _SCANNED = "blob string, rule string, version int"
    _FOUND = "blob string, rule string, version int, start long, end long"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def scanned(self) -> DataFrame | None:
        return self._table("scanned", self._SCANNED)

    def found(self) -> DataFrame | None:
        return self._table("found", self._FOUND)

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``versions`` (blob, text) and append it.

        ``found`` is written before ``scanned``, so a run that fails between the two is
        scanned again; the spans of a pair are then read once all the same, as ``findings``
        drops repeats. Hashes go first: only texts of blobs with an unseen pair are shuffled.
        """
        done = self.scanned()
        wanted = F.array(*(F.lit(r.kind) for r in rules))
        if done is None:
            todo = versions.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", wanted)
            pairs = versions.select("blob").distinct().withColumn("rule", F.explode(wanted))
        else:
            current = self.spark.createDataFrame([(r.kind, r.version) for r in rules], "rule string, version int")
            seen = done.join(F.broadcast(current), ["rule", "version"])
            pairs = versions.select("blob").distinct().withColumn("rule", F.explode(wanted)).join(seen, ["blob", "rule"], "left_anti")
            pairs = materialise(pairs)
            unseen = pairs.groupBy("blob").agg(F.collect_set("rule").alias("todo"))
            texts = texts_of(versions, pairs).groupBy("blob").agg(F.first("text").alias("text"))
            todo = texts.join(unseen, "blob")
        # Both tables are small next to the texts: as many files as millions of versions.
        files = 1 + versions.count() // BLOBS_PER_FILE
        version = F.element_at(F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.version)))), F.col("rule"))
        found = scan(todo, rules).select("blob", "rule", version.alias("version"), "start", "end")
        found.repartition(files).write.mode("append").parquet(f"{self.folder}/found")
        pairs.select("blob", "rule", version.alias("version")).coalesce(files).write.mode("append").parquet(f"{self.folder}/scanned")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans) of the given rule versions, spans (start, place, kind, end) in order."""
        current = self.spark.createDataFrame([(r.kind, r.version, i) for i, r in enumerate(rules)], "rule string, version int, place int")
        rows = self.found().join(F.broadcast(current), ["rule", "version"])
        one = F.struct("start", "place", F.col("rule").alias("kind"), "end")
        return rows.groupBy("blob").agg(F.array_sort(F.collect_set(one)).alias("spans"))


def scan_paths(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``spans``: array of (start, place, kind, end), by start,
    then by the rule's place in ``rules``; empty where nothing was found.

    ``docs`` has one row per path and historical version. NULL texts are empty ones. Rows
    repeated under one id each get their text's spans. A column named ``spans`` in the input
    is replaced. An empty table gives no rows and an empty ledger.
    """
    ledger = Ledger(docs.sparkSession, folder)
    kept = [c for c in docs.columns if c != "spans"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    ledger.update(docs.select(blob_of(F.col(text_col)).alias("blob"), text.alias("text")), rules)
    found = ledger.findings(rules).withColumnRenamed("blob", "_blob")
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    joined = docs.select(*kept).withColumn("_own", blob_of(F.col(text_col))).join(found, F.col("_own") == F.col("_blob"), "left")
    return joined.select(*kept, F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by the mask."""
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, finish)).otherwise(text)
