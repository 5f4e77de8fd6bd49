"""Secret scans through a ledger of blobs.

Every version of a file or document is addressed by the SHA-256 of its content. A ledger in shared storage
remembers which rule versions have been applied to which blob, and what they found. A scan
looks only at blob and rule-version pairs the ledger does not hold: copies of a blob are
scanned once, unchanged versions never again, and a changed rule brings back every blob for that rule
alone. Findings are then joined back to every path and version that has the blob.

Positions of matches come from two built-in functions that use the same leftmost non-overlapping
search: ``split`` gives the text between the matches and ``regexp_extract_all`` the matches.
Running sums of their lengths over the matches, a row each, give the offsets, in code points and in bytes. Only texts that have a
match pay for it, and the work grows with the number of matches.

Nulls and odd cases: a null content counts as the empty blob; repeated rows, null paths and ties
each get the findings of their blob; an empty table scans nothing; very long texts are scanned whole; columns of any names are handed on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm import common


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, the group whose length counts, and that length in characters."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    version: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns and lengths of the contract, in its order. A run of capitals or of
# hex digits that is too short can be left out by the pattern itself, as the run
# ends where it ends; an assignment is taken whole and then dropped.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_length=12,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", min_length=18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", min_length=16, base=True),
    # The whole key: to the line that ends it or, where there is none, as far as its lines go on.
    Rule(
        "pem",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?s:.*?)-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{16,})*)",
        version=2,
    ),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

SPAN = "struct<start:bigint,stop:bigint,first:bigint,last:bigint>"
FINDINGS = f"blob_id string, rule string, spans array<{SPAN}>"
SCANNED = "blob_id string, rules array<string>"


def blob_id(content: Column) -> Column:
    return F.sha2(F.coalesce(content, F.lit("")).cast("binary"), 256)


PIECES = "array<struct<skipped:bigint,length:bigint,skipped_bytes:bigint,bytes:bigint,measured:int>>"


def match_pieces(content: Column, rule: Rule) -> Column:
    """The matches of a rule in order: each with its length, its measured length and what lies between it and the one before."""
    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.split(content, rule.pattern, -1).alias("between"),
        F.regexp_extract_all(content, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(content, pattern, F.lit(rule.group)).alias("measured"),
    )

    def pieces(p: Column) -> Column:
        gaps = F.slice(p["between"], 1, F.size(p["whole"]))
        rows = F.arrays_zip(gaps.alias("gap"), p["whole"].alias("whole"), p["measured"].alias("measured"))
        return F.transform(
            rows,
            lambda r: F.struct(
                F.length(r["gap"]).cast("long").alias("skipped"),
                F.length(r["whole"]).cast("long").alias("length"),
                F.octet_length(r["gap"]).cast("long").alias("skipped_bytes"),
                F.octet_length(r["whole"]).cast("long").alias("bytes"),
                F.length(r["measured"]).alias("measured"),
            ),
        )

    # The one-element array gives the three searches a name, so that each runs once.
    found = F.transform(F.array(parts), pieces)[0]
    return F.when(content.rlike(rule.pattern), found).otherwise(F.array().cast(PIECES))


def located(pieces: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob_id, rule, spans) from (blob_id, rule, pieces): running sums of the lengths place the matches in the text.

    Each match is a row of its own while its place is found, so the work grows with the matches.
    """
    rows = pieces.select("blob_id", "rule", F.posexplode("pieces").alias("number", "piece")).select("blob_id", "rule", "number", "piece.*")
    upto = Window.partitionBy("blob_id", "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("skipped") + F.col("length")).over(upto)
    last = F.sum(F.col("skipped_bytes") + F.col("bytes")).over(upto)
    placed = rows.withColumns({"stop": stop, "last": last})
    least = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.min_length))])[F.col("rule")]
    span = F.struct((F.col("stop") - F.col("length")).alias("start"), "stop", (F.col("last") - F.col("bytes")).alias("first"), "last")
    kept = placed.filter(F.col("measured") >= least)
    return kept.groupBy("blob_id", "rule").agg(F.sort_array(F.collect_list(span)).alias("spans"))


class Ledger:
    """Scanned pairs and findings in a folder that all executors share; each scan adds a batch."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        for name, schema in (("scanned", SCANNED), ("findings", FINDINGS)):
            # An empty batch makes the table readable before the first scan.
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.folder}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(f"{self.folder}/findings")

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in (path, content) rows; findings go in before the pairs count as scanned.

        A scan that breaks off between the two is repeated by the next one; repeated findings
        are merged when they are read.
        """
        rows = versions.select(F.coalesce("content", F.lit("")).alias("content"), "path")
        rows = rows.select("content", blob_id(F.col("content")).alias("blob_id"), _row_key().alias("row_key"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        # One row stands for its blob; the table of these is narrow, and copies are combined before the shuffle.
        blobs = rows.groupBy("blob_id").agg(F.min("row_key").alias("row_key"))
        done = self.scanned().groupBy("blob_id").agg(F.flatten(F.collect_set("rules")).alias("rules"))
        blobs = blobs.join(done, "blob_id", "left")
        todo = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
        # Written first, so that both tables of the ledger speak of the same blobs.
        batch = f"{self.folder}/batch-{uuid.uuid4().hex}"
        blobs.select("blob_id", "row_key", todo.alias("rules")).filter(F.size("rules") > 0).write.parquet(batch)
        blobs = self.spark.read.schema("blob_id string, row_key string, rules array<string>").parquet(batch)
        # The side of keys is hashed, so that the side of texts is not sorted.
        texts = rows.join(blobs.hint("shuffle_hash"), ["blob_id", "row_key"]).select("blob_id", "rules", "content")
        found = F.array(
            *[
                F.struct(
                    F.lit(r.key).alias("rule"),
                    F.when(F.array_contains("rules", r.key), match_pieces(F.col("content"), r)).alias("pieces"),
                )
                for r in rules
            ]
        )
        # The outer form keeps the planner from computing the pieces twice, to filter first.
        hits = texts.select("blob_id", F.explode_outer(F.filter(found, lambda x: F.size(x["pieces"]) > 0)).alias("f"))
        hits = located(hits.filter("f is not null").select("blob_id", "f.*"), rules)
        hits.write.mode("append").parquet(f"{self.folder}/findings")
        blobs.select("blob_id", "rules").write.mode("append").parquet(f"{self.folder}/scanned")

    def _spans(self, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob_id, start, rank, kind, stop, first, last): every span of the rules once, a row each."""
        order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
        rows = self.findings().filter(F.col("rule").isin([r.key for r in rules]))
        kind = F.split_part("rule", F.lit("@"), F.lit(1)).alias("kind")
        rows = rows.select("blob_id", order[F.col("rule")].alias("rank"), kind, F.explode("spans").alias("span"))
        return rows.select("blob_id", "span.start", "rank", "kind", "span.stop", "span.first", "span.last").distinct()

    def by_blob(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob_id, spans): all spans of the rules, by start and then in the order of the rules."""
        span = F.struct("start", "rank", "kind", "stop")
        return self._spans(rules).groupBy("blob_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))

    def cuts(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob_id, cuts, rest): the stretches of a blob, in bytes, that lie before and between its spans, and where the last one ends."""
        before = Window.partitionBy("blob_id").orderBy("first", "rank", "last").rowsBetween(Window.unboundedPreceding, -1)
        rows = self._spans(rules).withColumn("begin", F.coalesce(F.max("last").over(before), F.lit(0)))
        # A span that starts within those before it leaves no mark of its own.
        cut = F.when(F.col("first") >= F.col("begin"), F.struct("begin", "first"))
        return rows.groupBy("blob_id").agg(F.sort_array(F.collect_list(cut)).alias("cuts"), F.max("last").alias("rest"))

    def report(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Every row of ``versions`` with the spans found in its blob; an empty array without any."""
        rows = versions.withColumn("blob_id", blob_id(F.col("content"))).drop("content")
        rows = rows.join(self.by_blob(rules), "blob_id", "left")
        empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint>>")
        return rows.withColumn("spans", F.coalesce("spans", empty))

    def redacted(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Documents (text, n_chars and other columns) with every span found in their blob replaced by a mark."""
        blob, found = [common.free_name(docs, name) for name in ("blob", "found")]
        keyed = docs.withColumn(blob, blob_id(F.col("text")))
        cuts = self.cuts(rules).select(F.col("blob_id").alias(blob), F.struct("cuts", "rest").alias(found))
        # Blobs with a finding are few beside all texts: hashed, so that the side of texts is not sorted.
        rows = keyed.join(cuts.hint("shuffle_hash"), blob, "left")
        clean = F.col(found).isNull()
        text = F.when(clean, F.col("text")).otherwise(redact(F.col("text"), F.col(found)["cuts"], F.col(found)["rest"]))
        rows = rows.withColumn("text", text)
        if "n_chars" in docs.columns:
            kind = docs.schema["n_chars"].dataType
            rows = rows.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
        return rows.select(docs.columns)


def _row_key() -> Column:
    """Chooses between rows of the same content; equal rows are the same row."""
    return F.coalesce(F.col("path").cast("string"), F.lit(""))


def redact(content: Column, cuts: Column, rest: Column, mark: str = "[secret]") -> Column:
    """The stretches of a text that stay, with a mark after each; overlapping spans leave one mark."""
    data = content.cast("binary")

    def stretch(start: Column, length: Column) -> Column:
        return F.substring(data, (start + 1).cast("int"), length.cast("int")).cast("string")

    kept = F.transform(cuts, lambda c: stretch(c["begin"], c["first"] - c["begin"]))
    return F.array_join(F.array_append(kept, stretch(rest, F.octet_length(content) - rest)), mark)
