"""Secret scans over an incremental ledger of blobs.

Every version of every path is content-addressed (SHA-256 of its text). The ledger keeps one row for
each pair of blob and rule version that was ever scanned, findings or not, so a later run scans only
pairs that it lacks. It also keeps the blobs of every path of every run, so findings are joined back to
all paths that hold, or held, the blob. A ledger lives in its folder and can be opened again, also by
several writers at once: runs have names of their own, only committed ones are read, and a pair that two
writers scanned counts once. Texts are not kept, so a changed rule set judges a blob when it is next
given. Everything is a DataFrame expression. Within one blob the spans of a rule are found from the alternation of gaps
(``split``) and matches (``regexp_extract_all``): the running sum of their lengths gives positions.

Defined results: a null text counts as empty; an empty text has no findings; equal rows, also with
equal or null paths, each get the findings of their blob; an empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sensorloom.llm.common import fresh_folder, let, quoted, row_of, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches, leftmost and without overlap; those whose ``group`` has fewer than
    ``at_least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1
    base: bool = False


# Patterns of the secrets looked for.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=8,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=16, base=True),
    Rule("hex", r"[0-9a-f]{32,}", at_least=32, base=True),
    Rule("forge", r"(?:gh[pousr]|glpat|xox[abprs])[_-][A-Za-z0-9_-]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9+/_.=-]{20,}"),
)
# Every text with a match of a rule has one of these in its lower-case form, or the run.
GATE_WORDS = (
    "passw", "secret", "token", "apikey", "api_key", "bearer", "akia", "eyj", "-----begin ",
    "glpat", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "ghp-", "gho-", "ghu-", "ghs-", "ghr-",
    "xoxa", "xoxb", "xoxp", "xoxr", "xoxs",
)
GATE_RUN = r"[0-9a-f]{32}"
PLACEHOLDER = "[SECRET]"


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Changes with any pattern or limit, so that a changed rule set scans every blob anew."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def suspect(text: Column) -> Column:
    """True wherever a rule matches; nearly all texts stop at these plain searches."""

    def any_word(low: Column) -> Column:
        found = F.contains(low, F.lit(GATE_WORDS[0]))
        for word in GATE_WORDS[1:]:
            found = found | F.contains(low, F.lit(word))
        return found

    return let(F.lower(text), any_word) | text.rlike(GATE_RUN)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(blobs: DataFrame, rank: int, rule: Rule) -> DataFrame:
    """Kept spans of one rule: blob_id, rank, kind, base, start, end (code points, end exclusive)."""
    pattern = F.lit(rule.pattern)
    found = blobs.where(F.col("text").rlike(rule.pattern)).select(
        "blob_id",
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
                F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("part"),
                F.slice(
                    F.transform(F.split("text", rule.pattern, -1), F.length),
                    F.lit(1),
                    F.regexp_count("text", pattern),
                ).alias("gap"),
            )
        ).alias("i", "m"),
    )
    order = Window.partitionBy("blob_id").orderBy("i")
    end = F.sum(F.col("m.gap") + F.length("m.match")).over(order)
    return (
        found.withColumn("end", end.cast("long"))
        .where(F.length("m.part") >= rule.at_least)
        .select(
            "blob_id",
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.base).alias("base"),
            (F.col("end") - F.length("m.match")).alias("start"),
            "end",
        )
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of distinct blobs (blob_id, text): blob_id and ``spans``, sorted by start, then rule.

    Each span also has ``before``, the largest end of the spans before it. Blobs without findings
    have no row.
    """
    found = None
    for rank, rule in enumerate(rules):
        part = _matches(blobs, rank, rule)
        found = part if found is None else found.unionByName(part)
    earlier = (
        Window.partitionBy("blob_id")
        .orderBy("start", "rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = found.withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    span = F.struct("start", "rank", "kind", "base", "end", "before")
    return found.groupBy("blob_id").agg(F.array_sort(F.collect_list(span)).alias("spans"))


class BlobLedger:
    """The tables of a ledger in ``path`` (by default a new folder, deleted when the driver ends).

    ``run-*`` hold scanned (blob_id, rule_version) pairs with their findings, ``paths-*`` the
    (doc_id, blob_id) rows of each update.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or fresh_folder(spark, "secret-ledger")
        self.refresh()

    def refresh(self) -> None:
        """Find the committed runs below ``path``, those of other writers included."""
        self.runs = self._committed("run-")
        self.path_runs = self._committed("paths-")

    def _committed(self, prefix: str) -> list[str]:
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = sorted(entry.getPath().getName() for entry in files.listStatus(folder))
        done = context._jvm.org.apache.hadoop.fs.Path
        found = [f"{self.path}/{name}" for name in names if name.startswith(prefix)]
        return [path for path in found if files.exists(done(f"{path}/_SUCCESS"))]

    def _new(self, prefix: str, before: list[str]) -> str:
        return f"{self.path}/{prefix}{len(before):06d}-{uuid.uuid4().hex}"

    def rows(self, version: str) -> DataFrame | None:
        """The blobs scanned under a rule version, each once, with their spans (null: none)."""
        if not self.runs:
            return None
        stored = self.spark.read.parquet(*self.runs).where(F.col("rule_version") == version)
        if len(self.runs) > 1:
            stored = stored.groupBy("blob_id").agg(F.first("spans", ignorenulls=True).alias("spans"))
        return stored.select("blob_id", "spans")

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what the ledger lacks of ``docs``; returns (doc_id, blob_id) of all rows, written."""
        version = rule_version(rules)
        texts = docs.select(
            "doc_id", blob_id(F.col("text")).alias("blob_id"), F.coalesce("text", F.lit("")).alias("text")
        )
        kept = self._new("paths-", self.path_runs)
        given = texts.select("doc_id", "blob_id")
        given.write.parquet(kept)
        self.path_runs.append(kept)
        paths = self.spark.read.schema(given.schema).parquet(kept)
        seen = self.rows(version)
        new_ids, new_texts = paths.select("blob_id").distinct(), texts
        if seen is not None:
            new_ids = new_ids.join(seen.select("blob_id"), "blob_id", "left_anti")
            new_texts = new_texts.join(seen.select("blob_id"), "blob_id", "left_anti")
        suspects = new_texts.where(suspect(F.col("text"))).groupBy("blob_id").agg(F.min("text").alias("text"))
        findings = scan_blobs(written(suspects, "secret-suspects"), rules)
        run = self._new("run-", self.runs)
        new_ids.join(findings, "blob_id", "left").withColumn("rule_version", F.lit(version)).write.parquet(run)
        self.runs.append(run)
        return paths

    def findings(self, paths: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """One row per row of ``paths``, with the spans of its blob (null: none)."""
        return paths.join(self.rows(rule_version(rules)), "blob_id", "left")

    def history(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """One row per path and blob that it holds or ever held, with the blob's spans (null: none).

        Blobs that were never scanned under these rules have no row. The ledger must not be empty.
        """
        ever = self.spark.read.parquet(*self.path_runs).distinct()
        return ever.join(self.rows(rule_version(rules)), "blob_id")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def digest(findings: DataFrame) -> DataFrame:
    """The counts and digests of each row's spans."""
    nothing = F.array().cast("array<struct<start:bigint,rank:int,kind:string,base:boolean,end:bigint,before:bigint>>")
    spans = F.coalesce(F.col("spans"), nothing)

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.filter(spans, lambda s: s["base"]))
    return findings.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        "blob_id",
    )


def redacted(text: Column, spans: Column, placeholder: str = PLACEHOLDER) -> Column:
    """``text`` with every span replaced; overlapping or touching spans leave one placeholder."""
    pieces = F.transform(
        spans,
        lambda s: F.when(
            s["start"] > s["before"],
            F.concat(
                F.substring(text, s["before"].cast("int") + 1, (s["start"] - s["before"]).cast("int")),
                F.lit(placeholder),
            ),
        )
        .when((s["before"] == 0) & (s["start"] == 0), F.lit(placeholder))
        .otherwise(F.lit("")),
    )
    last = F.array_max(F.transform(spans, lambda s: s["end"])).cast("int")
    tail = F.substring(text, last + 1, F.length(text))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(text)


def redact(docs: DataFrame, ledger: BlobLedger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets of each text replaced and ``n_chars`` brought up to date.

    Suspect texts (those with a finding) are looked up by blob; all others pass as they are. A null
    text stays null.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.update(docs, rules)
    known = ledger.rows(rule_version(rules)).where(F.col("spans").isNotNull())
    packed = docs.select(row_of(docs), blob_id(F.col("text")).alias("blob_id"))
    joined_rows = packed.join(known.select("blob_id", "spans"), "blob_id", "left")
    text = redacted(F.col("row.text"), F.col("spans"))
    changed = F.col("spans").isNotNull()
    made = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))}
    return joined_rows.select(
        *[made[c].alias(c) if c in made else F.col(f"row.{quoted(c)}") for c in docs.columns]
    )
