"""Secret scans with an incremental blob ledger.

The ledger is two tables: `scans`, the pairs of blob and rule version that were
scanned, and `findings`. A blob is a text, addressed by its SHA-256; a path (a
document) points to a blob. An update reduces the input to its distinct blobs,
scans those pairs that `scans` does not hold, appends findings first and then
scans, and findings join back to every path. If an update dies between the two
appends its pairs are scanned again; equal findings count once.

Matches are found per blob by functions of DataFrames: a text is split at the
matches, and the running sum of the lengths of pieces and matches gives the
places, in code points, as rows rather than in one expression.

Defined results: a null text is the empty blob and has no findings. Repeated
rows and texts share a blob; every row gets its findings. A new rule, or a
rule with a new version, is scanned over all blobs, and findings of versions
that are not in use are not reported. An empty table changes nothing. Columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of

SCANS = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, start long, end long"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose `group` has `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their order, then those that the ledger adds. A run of
# one character class is at its full length when matched, so its least length is in the pattern.
BASE = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def blob_id(text: str = "text"):
    return F.unhex(F.sha2(text_of(text).cast("binary"), 256))


def create(spark: SparkSession, path: str) -> None:
    """An empty ledger, unless there is one."""
    for name, schema in (("scans", SCANS), ("findings", FINDINGS)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{name}")


def unseen(docs: DataFrame, scans: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, missing): distinct blobs with the rules that they were not scanned by."""
    names = F.array(*(F.lit(r.name) for r in rules))
    blobs = docs.select(blob_id().alias("blob"), text_of().alias("text")).dropDuplicates(["blob"])
    done = scans.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "kind", "version")).alias("done"))
    return (blobs.join(done, "blob", "left")
            .withColumn("missing", F.when(F.col("done").isNull(), names)
                        .otherwise(F.array_except(names, F.col("done"))))
            .filter(F.size("missing") > 0).select("blob", "text", "missing"))


def findings_of(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The findings of each blob by its missing rules."""
    def lengths(rule: Rule):
        pattern = F.lit(rule.pattern)
        part = F.transform(F.split("text", rule.pattern, -1), F.length)
        whole = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length)
        group = F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length)
        matched = F.array_contains("missing", rule.name) & F.col("text").rlike(rule.pattern)
        return F.when(matched, F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
                                        F.lit(rule.least).alias("least"),
                                        F.arrays_zip(part.alias("part"), whole.alias("whole"),
                                                     group.alias("group")).alias("matches")))

    found = blobs.select("blob", F.explode(F.array(*(lengths(r) for r in rules))).alias("rule")) \
        .filter("rule IS NOT NULL")
    matches = found.select("blob", "rule.kind", "rule.version", "rule.least",
                           F.posexplode("rule.matches").alias("place", "m")).filter("m.whole IS NOT NULL")
    so_far = Window.partitionBy("blob", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("m.part") + F.col("m.whole")).cast("long")).over(so_far)
    return (matches.withColumn("end", end).filter(F.col("m.group") >= F.col("least"))
            .select("blob", "kind", "version", (F.col("end") - F.col("m.whole")).alias("start"), "end"))


def update(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at `path` has not seen and append it."""
    spark = docs.sparkSession
    scans = spark.read.schema(SCANS).parquet(f"{path}/scans")
    findings_of(unseen(docs, scans, rules), rules).write.mode("append").parquet(f"{path}/findings")
    pairs = docs.select(blob_id().alias("blob")).distinct().withColumn("rule", F.explode(F.array(*(
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules)))) \
        .select("blob", "rule.kind", "rule.version")
    pairs.join(scans, ["blob", "kind", "version"], "left_anti") \
        .write.mode("append").parquet(f"{path}/scans")


def by_path(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) per row: the ledger's findings, ordered by start and rule.

    spans: array<struct<start, rank, end, kind>>, `rank` the rule's place in `rules`.
    """
    ranks = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))))
    findings = docs.sparkSession.read.schema(FINDINGS).parquet(f"{path}/findings").distinct() \
        .withColumn("rank", F.try_element_at(ranks, F.concat_ws("@", "kind", "version"))) \
        .filter("rank IS NOT NULL")
    per_blob = findings.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
    return docs.select("doc_id", blob_id().alias("blob")).join(per_blob, "blob", "left").select(
        "doc_id", F.coalesce("spans", F.expr(
            "CAST(array() AS array<struct<start: bigint, rank: int, end: bigint, kind: string>>)")).alias("spans"))
