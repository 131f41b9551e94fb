"""Secret scans: a ledger of contents, each scanned once per version of the rules.

Every text, whichever path or point in time it comes from, is a blob named by the SHA-256 of its content. The ledger is a table of
(blob_id, rules, findings). A run scans only blobs that the ledger lacks for the current rules, adds them, and joins the findings back
to every path that holds the blob. Contents are compared and scanned with DataFrame functions only.

A finding is (start, kind, end) in code points, end exclusive. Each pattern is found leftmost and without overlap, the way a plain
left-to-right search does it: the text is cut into chunks "what comes before, then a match", and the running sum of their lengths
gives the places. Matches that are too short are dropped after the search, so they still use up their characters.

Defined cases: a null text is the empty blob and has no findings; repeated rows each get the findings of their blob; null ids and
further columns pass through (a column named blob_id or findings is replaced); an empty table gives an empty table. Two runs that
scan the same blob at the same time may both add it; the ledger is read distinct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FINDING = "struct<start: bigint, kind: int, end: bigint>"


@dataclass(frozen=True)
class Rule:
    """``measured`` is the group of ``pattern`` (0: the whole match) that has ``least`` characters or more.

    ``hint`` is a cheaper pattern that every text with a finding contains.
    """

    kind: str
    pattern: str
    measured: int
    least: int
    hint: str
    flags: str = ""


# The kinds in their order, patterns and least lengths of the scan.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
        "i",
    ),
    # A run of these characters is matched whole, so asking for its length at once finds the same places.
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)


def version_of(rules: tuple[Rule, ...]) -> str:
    """Follows from the rules, so a changed rule never takes the findings of the old one from the ledger."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()


RULES_VERSION = version_of(RULES)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


BLOCK = 256  # matches whose places are added up in one go; any value gives the same result


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often and inside whatever loop it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def rule_findings(text: Column, rule: Rule, number: int) -> Column:
    """All findings of one rule in a text, in order. The hint spares texts without a finding the cutting into chunks."""
    # \\G: a chunk begins where the one before ended; else what follows the last match would be tried from every character
    chunk = f"(?s{rule.flags})\\G(.*?)({rule.pattern})"

    def lengths(group: int) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(chunk), F.lit(group)), F.length)

    parts = F.arrays_zip(
        lengths(1).alias("before"), lengths(2).alias("whole"), lengths(2 + rule.measured).alias("measured")
    )
    empty = F.array().cast(f"array<{FINDING}>")

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + part["before"]
        end = start + part["whole"]
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        found = F.when(part["measured"] >= rule.least, F.concat(done["found"], one)).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def placed(parts: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))

        def block(b: Column) -> Column:
            return F.slice(parts, b * BLOCK + 1, BLOCK)

        def length(b: Column) -> Column:
            return F.aggregate(block(b), F.lit(0).cast("long"), lambda n, part: n + part["before"] + part["whole"])

        starts = F.aggregate(
            blocks,
            F.array(F.lit(0).cast("long")),
            lambda at, b: F.concat(at, F.array(F.element_at(at, -1) + length(b))),
        )
        return let(
            starts,
            lambda at: F.flatten(
                F.transform(
                    blocks,
                    lambda b: F.aggregate(
                        block(b),
                        F.struct(F.get(at, b).alias("at"), empty.alias("found")),
                        step,
                        lambda done: done["found"],
                    ),
                )
            ),
        )

    hint = f"(?{rule.flags}){rule.hint}" if rule.flags else rule.hint
    return F.when(text.rlike(hint), let(parts, placed)).otherwise(empty)


def findings(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The findings of all rules in a text, by start, then in the order of the rules."""
    return F.array_sort(F.concat(*(rule_findings(text, rule, i) for i, rule in enumerate(rules))))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob_id, rules, findings) of every scan so far; empty before the first."""
    schema = f"blob_id string, rules string, findings array<{FINDING}>"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan_unseen(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, version: str | None = None) -> None:
    """Add to the ledger the findings of every blob of ``docs`` that it lacks for this version of the rules.

    Equal texts are combined inside each task before they are shuffled, so a text that many paths share is scanned once.
    """
    version = version or version_of(rules)
    blobs = (
        docs.select(blob_id(F.col("text")).alias("blob_id"), F.coalesce("text", F.lit("")).alias("text"))
        .groupBy("blob_id")
        .agg(F.first("text").alias("text"))
    )
    seen = read_ledger(docs.sparkSession, ledger).where(F.col("rules") == version).select("blob_id")
    scanned = blobs.join(seen, "blob_id", "left_anti").select(
        "blob_id", F.lit(version).alias("rules"), findings(F.col("text"), rules).alias("findings")
    )
    scanned.write.mode("append").parquet(ledger)


def scan_secrets(
    docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, version: str | None = None
) -> DataFrame:
    """``docs`` with blob_id and findings; ``ledger`` is a folder that later runs go on using."""
    version = version or version_of(rules)
    scan_unseen(docs, ledger, rules, version)
    known = (
        read_ledger(docs.sparkSession, ledger)
        .where((F.col("rules") == version) & (F.size("findings") > 0))
        .select("blob_id", "findings")
        .distinct()
    )
    rows = docs.select(F.struct("*").alias("row"), blob_id(F.col("text")).alias("blob_id"))
    return rows.join(known, "blob_id", "left").select(
        *(F.col(f"row.`{c}`") for c in docs.columns if c not in ("blob_id", "findings")),
        "blob_id",
        F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings"),
    )
