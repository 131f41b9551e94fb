"""License scans: whole texts that are known licences, found by the digest of their canonical form.

Canonical form: lines that only state a copyright go, letters become lower case, everything but letters and digits becomes one blank,
and words with several spellings take one. Both a whole document and each of its lines count as an entire text; the digest of either
is joined with the digests of the known licences. A notice that fills a line of a larger document is thus found too, but never part of
a line. The lines of a text may be wrapped anywhere: only a line that states a copyright is left out, never one that begins with the word.

Known licences are a table (license_id, text) of any size; ``notices`` has common notices and whole licences. Only digests are shuffled and joined.

Defined cases: texts of any length are taken whole, each by one row of a task; null and empty texts, and texts without a letter or digit, have no digest and no licence; several ids for one digest are
all given; repeated rows are each given their licences; a known text of null is ignored; further columns pass through (those named
like a result are replaced); empty tables give empty tables, or no licences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm.known_licenses import known_texts

# Spellings that count as one, as whole words of the canonical form.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("v", "version"),
    ("ver", "version"),
    ("https", "http"),
)

# Public notices by which texts name their licence, and whole licences.
NOTICES = known_texts()

# A line that states a copyright: the word with a sign, a year, room for one or "by" behind it; the sign with a year; the reservation alone. A
# line that merely begins with the word is part of the licence, as where a text is wrapped before "copyright notice".
_YEAR = r"(?:19|20)\d\d|[\[<{](?:yyyy|year)"
COPYRIGHT = (
    r"^[^\p{L}\p{N}]*(?:©|\(c\)[^\p{L}\p{N}]*(?:" + _YEAR + r")|(?:copyright|copr)[^\p{L}\p{N}]*(?:\(c\)|©|" + _YEAR
    + r"|by(?:[^\p{L}\p{N}]|$))|all rights reserved[^\p{L}\p{N}]*$)"
)
RESULT = ("digest", "licenses", "license_lines")
BROADCAST_DIGESTS = 100_000  # known digests up to this number (some 100 bytes each) go to every task; more are joined by shuffle


def notices(spark: SparkSession) -> DataFrame:
    rows = [(name, text) for name, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "license_id string, text string")


def canonical_line(line: Column) -> Column:
    lower = F.lower(line)
    words = F.concat(F.lit(" "), F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for spelling, common in SPELLINGS:
        words = F.replace(words, F.lit(f" {spelling} "), F.lit(f" {common} "))
    return F.when(lower.rlike(COPYRIGHT), "").otherwise(F.trim(words))


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, those that come out empty left out."""
    return F.filter(F.transform(F.split(text, "\n", -1), canonical_line), lambda line: line != "")


def digest(lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, ids): the licences of each canonical text."""
    return (
        known.select("license_id", canonical_lines(F.col("text")).alias("lines"))
        .select("license_id", digest(F.col("lines")).alias("digest"))
        .where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.array_sort(F.collect_set("license_id")).alias("ids"))
    )


def scan_licenses(docs: DataFrame, known: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if not given) with digest (of the whole text), licenses (ids, sorted) and
    license_lines (different lines that are a known text). Texts are shuffled only if they are carried."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULT]
    digests = known_digests(known)
    if digests.count() <= BROADCAST_DIGESTS:
        digests = F.broadcast(digests)
    document = F.struct("doc_id", F.xxhash64("text").alias("text")).alias("document")
    parts = docs.select(document, canonical_lines(F.col("text")).alias("lines"))
    whole = F.struct(F.lit(0).alias("line"), digest(F.col("lines")).alias("digest"))
    each = F.transform("lines", lambda line: F.struct(F.lit(1).alias("line"), F.sha2(line, 256).alias("digest")))
    found = (
        parts.select("document", F.explode(F.concat(F.array(whole), each)).alias("part"))
        .select("document", "part.line", "part.digest")
        .join(digests, "digest")
        .groupBy("document", "digest")
        .agg(F.first("ids").alias("ids"), F.max("line").alias("line"))
        .groupBy("document")
        .agg(F.collect_set("ids").alias("ids"), F.sum("line").alias("license_lines"))
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), document, digest(canonical_lines(F.col("text"))).alias("digest")
    )
    matches = (rows["document.doc_id"].eqNullSafe(found["document.doc_id"])) & (
        rows["document.text"] == found["document.text"]
    )
    licenses = F.array_sort(F.array_distinct(F.flatten("ids")))
    return rows.join(found, matches, "left").select(
        *(F.col(f"row.`{c}`") for c in carry),
        "digest",
        F.coalesce(licenses, F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("license_lines", F.lit(0)).cast("long").alias("license_lines"),
    )
