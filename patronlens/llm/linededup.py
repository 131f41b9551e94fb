"""Line dedup: windows of three consecutive lines that occur more than once go, but for their first occurrence.

Every document is cut into overlapping windows of ``WINDOW`` lines. A window is known by a 128-bit hash of its lines, white space at
their ends left out. All occurrences of a window in the corpus are ordered by document and line; the lines of every occurrence but the
first are covered, and covered lines are removed.

Defined cases: a null text stays null and has no lines; a text of fewer than three lines has no window and stays; windows of blank
lines only are not compared; a text that loses every line becomes empty. A text of any length is taken
whole, its lines and hashes in one row of a task. Rows that repeat both doc_id and text are one document and
get the same decision; rows that share a doc_id but not the text are told apart by a hash of the text. A null doc_id comes first.
Further columns pass through under any name, but n_lines and n_removed are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
RESULT = ("n_lines", "n_removed")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame) -> DataFrame:
    """(document, position, h1, h2) for every window; the two hashes chain the lines in opposite orders.

    ``document`` is a struct of doc_id and a hash of the text: its fields order documents, null first.
    """
    document = F.struct("doc_id", F.xxhash64("text").alias("text")).alias("document")
    shifted = F.arrays_zip(*(F.slice("lines", i + 1, F.size("lines")).alias(f"l{i}") for i in range(WINDOW)))
    lines = [F.trim(F.col(f"window.l{i}"), F.lit(" \t\r")) for i in range(WINDOW)]
    return (
        docs.select(document, lines_of(F.col("text")).alias("lines"))
        .where(F.size("lines") >= WINDOW)
        .select("document", F.posexplode(shifted).alias("position", "window"))
        .where(F.col(f"window.l{WINDOW - 1}").isNotNull() & (F.concat(*lines) != ""))
        .select("document", "position", F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit("back"), *lines[::-1]).alias("h2"))
    )


def covered_lines(windows: DataFrame) -> DataFrame:
    """(document, covered): the sorted line numbers of each document inside a later occurrence of some window.

    First occurrences are combined inside each task before the shuffle; the way back joins on the hash, so that adaptive execution
    can split a window that a large part of the corpus holds. Only a document's own line numbers are gathered.
    """
    place = F.struct("document", "position")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("h1", "h2", "first")
    )
    later = windows.join(repeated, ["h1", "h2"]).where(place != F.col("first")).select("document", "position")
    lines = F.flatten(F.transform("starts", lambda start: F.sequence(start, start + (WINDOW - 1))))
    return (
        later.groupBy("document")
        .agg(F.collect_set("position").alias("starts"))
        .select("document", F.array_sort(F.array_distinct(lines)).alias("covered"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without covered lines in ``text``, and n_lines (before) and n_removed as last columns."""
    covered = covered_lines(line_windows(docs))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_hash"))
    joined = rows.join(
        covered,
        rows["row.doc_id"].eqNullSafe(covered["document.doc_id"]) & (rows["text_hash"] == covered["document.text"]),
        "left",
    ).select("row", "covered", lines_of(F.col("row.text")).alias("lines"))
    # the kept lines are the gaps between covered ones
    bounds = F.concat(F.array(F.lit(-1)), F.col("covered"), F.array(F.size("lines")))
    found = joined.withColumn("bounds", bounds)
    gaps = F.transform(
        F.slice("bounds", 2, F.size("bounds")),
        lambda end, i: F.slice("lines", F.get("bounds", i) + 2, end - F.get("bounds", i) - 1),
    )
    text = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return found.select(
        *(text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c not in RESULT),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("long").alias("n_removed"),
    )
