"""The fold of a document, and bounded samples that do not depend on the order or partitioning of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is a multiple of ``FOLDS``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def draw(*columns: Column, seed: int) -> Column:
    """A number from 0 to 1 that looks random and depends on the values and the seed only."""
    return (F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).cast("double")


def stretch(text: Column, chars: int, place: Column) -> Column:
    """``chars`` characters of a text from a place that ``place`` (0 to 1) picks, or the whole of a shorter text."""
    first = F.floor(place * F.greatest(F.length(text) - chars + 1, F.lit(1))).cast("int")
    return F.substring(text, first + 1, chars)
