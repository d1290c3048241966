"""Words and word sequences, as Catalyst expressions.

A word is a longest run of A-Z, a-z, 0-9, in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """All words of ``text`` in order; null and blank texts give an empty array."""
    cut = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9]+", " ")), " ")
    return F.filter(cut, lambda w: w != "")


def shingles(ws: Column, n: int) -> Column:
    """64-bit hashes of the ``n``-word sequences starting at each word that has ``n-1`` after it."""
    starts = F.sequence(F.lit(0), F.size(ws) - n)
    return F.when(F.size(ws) >= n, F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(ws, i + 1, n))))).otherwise(F.array().cast("array<bigint>"))
