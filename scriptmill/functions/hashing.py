"""Deterministic keyed hash used for seeded shuffles, samples and draws.

``h(salt, key) = first 32 bits of md5(salt || '|' || key)`` as an unsigned
integer.  The same expression is available in DuckDB, which lets the SQL
oracle reproduce every split exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of


def keyed_hash(salt, key) -> Column:
    """Unsigned 32-bit hash of ``salt|key`` (a bigint in [0, 2**32))."""
    digest = F.md5(F.concat(F.lit(str(salt)), F.lit("|"), col_of(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_bucket(h, bits: int) -> Column:
    """Leading ``bits`` bits of a 32-bit hash: a bucket id monotone in ``h``."""
    return F.shiftrightunsigned(col_of(h), 32 - bits).cast("int")
