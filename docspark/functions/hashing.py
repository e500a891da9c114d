"""Deterministic hashing shared with the SQL oracle (md5 is available in both)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(c: Column | str, dim: int) -> Column:
    """Feature-hash a token into ``[0, dim)``: first 32 bits of md5, modulo dim."""
    c = F.col(c) if isinstance(c, str) else c
    h = F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(dim)).cast("int")


def content_hash(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.coalesce(c, F.lit("")))
