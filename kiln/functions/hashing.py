"""Seeded, engine-independent keys (md5-based; identical in Spark and DuckDB)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["seeded_key", "seeded_index"]


def seeded_key(seed, *cols) -> Column:
    """Hex md5 of ``seed|c1|c2...``: a stable random order key (F1, F2)."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def seeded_index(seed, n, *cols) -> Column:
    """Integer in [0, n) drawn from the first 32 bits of ``seeded_key``."""
    h = F.conv(F.substring(seeded_key(seed, *cols), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, n if isinstance(n, Column) else F.lit(n))
