"""Row hashes that do not depend on partitioning, run or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(row_key: Column, salt: str = "") -> Column:
    """First 32 bits of the md5 of ``salt`` and the key, as a non-negative long."""
    text = F.concat(F.lit(salt), row_key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash52(*parts: Column | int) -> Column:
    """First 52 bits of the md5 of the parts, joined by colons, as a non-negative long."""
    return F.conv(F.substring(hash_text(*parts), 1, 13), 16, 10).cast("long")


def hash_text(*parts: Column | int) -> Column:
    """md5 of the parts, joined by colons; any engine with md5 can repeat it."""
    columns = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))


def unit_interval(row_key: Column, salt: str) -> Column:
    """Uniform double in [0, 1)."""
    return hash32(row_key, salt) / F.lit(4294967296.0)


def in_training_split(row_key: Column, percent: int = 80) -> Column:
    """Stable train/test assignment: true for ``percent`` of the keys."""
    return hash32(row_key) % 100 < percent
