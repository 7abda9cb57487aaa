"""Hashes that depend on key values only, never on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def key_hash(key: Column, seed: int) -> Column:
    """32-bit number from a key and a seed, the same on every engine with MD5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_range(hashed: Column, ranges: int) -> Column:
    """Which of `ranges` equal slices of the hash space a hash falls in."""
    return F.floor(hashed * ranges / HASH_SPACE).cast("int")
