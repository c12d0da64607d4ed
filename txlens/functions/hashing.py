"""Repeatable pseudo-random numbers from an id and a seed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def hash_int(key: Column, seed: str) -> Column:
    """32-bit integer from the first 8 hex digits of md5('<seed>:<key>')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: Column, seed: str) -> Column:
    """Uniform number in [0, 1), the same on every run and every engine with md5."""
    return hash_int(key, seed) / F.lit(float(HASH_RANGE))
