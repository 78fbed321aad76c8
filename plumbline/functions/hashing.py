"""Reproducible pseudo-random numbers from row keys.

Every random choice (splits, folds, samples, synthetic rows) comes from the
md5 digest of a seed and the row key. The choice belongs to the row, so it
survives repartitioning, retries and lost executors, and any engine that knows
md5 can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 15
HASH_BITS = 4 * HASH_DIGITS
HASH_SPAN = 1 << HASH_BITS

DRAW_DIGITS = 8
DRAW_SPAN = 1 << (4 * DRAW_DIGITS)


def digest(seed: int, keys: Sequence[str | Column], *salt: str | Column) -> Column:
    """md5 over ``seed|key...|salt...``."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    salts = [F.lit(s) if isinstance(s, str) else s for s in salt]
    parts = [c.cast("string") for c in (*cols, *salts)]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hex_number(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("bigint")


def row_hash(keys: Sequence[str | Column], seed: int = 42) -> Column:
    """Uniform integer in ``[0, HASH_SPAN)`` for the row with these keys."""
    return hex_number(digest(seed, keys), 1, HASH_DIGITS)
