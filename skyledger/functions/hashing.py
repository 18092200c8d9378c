"""Repeatable pseudo-random numbers from row keys.

``rand(seed)`` depends on how rows are partitioned, so a re-run (or a retried
task on another executor) can draw different numbers. These helpers derive a
uniform number in [0, 1) from an md5 of ``seed`` and the row key instead: the
same row always gets the same number, on any cluster layout, and the value is
reproducible in other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def key_string(*cols: str | Column) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def draw_md5(seed: int | str | Column, *key_cols: str | Column) -> Column:
    """The first 32 bits of md5("seed-key1-key2...") as a whole number."""
    seed_col = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat_ws("-", seed_col, key_string(*key_cols)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform_md5(seed: int | str | Column, *key_cols: str | Column) -> Column:
    """Uniform [0, 1) from the first 32 bits of md5("seed-key1-key2...")."""
    return draw_md5(seed, *key_cols) / F.lit(_TWO_POW_32)
