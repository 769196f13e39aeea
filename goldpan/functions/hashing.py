"""Repeatable pseudo-random numbers from row keys.

``rand()`` changes when a task is re-executed on differently ordered input; a digest of (seed, key) does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8


def digest(seed: int | Column, keys: Sequence[str | Column]) -> Column:
    """Hex digest of a seed and the key columns of a row."""
    seed_text = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    texts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", seed_text, *texts))


def hex_threshold(fraction: float) -> str:
    """Digest prefix below which a row falls into the given fraction."""
    return format(min(int(fraction * 16**HEX_DIGITS), 16**HEX_DIGITS - 1), f"0{HEX_DIGITS}x")


def digest_below(seed: int | Column, keys: Sequence[str | Column], fraction: float) -> Column:
    return F.substring(digest(seed, keys), 1, HEX_DIGITS) < F.lit(hex_threshold(fraction))


def uniform(seed: int | Column, keys: Sequence[str | Column]) -> Column:
    """Number in [0, 1) derived from the digest."""
    prefix = F.substring(digest(seed, keys), 1, HEX_DIGITS)
    return F.conv(prefix, 16, 10).cast("double") / F.lit(float(16**HEX_DIGITS))


def fold_of(seed: int, keys: Sequence[str | Column], folds: int) -> Column:
    prefix = F.substring(digest(seed, keys), 1, HEX_DIGITS)
    return (F.conv(prefix, 16, 10).cast("long") % folds).cast("int")
