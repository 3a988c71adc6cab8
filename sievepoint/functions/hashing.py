"""Seeded order and randomness that depend on the row key alone, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_key(key: Column, seed: int = 42) -> Column:
    """32 hex digits: rows sorted by it are shuffled by ``seed``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def salted_order_key(key: Column, salt: Column, seed: int = 42) -> Column:
    return F.md5(F.concat((salt + F.lit(seed)).cast("string"), F.lit(":"), key.cast("string")))


def uniform(key: Column, seed: int, stream: str = "u") -> Column:
    """Uniform number in (0, 1) with 52 random bits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{stream}:"), key.cast("string")))
    whole = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(1 << 52))


def normal(key: Column, seed: int) -> Column:
    """Standard normal number by Box-Muller."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(key, seed, "a")))
    return radius * F.cos(F.lit(6.283185307179586) * uniform(key, seed, "b"))


def md5_mod(text: Column, n: int) -> Column:
    """The 128-bit md5 number modulo ``n``, eight hex digits at a time."""
    digest = F.md5(text)
    step = (1 << 32) % n
    rest = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        rest = (rest * step + part) % n
    return rest
