"""Seeded hashes of string columns as non-negative integers.

`md5` hashes are reproducible in any SQL engine and feed the checked queries;
`xxhash64` is several times cheaper and is the choice for production runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = {"md5": 60, "xxhash64": 63}


def _md5_prefix(text: Column, hex_digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("long")


def hash_int(item: Column, seed: int | None = None, method: str = "md5") -> Column:
    """Hash of `item` (salted with `seed`) using HASH_BITS[method] bits."""
    text = item if seed is None else F.concat(F.lit(f"{seed}|"), item)
    if method == "md5":
        return _md5_prefix(text, 15)
    if method == "xxhash64":
        # xxhash64 of a null is the seed, so keep null items null
        return F.when(text.isNotNull(), F.shiftrightunsigned(F.xxhash64(text), 1))
    raise ValueError(f"unknown hash method {method!r}")


def hash_bucket(item: Column, seed: int, width: int, method: str = "md5") -> Column:
    return F.pmod(hash_int(item, seed, method), F.lit(width))


def unit_interval(text: Column) -> Column:
    """Deterministic number in the open interval (-0.5, 0.5) from 48 hash bits."""
    return (_md5_prefix(text, 12) + F.lit(0.5)) / F.lit(float(1 << 48)) - F.lit(0.5)
