"""Stable hash buckets: functions of the key alone, so they do not move with partitioning or session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(key: Column, salt: str = "") -> Column:
    text = key.cast("string")
    return F.md5(F.concat(F.lit(salt), text)) if salt else F.md5(text)


def digest_number(digest: Column, hex_digits: int = 8) -> Column:
    """The leading hex digits as a BIGINT; it orders as the digest does."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    return digest_number(key_digest(key, salt)) % buckets
