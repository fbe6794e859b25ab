"""Row hashes: the one source of randomness for shuffles, splits and samples.

A row's hash depends on the seed and on the row's identity only, so every result
built on it is the same for any partitioning, read order or retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.spec import SEED

# Four leading hex digits: a fixed number of equally likely, order-preserving shards.
SHARD_DIGITS = 4
SHARDS = 16**SHARD_DIGITS
# Shares are compared on 52 bits, which a double holds exactly.
SHARE_DIGITS = 13


def row_hash(source: Column, row_key: Column, seed: int = SEED, purpose: str = "") -> Column:
    """32 hex digits from seed, source and row key.

    Each ``purpose`` has hashes of its own, so that, say, the rows a mixture keeps are
    not the first ones of the shuffle. The order of rows uses none.
    """
    tag = [F.lit(purpose)] if purpose else []
    return F.md5(F.concat_ws("|", *tag, F.lit(str(seed)), source, row_key.cast("string")))


def hash_number(row_hash: Column, digits: int = 8) -> Column:
    """The leading hex digits of a row hash as a whole number."""
    return F.conv(F.substring(row_hash, 1, digits), 16, 10).cast("long")


def hash_shard(row_hash: Column) -> Column:
    """Shard 0..65535; shards follow the order of the hash."""
    return hash_number(row_hash, SHARD_DIGITS).cast("int")


def in_share(row_hash: Column, share: float) -> Column:
    """True for the lowest ``share`` of all hashes."""
    return hash_number(row_hash, SHARE_DIGITS) < F.lit(round(share * 16**SHARE_DIGITS)).cast("long")
