"""Which shard a partition key belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_number(partition_key: Column | str, shards: int) -> Column:
    """First 32 bits of the key's MD5, modulo the number of shards.

    A null key is routed like the empty key, so that no record loses its shard; writers refuse null
    keys before they get here.
    """
    key = F.col(partition_key) if isinstance(partition_key, str) else partition_key
    digest = F.md5(F.coalesce(key, F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(shards))


def shard_of(partition_key: Column | str, shards: int, prefix: str = "shard-") -> Column:
    return F.concat(F.lit(prefix), shard_number(partition_key, shards).cast("string"))
