"""Deterministic row ids and key buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_uid(*parts) -> Column:
    """sha2-256 over the parts, each as ``length:value`` and NULL as ``-``, so that
    no value can be taken for NULL or for two values.

    Replaces an id made of ``monotonically_increasing_id`` and the clock: the same
    input gives the same id on every replay.
    """
    texts = [_c(p).cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("\u001f", *marked), 256)


def key_bucket(key, buckets: int) -> Column:
    """Bucket of a business key: ``pmod(xxhash64(key), buckets)``."""
    return F.pmod(F.xxhash64(_c(key)), F.lit(buckets)).cast("int")


def linear_bucket(key, buckets: int) -> Column:
    """Bucket of a business key by linear hashing: the hash's low bits, one bit
    more for buckets that have been split already. From one count to a larger one,
    a key stays where it is or moves to one of the buckets that are new."""
    low = 1 << (buckets.bit_length() - 1)
    at = F.xxhash64(_c(key)).bitwiseAND(F.lit(2 * low - 1))
    return F.when(at < buckets, at).otherwise(at - low).cast("int")


def split_source(bucket: int, buckets: int) -> int:
    """The bucket, of ``buckets`` in all, whose keys a later bucket takes."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket
