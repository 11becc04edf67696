"""Stable hash buckets and the keys built from them.

The contract is: deterministic, uniform, never negative, null in gives null out, and the
same function wherever a value is hashed (sampling, keys, training, serving).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankframe.functions.fingerprint import farm_fingerprint
from rankframe.spec import BUYER_HASH_MODULUS, DAY_KEY_SCALE

ALGORITHMS = ("xxhash64", "md5", "farm")

# Hashed in place of a null id; the control character keeps it apart from real ids.
NULL_ID_TOKEN = "\u0001null"


def hash_mod(value: Column, n: int, algo: str = "xxhash64") -> Column:
    """Bucket of ``value`` in ``[0, n)`` as a long.

    ``xxhash64`` is the fast default; ``md5`` uses the leading 60 bits of the digest and can
    be reproduced by any SQL engine; ``farm`` gives the buckets of a warehouse with that
    fingerprint, so rows sampled here are those sampled there, at the price of passing the value
    through Python in Arrow batches.  The value is hashed as a string, because the same id
    as int and as bigint would otherwise hash differently.
    """
    text = value.cast("string")
    if algo == "xxhash64":
        # modulus before abs: abs(Long.MinValue) overflows
        return F.when(text.isNotNull(), F.abs(F.xxhash64(text) % F.lit(n).cast("long")))
    if algo == "md5":
        leading = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
        return leading % F.lit(n).cast("long")
    if algo == "farm":
        return F.abs(farm_fingerprint(text) % F.lit(n).cast("long"))
    raise ValueError(f"algo must be one of {ALGORITHMS}, got {algo!r}")


def buyer_hash(buyer: Column, algo: str = "xxhash64") -> Column:
    """Hash of a buyer id, small enough that ``user_date_key`` fits a long."""
    return hash_mod(buyer, BUYER_HASH_MODULUS, algo)


def user_date_key(hashed_buyer: Column, day: Column) -> Column:
    """One long per (buyer, day); a null on either side counts as 0."""
    return F.coalesce(hashed_buyer, F.lit(0).cast("long")) * F.lit(DAY_KEY_SCALE).cast(
        "long"
    ) + F.coalesce(F.unix_date(day.cast("date")), F.lit(0)).cast("long")


def concat_key(*parts: Column) -> Column:
    """Parts as text joined by ``|``; null if any part is null (so not ``concat_ws``)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def hashed_id(value: Column, buckets: int, algo: str = "xxhash64") -> Column:
    """Id hashed to ``1..buckets``; all null ids share one of these buckets."""
    token = F.coalesce(value.cast("string"), F.lit(NULL_ID_TOKEN))
    return (hash_mod(token, buckets, algo) + 1).cast("int")
