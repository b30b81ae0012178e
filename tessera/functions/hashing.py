"""Hash expressions: coefficients of a hash family, md5 bins, member encoding."""

from __future__ import annotations

import random

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, ShortType

MERSENNE_31 = 2**31 - 1


def coefficients(n: int, seed: int = 42, p: int = MERSENNE_31) -> list[tuple[int, int]]:
    """n seeded (a, b) pairs in [1, p).

    With members below p <= 2^31 the product a*x stays below 2^62, inside a bigint. The whole
    range matters: with small a and x the product would not pass p, and every hash of the
    family would have its minimum at the same member.
    """
    rnd = random.Random(seed)
    return [(rnd.randrange(1, p), rnd.randrange(1, p)) for _ in range(n)]


def encode_member(col: Column, dtype: DataType, p: int = MERSENNE_31) -> Column:
    """A bigint in [0, p) per member: integers as they are, anything else hashed."""
    if isinstance(dtype, (ShortType, IntegerType, LongType)):
        return F.pmod(col.cast("bigint"), F.lit(p).cast("bigint"))
    return F.pmod(F.xxhash64(col), F.lit(p).cast("bigint"))


def id_bin(col: Column, num_bins: int = 1000) -> Column:
    """md5(id) as a 128-bit number modulo num_bins, from its two 64-bit halves."""
    digest = F.md5(col.cast("string"))
    m = F.lit(num_bins).cast("decimal(20,0)")

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)") % m

    carry = F.lit(pow(2, 64, num_bins)).cast("bigint")
    return ((half(1).cast("bigint") * carry + half(17).cast("bigint")) % num_bins).cast("int")
