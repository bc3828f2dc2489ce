"""A keyed bijection on row places, so that the partner of a place is arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Odd multipliers of the rounds, below 2^31 so that products stay within a long.
FACTORS = [1_597_334_677, 1_013_904_223, 1_664_525, 2_135_587_861, 747_796_405, 1_181_783_497]
_LOW = (1 << 31) - 1


def halves(n: int) -> tuple[int, int]:
    """(a, b): the least numbers near the root of n with a * b >= n."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def walks(n: int) -> int:
    """Walks after which fewer than one place in 10^24 is still outside 0..n-1."""
    a, b = halves(n)
    outside = 1 - n / (a * b)
    return 1 if outside <= 0 else max(2, math.ceil(-80 / math.log2(outside)))


def round_key(seed: Column | int, repeat: Column) -> Column:
    return (F.lit(seed).cast("long") * F.lit(1_000_003) + repeat.cast("long") * F.lit(7_919)).bitwiseAND(F.lit(_LOW))


def exchanged(place: Column, n: int, key: Column) -> Column:
    """The place in 0..n-1 that `place` is exchanged with under a key: a bijection for each key.

    A Feistel network on pairs (l, r) with l < a and r < b permutes the places below a * b, a few
    more than n; one that comes out at n or beyond is taken on along its cycle until it is inside.
    """
    if n >= 1 << 62:
        raise ValueError("at most 2^62 rows can be exchanged")
    a, b = halves(n)

    def network(at: Column) -> Column:
        sides, sizes = [F.call_function("div", at, F.lit(b).cast("long")), at % F.lit(b)], (a, b)
        for i, factor in enumerate(FACTORS):
            own, other = i % 2, 1 - i % 2
            mixed = (sides[other] + key + F.lit(i)).bitwiseAND(F.lit(_LOW)) * F.lit(factor).cast("long")
            sides[own] = (sides[own] + F.shiftright(mixed, 16)) % F.lit(sizes[own])
        return sides[0] * F.lit(b) + sides[1]

    def step(at: Column, walk: Column) -> Column:
        return F.when((walk > 1) & (at < n), at).otherwise(network(at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(walks(n))), place.cast("long"), step)
