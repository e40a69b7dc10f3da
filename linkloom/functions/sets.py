"""Set and bag overlap, hash families and signatures, as column expressions."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MERSENNE_31 = 2_147_483_647


def jaccard_set(a: Column | str, b: Column | str) -> Column:
    """Shared distinct elements over all distinct elements; NULL when both are empty."""
    return F.try_divide(
        F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")
    )


def merged_bags(a: Column | str, b: Column | str) -> Column:
    """Two bags (arrays of token and n) as one map: token -> (n in a, n in b), 0 if absent.

    Both bags are hashed by token inside the row, so the work grows with their sizes added
    up and nothing is shuffled.
    """
    return F.map_zip_with(
        F.map_from_entries(a),
        F.map_from_entries(b),
        lambda _, n, m: F.struct(
            F.coalesce(n, F.lit(0)).alias("l"), F.coalesce(m, F.lit(0)).alias("r")
        ),
    )


def bag_size(bag: Column | str) -> Column:
    return F.aggregate(bag, F.lit(0), lambda acc, e: acc + e["n"])


def jaccard_bag(a: Column | str, b: Column | str) -> Column:
    """Occurrences in `a` of a token that `b` has, over the two sizes added up.

    Takes bags as `text.with_bag` makes them. The measure is asymmetric.
    """
    hits = F.aggregate(
        F.map_values(merged_bags(a, b)),
        F.lit(0),
        lambda acc, n: acc + F.when(n["r"] > 0, n["l"]).otherwise(0),
    )
    return F.try_divide(hits.cast("double"), (bag_size(a) + bag_size(b)).cast("double"))


def hash_family(n: int, prime: int = MERSENNE_31, seed: int = 42) -> list[tuple[int, int, int, int]]:
    """`n` independent functions h(x) = (m*x + b) mod prime as rows (hash_no, m, b, p)."""
    if prime <= n:
        raise ValueError("the prime must be greater than the number of hash functions")
    rng = random.Random(seed)
    return [(i, rng.randrange(1, prime), rng.randrange(prime), prime) for i in range(n)]


def token_number(token: Column | str) -> Column:
    """A number below the prime 2**31 - 1 for a token: 15 hex digits of its MD5, modulo the prime.

    More digits than the prime has bits, so that all its values are about equally frequent.
    """
    return F.conv(F.substring(F.md5(token), 1, 15), 16, 10).cast("bigint") % F.lit(MERSENNE_31).cast("bigint")


def apply_hash(element: Column, m: int, b: int, p: int) -> Column:
    return F.pmod(element * F.lit(m).cast("bigint") + F.lit(b).cast("bigint"), F.lit(p).cast("bigint"))


def signature(elements: Column, hashes: Sequence[tuple[int, int, int, int]]) -> Column:
    """MinHash signature of an array of element numbers, computed inside the row."""

    def least(m: int, b: int, p: int) -> Column:
        return F.array_min(F.transform(elements, lambda x: apply_hash(x, m, b, p)))

    return F.when(F.size(elements) > 0, F.array(*[least(m, b, p) for _, m, b, p in hashes]))


def indicator(used: Column, listed: Column) -> Column:
    """A 0/1 array: which of the `listed` elements are in the array `used`.

    `used` goes through a lambda of its own, or else Spark makes it anew for each listed element.
    """
    once = F.transform(F.array(used), lambda u: F.transform(listed, lambda x: F.array_contains(u, x).cast("int")))
    return F.get(once, 0)


def equal_positions(a: Column | str, b: Column | str) -> Column:
    """In how many positions two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
