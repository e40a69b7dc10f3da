"""Equi-joins that keep their tasks small when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.materialize import materialize

# At most HOT_KEYS keys can each hold more than 1/HOT_KEYS of the rows, whatever the data.
HOT_KEYS = 1000
SPREAD = 4096
# A word and its counts take some tens of bytes, so a broadcast of so many stays below some megabytes.
FREQUENT_KEYS = 100_000
BLOCK_ROWS = 4096


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    rows_per_key: str,
    spread_by: str,
    how: str = "left",
) -> DataFrame:
    """Add the columns of `lookup` (one row per key) to `rows` (many rows per key).

    `rows_per_key` is the column of `lookup` that says how many rows the key has, or has at
    least in proportion. Keys above 1/HOT_KEYS of the total are looked up in a broadcast
    table, which therefore never has more than HOT_KEYS rows. Their rows would fill a few
    partitions of a shuffle, so in the shuffled join for all other keys they are spread by a
    hash of `spread_by`, where they meet no partner. The hash depends on the row alone, so
    a repeated task gives the same rows.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(keys)
    attributes = [c for c in lookup.columns if c not in keys]
    total = lookup.agg(F.sum(rows_per_key)).scalar()
    hot = lookup.filter(F.col(rows_per_key) * HOT_KEYS > total).select(
        *keys, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in attributes]
    )
    cold = lookup.select(
        *keys,
        F.lit(0).alias("_spread"),
        F.lit(True).alias("_cold"),
        *[F.col(c).alias(f"_cold_{c}") for c in attributes],
    )
    spread = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int") + 1
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_spread", F.when(F.col("_hot"), spread).otherwise(0))
        .join(cold, [*keys, "_spread"], "left")
    )
    if how == "inner":
        joined = joined.filter(F.col("_hot") | F.col("_cold"))
    return joined.select(
        *rows.columns,
        *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in attributes if c not in rows.columns],
    )


def frequent_keys(lookup: DataFrame, rows_per_key: str) -> DataFrame:
    """The rows of `lookup` (one per key) with more than 1/FREQUENT_KEYS of the total, at most FREQUENT_KEYS."""
    total = lookup.agg(F.sum(rows_per_key)).scalar()
    return materialize(lookup.filter(F.col(rows_per_key) * FREQUENT_KEYS > total), "frequent-keys")


def rare_join(rows: DataFrame, frequent: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Inner join of the `rows` whose key is not frequent with `lookup`: shuffled by key, none of which has many rows."""
    return rows.join(F.broadcast(frequent.select(key)), key, "left_anti").join(lookup, key)


def frequent_join(rows: DataFrame, lookup: DataFrame, key: str, rows_per_key: str) -> DataFrame:
    """Inner join of `rows` (many per key) with `lookup` (one per key); rows of frequent keys are not moved.

    Frequent keys are looked up in a broadcast table, and only the rows of others are shuffled. `rows` is read
    twice, so it should be made of a written table.
    """
    frequent = frequent_keys(lookup, rows_per_key)
    return rows.join(F.broadcast(frequent), key).unionByName(rare_join(rows, frequent, lookup, key))


def block_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    left_sizes: DataFrame | None = None,
    right_sizes: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner join of two tables that may both have many rows per key.

    A key with n left and m right rows yields n*m rows. Where n or m exceeds `block_rows`,
    the left rows are cut into ceil(n/block_rows) chunks and the right rows into
    ceil(m/block_rows), and every pair of chunks becomes its own join key. No task has to
    work on more than one block at a time, and the result is the same. The numbers of chunks are
    looked up by `lookup_join`, so the rows of a hot key do not meet before they are cut.

    `left_sizes` and `right_sizes` (the keys and `rows`, to be summed) save counting a side
    that is itself the result of much work.
    """
    keys = list(keys)
    left_sizes = left.select(*keys, F.lit(1).alias("rows")) if left_sizes is None else left_sizes
    right_sizes = right.select(*keys, F.lit(1).alias("rows")) if right_sizes is None else right_sizes
    counts = (
        left_sizes.select(*keys, F.col("rows").alias("l"), F.lit(0).alias("r"))
        .unionAll(right_sizes.select(*keys, F.lit(0).alias("l"), F.col("rows").alias("r")))
        .groupBy(*keys)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .filter((F.greatest("l", "r") > block_rows) & (F.least("l", "r") > 0))
    )
    cut = materialize(
        counts.select(
            *keys,
            F.ceil(F.col("l") / block_rows).cast("int").alias("_l_chunks"),
            F.ceil(F.col("r") / block_rows).cast("int").alias("_r_chunks"),
            F.col("l").alias("_l_rows"),
            F.col("r").alias("_r_rows"),
        ),
        "cut-keys",
    )

    def chunked(df: DataFrame, row_id: str, own: str, other: str) -> DataFrame:
        own_n, other_n = F.coalesce(f"_{own}_chunks", F.lit(1)), F.coalesce(f"_{other}_chunks", F.lit(1))
        return (
            lookup_join(df, cut, keys, f"_{own}_rows", row_id)
            .withColumn(f"_{own}", F.pmod(F.xxhash64(row_id), own_n).cast("int"))
            .withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), other_n - 1)))
            .drop("_l_chunks", "_r_chunks", "_l_rows", "_r_rows")
        )

    return (
        chunked(left, left_id, "l", "r")
        .join(chunked(right, right_id, "r", "l"), [*keys, "_l", "_r"])
        .drop("_l", "_r")
    )
