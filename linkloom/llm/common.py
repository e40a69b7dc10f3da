"""What several operators share: folds, words, running totals and written tables."""

from __future__ import annotations

import gc
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.operators.materialize import materialize

# Texts that are handed to Python at a time.
TEXT_ROWS = 500

# Everything below 0x80 that is not a letter or a digit becomes a blank, capitals become small.
_WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5. A null id belongs to no fold."""
    return F.pmod(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")), F.lit(5))


def blank_words(text: str | None) -> list[bytes]:
    """Runs of bytes other than blank and tab to carriage return, A-Z in small letters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, A-Z in small letters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split()


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def row_key(df: DataFrame) -> Column:
    """A hash of all columns, which tells rows of one id apart. Maps, which have no hash, are left out."""
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    # A hash skips nulls; the flags tell in which columns they are.
    return F.xxhash64(*[c for n in hashed for c in (F.col(f"`{n}`").isNull(), F.col(f"`{n}`"))])


def with_row_hash(rows: DataFrame) -> DataFrame:
    """Add `_row`, a hash of all columns but the id."""
    return rows.withColumn("_row", F.xxhash64(*[c for c in rows.columns if c != "doc_id"]))


def first_rows(keys: DataFrame, most: int, most_chars: int) -> DataFrame:
    """(doc_id, _row, _chars) to a broadcast table of at most `most` distinct (doc_id, _row), the smallest
    by hash of the id, then id and hash of the row; without those whose text would bring the sample
    over `most_chars`. Rows that are repeated count once, rows without id not at all."""
    distinct = keys.filter(F.col("doc_id").isNotNull()).select("doc_id", "_row", "_chars").distinct()
    found, chars = [], 0
    for r in distinct.orderBy(F.xxhash64("doc_id"), "doc_id", "_row").limit(most).collect():
        if chars + r["_chars"] <= most_chars:
            chars += r["_chars"]
            found.append((r["doc_id"], r["_row"]))
    kind = keys.schema["doc_id"].dataType.simpleString()
    return F.broadcast(keys.sparkSession.createDataFrame(found, f"doc_id {kind}, _row bigint"))


def of_sample(rows: DataFrame, sample: DataFrame) -> DataFrame:
    """The rows with `_row` that are in the sample, each once. Repeated ones meet in their own tasks first."""
    others = [c for c in rows.columns if c not in ("doc_id", "_row")]
    picked = rows.join(sample, ["doc_id", "_row"])
    return picked.groupBy("doc_id", "_row").agg(*[F.min(c).alias(c) for c in others]).drop("_row")


def running_total(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, name: str, kind: str
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the same group up to and with this one.

    Rows are dealt out by ranges of (groups, order), so one large group fills many tasks. Each
    task's rows are summed on their own; the totals of the tasks before are added after. What
    meets in one window is a task's part of a group, or one row per task and group. The ranged
    rows are written, so a repeated task finds them as they were. `order` should tell rows
    apart; rows that are equal in it may be numbered either way.
    """
    at = [F.col(c).asc_nulls_last() for c in groups]
    ranged = df.repartitionByRange(*at, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, f"ranged-{name}")
    keys = [*groups, "_part"]
    parts = ranged.groupBy(*keys).agg(F.sum(value).cast(kind).alias("_in_part"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(c).alias(f"_of_{c}") for c in keys],
        F.coalesce(F.sum("_in_part").over(before), F.lit(0)).cast(kind).alias("_before"),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.withColumn("_within", F.sum(value).over(within).cast(kind))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    return inside.join(offsets, same).select(
        *df.columns, (F.col("_within") + F.col("_before")).cast(kind).alias(name)
    )


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """From now on Spark hands at most so many rows at a time to Python in this session.

    Its default of 10,000 rows is meant for numbers. Of whole texts, that is a copy of a task's
    whole input in the executor's own memory and another one in the Python worker's.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are done and whose results are written.

    It does so when the driver collects its garbage, which a driver with little to do may put off
    until the disks are full. Nothing depends on it but space.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
