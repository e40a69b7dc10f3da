"""Tables that outlive a query: written once for the files they come from, and opened again later.

A kept table may be bucketed by a key and sorted within its buckets. Joins on the key then read it
without an exchange, and a lookup of few keys reads few row groups.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.materialize import settings, shared_folder

# Goes up when what is written changes, so that older tables are not taken for new ones.
FORMAT = 3
BUCKET_ROWS = 1_000_000
MANIFEST = "name string, path string, columns string, key string, sort array<string>, buckets int"


@dataclass(frozen=True)
class Layout:
    """How a table is kept: bucketed by `key`, sorted by it and then by `sort`; plain without a key.

    A table that comes dealt by the key alone has as many buckets as `dealt` says it has partitions, and its
    rows are not moved once more. For another one `rows` may say how many rows it has, about, if that is known;
    else they are counted, which is all the work of making them.
    """

    key: str | None = None
    sort: tuple[str, ...] = ()
    dealt: Callable[[], int] | None = None
    rows: Callable[[], int] | None = None


def stamp(spark: SparkSession, paths: Sequence[str]) -> str:
    """What tells whether files are still the same: a sum over their paths, sizes and times."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length", F.unix_micros("modificationTime").alias("at"))
    mark = F.xxhash64("path", "length", "at").cast("decimal(38,0)")
    row = files.agg(F.count("*").alias("n"), F.sum(mark).alias("sum")).first()
    return f"{row.n}-{row.sum}"


def _opened(spark: SparkSession, row) -> DataFrame:
    if not row.key:
        return spark.read.schema(row.columns).parquet(row.path)
    table = f"kept_{hashlib.sha256(row.path.encode()).hexdigest()[:24]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({row.columns}) USING parquet OPTIONS (path '{row.path}') "
        f"CLUSTERED BY (`{row.key}`) SORTED BY ({', '.join(f'`{c}`' for c in [row.key, *row.sort])}) INTO {row.buckets} BUCKETS"
    )
    return spark.table(table)


def _write(spark: SparkSession, folder: str, name: str, df: DataFrame, layout: Layout) -> tuple:
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    if not layout.key:
        df.write.option("compression", "zstd").parquet(path)
        return name, path, columns, None, [], 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if layout.dealt:
        buckets = layout.dealt()
    else:
        buckets = max(least, -(-(layout.rows() if layout.rows else df.count()) // BUCKET_ROWS))
    table = f"kept_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    dealt = df if layout.dealt else df.repartition(buckets, layout.key)
    writer = dealt.write.format("parquet").option("path", path).option("compression", "zstd")
    # Rows that come sorted by what they are put together by are neither hashed nor sorted once more for it.
    with settings(spark, spark_sql_execution_replaceHashWithSortAgg="true"):
        writer.bucketBy(buckets, layout.key).sortBy(layout.key, *layout.sort).saveAsTable(table)
    return name, path, columns, layout.key, list(layout.sort), buckets


def in_order(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, rows of a bucket are not sorted by its key once more, as the one file it has is sorted; Spark sees to the one."""
    return settings(spark, spark_sql_legacy_bucketedTableScan_outputOrdering="true")


def open_kept(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """The tables kept in a folder, or None where there are none."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()
    except AnalysisException:
        return None
    return {row.name: _opened(spark, row) for row in rows} or None


def keep(spark: SparkSession, folder: str, tables: dict[str, DataFrame], layouts: dict[str, Layout]) -> dict[str, DataFrame]:
    """Write tables to a folder, in any session to be opened by `open_kept`.

    The manifest is written last, so tables that were not finished are never opened.
    """
    rows = [_write(spark, folder, name, df, layouts.get(name, Layout())) for name, df in tables.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return open_kept(spark, folder)


def kept(
    spark: SparkSession,
    name: str,
    paths: Sequence[str],
    build: Callable[[], dict[str, DataFrame]],
    layouts: dict[str, Layout],
    stamped: str | None = None,
) -> dict[str, DataFrame]:
    """The tables that `build` makes of the files at `paths`: opened if they are there, else made and kept.

    They are in the shared folder, outside of any `scope`. Changed files have another stamp and
    get tables of their own; what is no longer wanted goes when the folder is cleaned. `stamped` is the
    stamp of the files that `build` goes back to, if they were read some time before.
    """
    mark = hashlib.sha256(f"{FORMAT} {name} {stamped or stamp(spark, paths)} {' '.join(paths)}".encode()).hexdigest()[:32]
    folder = f"{shared_folder(spark)}/linkloom-kept/{name}-{mark}"
    return open_kept(spark, folder) or keep(spark, folder, build(), layouts)
