"""Write an intermediate result once, so that its readers do not recompute it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Subfolder that tables are written to just now; changed by `scope` alone.
_current = ["linkloom"]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; where that is unset, one in the warehouse,
    which all machines of a session share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_written"


def materialize(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write `df` as Parquet under the shared folder and return a scan of it.

    `codec` compresses it otherwise than the session does, such as `zstd` for what is large.

    The lineage ends at the files, so a lost executor costs no recomputation of what came
    before, and Spark knows the size of the table when it chooses a join. The files stay until
    the `scope` around the call ends, or else until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{_current[-1]}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_lines(lines: DataFrame, name: str) -> str:
    """Write a table of one string column as text files under the shared folder, one line a row; their path.

    A value must not hold a line feed, which would make two lines of it.
    """
    path = f"{shared_folder(lines.sparkSession)}/{_current[-1]}/{name}-{uuid.uuid4().hex}"
    lines.write.text(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Delete, at the end, all tables that were written inside.

    Results must be used up or written elsewhere before: they read those tables.
    """
    name = f"linkloom/scope-{uuid.uuid4().hex}"
    _current.append(name)
    try:
        yield name
    finally:
        _current.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session (`_` for the dots of their names) that hold for what is run inside."""
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
