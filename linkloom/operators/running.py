"""Running sums over a whole table in its order, on many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.materialize import materialize


def running_sums(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add `<value>_before` for each of `values`: its sum over all rows before this one in the order.

    Rows are dealt out by ranges of the order. Each task sums its own rows; what the tasks before
    it have is added after. One window over all data has one row a task. The ranged rows are
    written, so that a repeated task finds them as they were. Rows should differ in the order;
    among equal ones each counts those that happen to come before it.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    kinds = {v: dict(df.dtypes)[v] for v in values}
    parts = ranged.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).cast(k).alias(f"_{v}") for v, k in kinds.items()])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    before = [(F.col(f"_in_{v}") + F.col(f"_{v}")).cast(k).alias(f"{v}_before") for v, k in kinds.items()]
    return summed.join(offsets, "_part").select(*df.columns, *before)
