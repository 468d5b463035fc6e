"""Running totals over one global order, without one global task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import written


def running_totals(
    df: DataFrame, value: str, sums: Sequence[str], by: str | None = None
) -> DataFrame:
    """Add ``<s>_cum`` (total up to and including the row, in order of ``value``) and
    ``<s>_total`` for each ``s`` of ``sums``, within each group of ``by``.

    ``df`` must hold each (by, value) once, so callers group first and a value shared by
    a third of all rows is one row here. Rows are dealt into the session's shuffle partitions
    by range and written once with the number of their partition, which then stays the same
    for both steps: totals of partitions give each its starting sums, and partitions run side
    by side.
    """
    keys = [by] if by else []
    dealt = df.repartitionByRange(*keys, value).withColumn("_slice", F.spark_partition_id())
    dealt = written(dealt, "running-totals")
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition and group.
    starts = (
        dealt.groupBy(*keys, "_slice")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            *keys,
            "_slice",
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_start") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        )
    )
    inside = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return dealt.join(starts, [*keys, "_slice"]).select(
        *df.columns,
        *[(F.col(f"_{s}_start") + F.sum(s).over(inside)).alias(f"{s}_cum") for s in sums],
        *[f"{s}_total" for s in sums],
    )
