"""Keep the newest version of each key, and key-wise replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str, newest: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``newest`` columns win, NULL loses.

    All other columns break full ties, so the result does not depend on how the input
    is partitioned. Spark turns ``rn = 1`` into a group limit that runs before the
    shuffle too: each task sends one row per key at most, however hot the key. Columns of
    ``newest`` that ``df`` does not have are left out; rows of nothing but keys are distinct ones.
    """
    newest = [c for c in newest if c in df.columns]
    if df.columns == [key]:
        return df.distinct()
    ties = [c for c in df.columns if c != key and c not in newest]
    order = [F.col(c).desc_nulls_last() for c in (*newest, *ties)]
    versions = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(versions))
        .where("_rn = 1")
        .drop("_rn")
    )


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing`` with the same keys.

    ``incoming`` must hold each key once. It is the right side of the anti join, so a
    small batch is broadcast (after Spark has checked its size) and the large table stays
    where it is.
    """
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*incoming.columns).unionByName(incoming)
