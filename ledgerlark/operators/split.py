"""Exact stratified train/test split, seeded and independent of partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 4


def test_sizes(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, n_test): test rows per class, largest remainder to a total of ceil(share x n).

    Works on one row per class. Remainder ties go to the greater label.
    """
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    all_classes = Window.partitionBy()
    quota = F.col("total") * F.col("n") / F.col("rows")
    by_remainder = Window.partitionBy().orderBy(
        (F.col("quota") - F.floor("quota")).desc(), F.col(label).desc()
    )
    return (
        classes.withColumn("rows", F.sum("n").over(all_classes))
        .withColumn("total", F.ceil(F.round(F.col("rows") * F.lit(test_size), 9)))
        .withColumn("quota", F.round(quota, 9))
        .withColumn("floors", F.sum(F.floor("quota")).over(all_classes))
        .withColumn("place", F.row_number().over(by_remainder))
        .select(
            label,
            (
                F.floor("quota") + (F.col("place") <= F.col("total") - F.col("floors")).cast("int")
            ).alias("n_test"),
        )
    )


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.3, seed: int = 42
) -> DataFrame:
    """Add ``is_test``. Within each class the rows with the smallest hashes are the test rows.

    A class may hold most rows, so it is never ranked as a whole. Rows are counted per hash
    prefix; only the one prefix bucket where the class's test quota ends is ranked, which
    gives one cut-off hash per class. The split is then a comparison on each row. The ranked
    bucket holds about one in 65,536 of a class's rows.
    """
    order = F.concat_ws("|", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key))), F.col(key))
    keyed = df.select(label, order.alias("_order")).withColumn(
        "_bucket", F.substring("_order", 1, BUCKET_DIGITS)
    )
    buckets = (
        keyed.groupBy(label, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_seen",
            F.sum("_n").over(
                Window.partitionBy(label)
                .orderBy("_bucket")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )
    last = (
        buckets.join(test_sizes(df, label, test_size), label)
        .where((F.col("n_test") > F.col("_seen") - F.col("_n")) & (F.col("n_test") <= F.col("_seen")))
        .select(label, "_bucket", (F.col("n_test") - F.col("_seen") + F.col("_n")).alias("_take"))
    )
    cutoffs = (
        keyed.join(last, [label, "_bucket"])
        .withColumn("_rn", F.row_number().over(Window.partitionBy(label).orderBy("_order")))
        .where(F.col("_rn") == F.col("_take"))
        .select(label, F.col("_order").alias("_cutoff"))
    )
    return (
        df.withColumn("_order", order)
        .join(cutoffs, label, "left")
        .withColumn("is_test", F.coalesce(F.col("_order") <= F.col("_cutoff"), F.lit(False)))
        .drop("_order", "_cutoff")
        .select(*df.columns, "is_test")
    )


