"""Reproducible row splits, decided by a hash of the row's id.

The same row lands in the same part on any cluster and with any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.storage import materialize

LEAF_ROWS = 10_000  # hashes of one class that may be sorted in one group


def row_digest(row_id: Column, salt: str = "") -> Column:
    text = row_id.cast("string")
    return F.md5(F.concat(F.lit(salt), text) if salt else text)


def row_hash(row_id: Column, salt: str = "") -> Column:
    """Number from 0 to 2³²−1, uniform over rows."""
    return F.conv(F.substring(row_digest(row_id, salt), 1, 8), 16, 10).cast("bigint")


def with_test_flag(df: DataFrame, row_id: str, test_percent: int = 20, salt: str = "") -> DataFrame:
    return df.withColumn("is_test", row_hash(named(row_id), salt) % 100 < test_percent)


def with_fold(df: DataFrame, row_id: str, folds: int = 5, column: str = "fold", salt: str = "fold:") -> DataFrame:
    """Fold number from a hash of its own, so folds and test flag are independent."""
    return df.withColumn(column, (row_hash(named(row_id), salt) % folds).cast("int"))


def with_stratified_test_flag(
    df: DataFrame,
    row_id: str,
    label: str,
    test_share: float = 0.3,
    min_rows: int = 30,
    salt: str = "",
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Exactly ``floor(test_share · n)`` test rows of each class: those with the smallest hashes.

    Sorting a class by hash would put a class with a third of all rows into one task. Instead the cut
    is found by counting: rows per class and hash prefix, then longer prefixes inside the one prefix
    that holds the cut, until its rows are few. Cuts are a table with a row per class, joined to the rows, so there
    may be any number of classes. Rows with equal ids are on one side of the cut.
    A table with fewer than ``min_rows`` rows is all training data.
    """
    digest = row_digest(named(row_id), salt)
    hashed = materialize(df.select(named(label).alias("label"), digest.alias("digest")), "split-hashes")
    wanted = F.floor(F.col("rows") * test_share + 1e-9).cast("bigint")
    sizes = hashed.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    cuts = materialize(sizes.select("label", F.lit("").alias("prefix"), wanted.alias("wanted"), "rows"), "split-cuts")
    total = cuts.agg(F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
    if (total["rows"] or 0) < min_rows:
        return df.withColumn("is_test", F.lit(False))

    length, most = 0, total["most"]
    while most > leaf_rows and length < 30:
        length += 3
        cuts = materialize(_next_cuts(hashed, cuts, length), "split-cuts")
        most = cuts.agg(F.max("rows").alias("most")).first()["most"] or 0
    last = _next_cuts(hashed, cuts, 32).select("label", F.col("prefix").alias("cut"))
    last = materialize(last.select(F.col("label").alias("_label"), F.col("cut").alias("_cut")), "split-cuts")
    joined = df.join(last, named(label).eqNullSafe(F.col("_label")), "left")
    return joined.withColumn("is_test", F.coalesce(digest <= F.col("_cut"), F.lit(False))).drop("_label", "_cut")


def _next_cuts(hashed: DataFrame, cuts: DataFrame, length: int) -> DataFrame:
    """For each class the longer prefix that holds its cut, with the test rows wanted inside it and its rows."""
    known = cuts.where("wanted > 0").select(F.col("label").alias("_label"), F.col("prefix").alias("_prefix"), "wanted")
    inside = hashed.join(known, F.col("label").eqNullSafe(F.col("_label")) & F.col("digest").startswith(F.col("_prefix")))
    counted = inside.groupBy("label", "wanted", F.substring("digest", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    up_to = F.sum("rows").over(Window.partitionBy("label").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    reached = counted.withColumn("up_to", up_to).where((F.col("up_to") >= F.col("wanted")) & (F.col("up_to") - F.col("rows") < F.col("wanted")))
    return reached.select("label", "prefix", (F.col("wanted") - F.col("up_to") + F.col("rows")).alias("wanted"), "rows")
