"""Exact stratified split without sorting or shuffling the rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from borelog.operators.ordering import seeded_key
from borelog.support import BROADCAST_ROWS

# Hex digits of the hash by which rows are counted: a label has at most 65,536 counts.
PREFIX_DIGITS = 4


def stratified_split(
    rows: DataFrame,
    label: str = "state",
    keys: Sequence[str] = ("well_number", "timestamp", "source_file"),
    test_ratio: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``is_test``: true for the ``round(test_ratio * size)`` rows of each label whose hashed keys come first.

    Each label needs only one number, the last hash that belongs to its test part. Rows are counted by the first digits
    of their hash, in one pass, and the hashes with the digits on which the target falls, one in 65,536, are ranked in a
    second one; the rows themselves stay where they are. Nothing runs before the result is asked for. Rows with the same
    keys are never parted, so copies cannot leak from training into test; if keys repeat, the test part is the smallest
    such set that reaches its target. The result fails beyond BROADCAST_ROWS labels.
    """
    hashed = rows.withColumn("_key", seeded_key(rows, keys, seed))
    narrow = hashed.select(F.col(label).alias("_label"), "_key", F.substring("_key", 1, PREFIX_DIGITS).alias("_prefix"))

    stratum = Window.partitionBy("_label")
    counts = narrow.groupBy("_label", "_prefix").agg(F.count("*").alias("_n"))
    running = counts.select(
        "_label",
        "_prefix",
        (F.sum("_n").over(stratum.orderBy("_prefix")) - F.col("_n")).alias("_before"),
        "_n",
        F.round(F.sum("_n").over(stratum) * F.lit(test_ratio)).cast("bigint").alias("_target"),
    )
    border = running.where("_before < _target AND _target <= _before + _n").select(
        F.col("_label").alias("_border_label"),
        F.col("_prefix").alias("_border_prefix"),
        (F.col("_target") - F.col("_before")).alias("_rest"),
    )
    at_border = F.col("_label").eqNullSafe(F.col("_border_label")) & (F.col("_prefix") == F.col("_border_prefix"))
    copies = narrow.join(_per_label(border), at_border).groupBy("_label", "_key", "_rest").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(stratum.orderBy("_key"))
    last_keys = (
        copies.withColumn("_upto", upto)
        .where(F.col("_upto") >= F.col("_rest"))
        .groupBy(F.col("_label").alias("_last_label"))
        .agg(F.min("_key").alias("_last_key"))
    )
    return hashed.join(
        _per_label(last_keys), F.col(label).eqNullSafe(F.col("_last_label")), "left"
    ).select(*rows.columns, F.coalesce(F.col("_key") <= F.col("_last_key"), F.lit(False)).alias("is_test"))


def _per_label(rows: DataFrame) -> DataFrame:
    """One row per label, for broadcast; that they are few is checked when they are known."""
    listed = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("rows"))
    too_many = F.raise_error(F.lit(f"a split is for at most {BROADCAST_ROWS} labels")).cast(listed.schema["rows"].dataType)
    checked = F.when(F.size("rows") <= BROADCAST_ROWS, F.col("rows")).otherwise(too_many)
    return F.broadcast(listed.select(F.inline(checked)))


def split_by_time(rows: DataFrame, test_from) -> DataFrame:
    """Add ``is_test`` for the rows from a moment on; parts of one series then do not overlap in time."""
    return rows.withColumn("is_test", F.col("timestamp") >= F.lit(test_from))


def split_classes(split: DataFrame, label: str = "state") -> DataFrame:
    """Rows and distinct labels of the two parts."""
    sizes = split.groupBy("is_test", label).agg(F.count("*").alias("n"))
    return sizes.groupBy("is_test").agg(F.sum("n").alias("n_rows"), F.count(label).alias("n_classes"))
