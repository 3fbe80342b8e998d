"""Newest rows, overall and per group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from borelog.operators.cleaning import for_well
from borelog.schema import ALL_WELLS
from borelog.support import same_keys, small_side

# The columns of the two table functions, in their order.
LATEST_COLUMNS = ("well_number", "timestamp", "T-JUS-CKP", "T-TPT", "P-TPT", "P-MON-CKP", "P-PDG", "QGL")
RECENT_COLUMNS = (
    "well_number", "state", "timestamp", "T-JUS-CKP", "T-TPT", "P-TPT", "P-MON-CKP", "P-PDG", "source_file",
)

# Spark keeps the best n rows of a group in each task before the shuffle, for n up to this (its default threshold).
GROUP_LIMIT = 1000
# A longer top n of a long group is first taken within this many parts of the group.
GROUP_PARTS = 256


def newest_rows(rows: DataFrame, n: int, tie_break: Sequence[str] = ("source_file",)) -> DataFrame:
    """The ``n`` newest rows of all; each task hands on at most ``n``."""
    return rows.orderBy(*_newest_first(rows, tie_break)).limit(n)


def newest_per_group(
    rows: DataFrame,
    groups: Sequence[str],
    n: int = 1,
    tie_break: Sequence[str] = ("source_file",),
    prune_days: bool = False,
) -> DataFrame:
    """The ``n`` newest rows of every group, however long the group.

    Each task sorts its own rows and hands on at most ``n`` per group. With ``prune_days`` a first pass counts rows per
    group and day, from two narrow columns and without sorting, and then only the days that can hold one of the newest
    ``n`` rows are sorted. That costs about what it saves on rows of ten columns in memory; it is meant for rows so
    wide that sorting them spills.
    """
    order = _newest_first(rows, tie_break)
    if prune_days:
        rows = _recent_days(rows, groups, n)
    if n > GROUP_LIMIT:
        # By content and task, so that a task that runs again deals its rows, copies included, as before.
        part = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(GROUP_PARTS))
        rows = rows.withColumn("_part", part)
        rows = _first_n(rows, [*groups, "_part"], order, n).drop("_part")
    return _first_n(rows, groups, order, n)


def _recent_days(rows: DataFrame, groups: Sequence[str], n: int) -> DataFrame:
    days = rows.groupBy(*groups, F.to_date("timestamp").alias("_day")).agg(F.count("*").alias("_n"))
    newest_first = Window.partitionBy(*groups).orderBy(F.desc_nulls_last("_day"))
    needed = days.withColumn("_newer", F.sum("_n").over(newest_first) - F.col("_n")).where(F.col("_newer") < n)
    # A group that needs its rows without a time needs all its rows.
    first_day = F.when(F.count("_day") == F.count("*"), F.min("_day"))
    first_days = needed.groupBy(*[F.col(g).alias(f"_from_{g}") for g in groups]).agg(first_day.alias("_first_day"))
    first_days = small_side(first_days)
    recent = F.col("_first_day").isNull() | (F.to_date("timestamp") >= F.col("_first_day"))
    return rows.join(first_days, same_keys(groups, "_from_") & recent).select(*rows.columns)


def latest_n_obs(
    observations: DataFrame,
    well: int = ALL_WELLS,
    n: int = 5,
    scan_cap: int | None = None,
    tie_break: Sequence[str] = ("source_file",),
    prune_days: bool = False,
) -> DataFrame:
    """The ``n`` newest observations per well.

    Looks at everything by default. With ``scan_cap`` only the newest that many rows of all wells together are looked
    at, so quiet wells may be missing. A capped call takes the global top first and ranks inside it, which is the
    same as ranking first, since the newest rows overall hold the newest of every well they touch.
    """
    rows = for_well(observations, well).select(*LATEST_COLUMNS, *[c for c in tie_break if c not in LATEST_COLUMNS])
    if scan_cap is not None:
        rows = newest_rows(rows, scan_cap, tie_break)
    return newest_per_group(rows, ["well_number"], n, tie_break, prune_days).select(*LATEST_COLUMNS)


def most_recent_obs(
    observations: DataFrame,
    well: int = ALL_WELLS,
    tie_break: Sequence[str] = ("source_file",),
    prune_days: bool = False,
) -> DataFrame:
    """The newest observation of every (well, state)."""
    rows = for_well(observations, well).select(*RECENT_COLUMNS)
    return newest_per_group(rows, ["well_number", "state"], 1, tie_break, prune_days)


def _newest_first(rows, tie_break):
    """Newest first, ties by ``tie_break`` and then by row content, so that the order of the input never shows."""
    return [F.desc("timestamp"), *[F.asc(c) for c in tie_break if c in rows.columns], F.xxhash64(*rows.columns)]


def _first_n(rows, groups, order, n):
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
