"""Forward fill of long sensor series."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from borelog.support import BROADCAST_ROWS, materialise, same_keys, small_side

# Rows sampled per cut point of an oversized chunk.
SAMPLES_PER_SLICE = 16


def forward_fill(
    observations: DataFrame,
    partition_cols: Sequence[str] = ("well_number",),
    order_col: str = "timestamp",
    tie_break: Sequence[str] = ("source_file",),
    fill_cols: Sequence[str] | None = None,
    max_gap: str | None = None,
    max_chunk_rows: int = 5_000_000,
) -> DataFrame:
    """Replace each NULL by the last non-NULL value before it in its series; leading NULLs stay.

    A series is one value of ``partition_cols``, in the order of ``order_col``, ``tie_break`` and row content. By
    default every column but the keys is filled, across files and over any gap; add ``source_file`` to the partition
    columns to stop at file borders, or give ``max_gap`` (an interval such as ``'1 hour'``) to stop at long gaps.

    While no series is longer than ``max_chunk_rows`` one window over the series does the work. Otherwise the series
    are cut into days, and days that are still too long into slices: the rows are shuffled by chunk, once, and filled
    inside their chunk; the last row of each chunk then says what it leaves behind, and what the chunks before a chunk
    leave behind fills its leading NULLs. The result is the same.
    """
    keys = list(partition_cols)
    fill_cols = [c for c in observations.columns if c not in (*keys, order_col)] if fill_cols is None else fill_cols
    fill_cols = [c for c in fill_cols if c not in keys]
    rows = observations.withColumn("_hash", F.xxhash64(*observations.columns))
    order = [order_col, *[c for c in tie_break if c in observations.columns and c not in keys], "_hash"]
    held = rows.withColumns({c: _held(c, order_col, max_gap) for c in fill_cols}) if max_gap else rows

    longest_series, longest_day = _longest(observations, keys, order_col)
    if longest_series <= max_chunk_rows:
        so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = held.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in fill_cols})
    else:
        held = held.withColumn("_day", _day(observations, order_col))
        chunk = ["_day"]
        if longest_day > max_chunk_rows:
            held, chunk = add_slice(held, [*keys, "_day"], order, max_chunk_rows), ["_day", "_slice"]
        filled = _fill_chunks(held, keys, chunk, order, fill_cols)
    if max_gap:
        in_reach = lambda c: F.col(order_col) <= F.col(c)["at"] + F.expr(f"INTERVAL {max_gap}")
        filled = filled.withColumns({c: F.when(in_reach(c), F.col(c)["value"]) for c in fill_cols})
    return filled.select(*observations.columns)


def _fill_chunks(rows: DataFrame, keys, chunk, order, fill_cols) -> DataFrame:
    """Fill inside each (keys, chunk), then from the chunks before.

    A chunk's key is one struct: its fields may be NULL while it is not, so that the window and the join agree on one
    partitioning of the rows. The last rows come from the same shuffle where every column is filled.
    """
    rows = rows.withColumn("_chunk", F.struct(*keys, *chunk)).drop(*keys, *chunk)
    inside = Window.partitionBy("_chunk").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns(
        {c: F.last(c, ignorenulls=True).over(so_far) for c in fill_cols} | {"_last": F.lead(F.lit(1)).over(inside).isNull()}
    )
    before = Window.partitionBy(*[F.col("_before")[k] for k in keys]).orderBy(*[F.col("_before")[c] for c in chunk])
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    left_behind = filled.where("_last").select(F.col("_chunk").alias("_before"), *fill_cols)
    carried = left_behind.select(
        "_before", *[F.last(c, ignorenulls=True).over(before).alias(f"_carried_{i}") for i, c in enumerate(fill_cols)]
    )
    joined = filled.join(carried, F.col("_chunk") == F.col("_before"), "left")
    of_chunk = {k: F.col("_chunk")[k] for k in keys}
    return joined.withColumns({c: F.coalesce(c, f"_carried_{i}") for i, c in enumerate(fill_cols)} | of_chunk)


def _day(rows: DataFrame, order_col: str) -> Column:
    """Day of a time. Moments are cut by UTC days, which follow each other in every session time zone."""
    if isinstance(rows.schema[order_col].dataType, T.TimestampType):
        return F.floor(F.unix_micros(order_col) / F.lit(86_400_000_000))
    return F.to_date(order_col)


def _longest(rows: DataFrame, keys: Sequence[str], order_col: str) -> tuple[int, int]:
    """Rows of the longest series and of the longest day of a series, counted in one pass over the key columns."""
    days = rows.groupBy(*keys, _day(rows, order_col).alias("_day")).agg(F.count("*").alias("_rows"))
    series = days.groupBy(*keys).agg(F.sum("_rows").alias("_rows"), F.max("_rows").alias("_day_rows"))
    longest = series.agg(F.max("_rows"), F.max("_day_rows")).first()
    return longest[0] or 0, longest[1] or 0


def _held(column: str, order_col: str, max_gap: str | None) -> Column:
    """The value together with the time it was read, so that its age is known wherever it is carried."""
    return F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("value"), F.col(order_col).alias("at")))


def add_slice(rows: DataFrame, groups: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """Number stretches of about ``max_rows`` rows within each group, along ``order``, in ``_slice``.

    Only oversized groups are cut. Their cut points are full order keys taken from a sample, which decides how even the
    slices are and nothing else: every row of a slice comes before every row of the next. Rows with equal keys share a
    slice, unless they are so many that several cut points fall on them: then they are dealt out over the slices
    between those cut points, where they are alone.
    """
    sizes = rows.groupBy(*groups).agg(F.count("*").alias("_rows"))
    large = materialise(sizes.where(F.col("_rows") > max_rows))
    n_slices, most_rows = large.agg(F.sum(F.ceil(F.col("_rows") / max_rows)), F.max("_rows")).first()
    if n_slices is None:
        return rows.withColumn("_slice", F.lit(0))

    # Slices get longer where needed, so that all cut points together stay within what may be broadcast.
    slice_rows = max_rows * max(1.0, n_slices / BROADCAST_ROWS)
    slices, most_cuts = F.ceil(F.col("_rows") / slice_rows).cast("int"), math.ceil(most_rows / slice_rows)
    large = small_side(large.withColumn("_slices", slices).where("_slices > 1").withColumnsRenamed(
        {c: f"_large_{c}" for c in groups}
    ))
    key = F.struct(*order)
    sampled = rows.join(large, same_keys(groups, "_large_")).where(
        F.rand(17) < F.col("_slices") * SAMPLES_PER_SLICE / F.col("_rows")
    )
    cuts = sampled.groupBy(*[F.col(c).alias(f"_cut_{c}") for c in groups], "_slices").agg(
        F.array_sort(F.collect_list(key)).alias("_sample")
    ).select(
        *[f"_cut_{c}" for c in groups],
        F.transform(
            F.sequence(F.lit(1), F.col("_slices") - 1),
            lambda i: F.get("_sample", F.floor(i * F.size("_sample") / F.col("_slices")).cast("int")),
        ).alias("_cuts"),
    )
    # The sample is random: written once, every pass over the rows sees the same cut points.
    cuts = small_side(
        materialise(cuts.withColumn("_repeats", F.size(F.array_distinct("_cuts")) < F.size("_cuts")))
    )
    below = cut_index(F.col("_cuts"), lambda cut: cut < F.col("_key"), most_cuts)
    up_to = cut_index(F.col("_cuts"), lambda cut: cut <= F.col("_key"), most_cuts)
    alone = up_to - below - 1
    # Copies are dealt by task: one that runs again deals them as before.
    dealt = F.when(alone > 0, below + 1 + F.pmod(F.spark_partition_id(), alone)).otherwise(below)
    slice_ = F.when(F.col("_cuts").isNull(), 0).when(F.col("_repeats"), dealt).otherwise(below)
    return (
        rows.withColumn("_key", key)
        .join(cuts, same_keys(groups, "_cut_"), "left")
        .select(*rows.columns, slice_.alias("_slice"))
    )


def cut_index(cuts: Column, holds, max_cuts: int = 4096) -> Column:
    """How many of the sorted ``cuts`` satisfy ``holds``, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max_cuts.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(
            (found + step <= F.size(cuts)) & holds(F.get(cuts, found + step - 1)), found + step
        ).otherwise(found),
    )
