"""Basic features of every sensor series."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from borelog.schema import MODEL_TAGS
from borelog.support import materialise, same_keys, small_side

# Digits of a 64-bit number, from the left, that one round of the median's search counts. A series and tag has at most
# two to that power different ones.
DIGIT_BITS = (22, 21, 21)


def series_features(
    observations: DataFrame,
    tags: Sequence[str] = MODEL_TAGS,
    by: Sequence[str] = ("well_number",),
    max_series_rows: int = 100_000,
) -> DataFrame:
    """Sum, mean, median, length, spread, RMS and extremes per series and tag, one row each; NULLs do not count.

    One aggregation of the rows as they are takes everything but the medians of series with more than
    ``max_series_rows`` rows, for which the built-in median would hold all values in one task. Those are found digit by
    digit: numbers are counted by the leading bits of their ordered form, in the tasks that read them, then by the next
    bits where the middle ranks lie. Exact; NaN is the largest number, as in Spark's own order.
    """
    sizes = observations.groupBy(*by).agg(F.count("*").alias("_rows"))
    long = materialise(sizes.where(F.col("_rows") > max_series_rows).select(*by, F.monotonically_increasing_id().alias("_sid")))
    if long.isEmpty():
        return _summary(observations, tags, by, lambda tag: F.median(tag))
    rows = _with_series(observations.select(*by, *tags), long, by)
    summary = _summary(rows, tags, by, lambda tag: F.median(F.when(F.col("_sid").isNull(), F.col(tag))))
    medians = _long_medians(observations, tags, by, long)
    found = summary.join(medians, same_keys([*by, "tag"], "_"), "left")
    return found.select(*[F.coalesce("median", "_median").alias("median") if c == "median" else c for c in summary.columns])


def _summary(rows: DataFrame, tags, by, median) -> DataFrame:
    """One wide row per series, then a row per tag."""

    def features(tag: str) -> Column:
        value = F.col(tag).cast("double")
        return F.struct(
            F.lit(tag).alias("tag"), F.sum(value).alias("sum_values"), median(tag).alias("median"), F.avg(value).alias("mean"),
            F.count(value).alias("length"), F.stddev_pop(value).alias("standard_deviation"), F.var_pop(value).alias("variance"),
            F.sqrt(F.avg(value * value)).alias("root_mean_square"), F.max(value).alias("maximum"),
            F.max(F.abs(value)).alias("absolute_maximum"), F.min(value).alias("minimum"),
        )

    wide = rows.groupBy(*by).agg(F.array(*[features(tag) for tag in tags]).alias("_features"))
    return wide.select(*by, F.inline("_features"))


def _with_series(rows: DataFrame, series: DataFrame, by, how: str = "left") -> DataFrame:
    """Rows with the columns of ``series``, of which there is one row per long series."""
    named = series.withColumnsRenamed({c: f"_{c}" for c in by})
    return rows.join(small_side(named), same_keys(by, "_"), how).drop(*[f"_{c}" for c in by])


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Doubles as 64-bit whole numbers in the same order; -0.0 is 0.0 and every NaN the same, largest number."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def from_ordered_bits(bits: np.ndarray) -> np.ndarray:
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(np.float64)


def _long_medians(observations: DataFrame, tags, by, long: DataFrame) -> DataFrame:
    """Keys of the long series with a ``_`` before their names, ``_tag`` and ``_median``."""
    places, targets, left = long, None, 64
    for bits in DIGIT_BITS:
        left -= bits
        rows = _with_series(observations.select(*by, *[F.col(t).cast("double").alias(f"v{i}") for i, t in enumerate(tags)]), places, by, "inner")
        counted = rows.drop(*by).mapInArrow(_count_heads(len(tags), left, bits, targets is not None), "_sid long, _at int, _head long, _n long")
        targets = materialise(_narrow(counted.groupBy("_sid", "_at", "_head").agg(F.sum("_n").alias("_n")), targets, bits))
        heads = [
            F.max(F.when((F.col("_at") == i) & (F.col("_upper") == upper), F.col("_head"))).alias(f"{'hi' if upper else 'lo'}{i}")
            for i in range(len(tags)) for upper in (False, True)
        ]
        places = long.join(targets.groupBy("_sid").agg(*heads), "_sid")
    middles = targets.groupBy("_sid", "_at").agg(
        F.max(F.when(~F.col("_upper"), F.col("_head"))).alias("_low"), F.max(F.when(F.col("_upper"), F.col("_head"))).alias("_high")
    )
    medians = long.join(middles.mapInArrow(_as_medians, "_sid long, _at int, _median double"), "_sid")
    tag = F.get(F.array(*map(F.lit, tags)), F.col("_at"))
    return medians.select(*[F.col(c).alias(f"_{c}") for c in by], tag.alias("_tag"), "_median")


def _count_heads(n_tags: int, shift: int, bits: int, narrowed: bool):
    """How often each head (the bits above ``shift``) occurs among the values whose head of the round before is wanted."""

    def count(batches):
        for batch in batches:
            sid = batch["_sid"].to_numpy()
            for i in range(n_tags):
                column = batch[f"v{i}"]
                chosen = column.is_valid().to_numpy(zero_copy_only=False)
                heads = ordered_bits(column.fill_null(0.0).to_numpy()) >> np.int64(shift)
                if narrowed:
                    low, high = (batch[f"{side}{i}"].fill_null(0).to_numpy() for side in ("lo", "hi"))
                    before = heads >> np.int64(bits)
                    chosen &= (before == low) | (before == high)
                counts = pd.DataFrame({"sid": sid[chosen], "head": heads[chosen]}).value_counts(sort=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts.index.get_level_values(0).to_numpy(np.int64)), pa.array(np.full(len(counts), i, np.int32)),
                     pa.array(counts.index.get_level_values(1).to_numpy(np.int64)), pa.array(counts.to_numpy(np.int64))],
                    ["_sid", "_at", "_head", "_n"],
                )

    return count


def _narrow(counted: DataFrame, targets: DataFrame | None, bits: int) -> DataFrame:
    """The heads that hold the lower and the upper middle rank of each series and tag, and the ranks within them."""
    group = Window.partitionBy("_sid", "_at")
    if targets is None:
        total = F.sum("_n").over(group)
        ranks = counted.withColumns({"_lower_rank": F.call_function("div", total + 1, F.lit(2)), "_upper_rank": F.call_function("div", total, F.lit(2)) + 1})
        sides = F.explode(F.array(*[F.struct(F.lit(u).alias("upper"), F.col(r).alias("rank")) for u, r in ((False, "_lower_rank"), (True, "_upper_rank"))]))
        wanted = ranks.withColumn("_side", sides).select("_sid", "_at", "_head", "_n", F.col("_side.upper").alias("_upper"), F.col("_side.rank").alias("_rank"))
    else:
        before = targets.select("_sid", "_at", F.col("_head").alias("_prefix"), "_upper", "_rank")
        wanted = counted.join(before, ["_sid", "_at"]).where(F.shiftright("_head", bits) == F.col("_prefix"))
    upto = F.sum("_n").over(Window.partitionBy("_sid", "_at", "_upper").orderBy("_head"))
    found = wanted.withColumn("_upto", upto).where((F.col("_upto") - F.col("_n") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    return found.select("_sid", "_at", "_head", "_upper", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"))


def _as_medians(batches):
    for batch in batches:
        lows, highs = batch["_low"].to_numpy(), batch["_high"].to_numpy()
        low, high = from_ordered_bits(lows), from_ordered_bits(highs)
        with np.errstate(all="ignore"):
            median = np.where(lows == highs, low, low * 0.5 + high * 0.5)
        # Through Arrow: pandas would turn NaN into NULL.
        yield pa.RecordBatch.from_arrays([batch["_sid"], batch["_at"], pa.array(median)], ["_sid", "_at", "_median"])
