"""One-pass aggregates; all combine inside the scanning task before the shuffle."""

from pyspark.sql import DataFrame, functions as F

from borelog.functions.states import state_name
from borelog.operators.cleaning import for_well
from borelog.schema import ALL_WELLS


def null_census(rows: DataFrame) -> DataFrame:
    """One row: how many NULLs each column has. NaN is a value. No input rows give NULL."""
    size = F.nullif(F.count("*"), F.lit(0))
    return rows.agg(*[(size - F.count(F.col(f"`{c}`"))).alias(c) for c in rows.columns])


def well_failure_counts(observations: DataFrame, well: int = ALL_WELLS) -> DataFrame:
    """Rows per well and state code; codes without a name have a NULL ``failure_type``, one row each."""
    counts = for_well(observations, well).groupBy("well_number", "state").agg(F.count("*").alias("failure_count"))
    return counts.select("well_number", state_name("state").alias("failure_type"), "failure_count")


def well_time_bounds(observations: DataFrame, well: int = ALL_WELLS) -> DataFrame:
    return for_well(observations, well).groupBy("well_number").agg(
        F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp")
    )


def profile(observations: DataFrame) -> DataFrame:
    """One row: size, wells, classes and time range. Distinct counts run on the (well, state) groups, not on the rows."""
    groups = observations.groupBy("well_number", "state").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(observations.columns)).alias("n_columns"),
        F.countDistinct("well_number").alias("n_wells"),
        F.countDistinct("state").alias("n_states"),
        F.min("first").alias("min_timestamp"),
        F.max("last").alias("max_timestamp"),
    )
