"""Provenance, validity and parameter filters. Nothing here shuffles."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from borelog.schema import ALL_WELLS, DRAWN_MARK, MODEL_FEATURES, SIMULATED_MARK, TRAINING_WELLS, WELL_PATTERN


def add_provenance(observations: DataFrame) -> DataFrame:
    """Add ``is_drawn``, ``is_simulated`` and ``well_number``, all read off ``source_file``.

    A path without a well number gives NULL.
    """
    path = F.col("source_file")
    return observations.withColumns({
        "is_drawn": path.contains(DRAWN_MARK),
        "is_simulated": path.contains(SIMULATED_MARK),
        "well_number": F.regexp_extract(path, WELL_PATTERN, 1).try_cast("int"),
    })


def keep_valid(observations: DataFrame, drop_synthetic: bool = True) -> DataFrame:
    """Keep labelled, timed rows and, unless told otherwise, only those measured in a real well."""
    valid = F.col("state").isNotNull() & F.col("timestamp").isNotNull()
    if drop_synthetic:
        valid = valid & ~F.col("is_drawn") & ~F.col("is_simulated")
    return observations.where(valid)


def clean(observations: DataFrame, drop_synthetic: bool = True) -> DataFrame:
    return keep_valid(add_provenance(observations), drop_synthetic)


def in_wells(observations: DataFrame, wells: Sequence[int] = TRAINING_WELLS) -> DataFrame:
    return observations.where(F.col("well_number").isin(list(wells)))


def for_well(observations: DataFrame, well: int = ALL_WELLS) -> DataFrame:
    """Rows of one well; -1 means all, rows without a well number included."""
    return observations if well == ALL_WELLS else observations.where(F.col("well_number") == well)


def model_columns(observations: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Index, features and target of the state classifier."""
    index = [c for c in ("timestamp", "well_number") if c not in features]
    return observations.select(*index, *features, "state")
