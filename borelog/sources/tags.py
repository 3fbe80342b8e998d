"""The sensor dictionary and the long form of the observations."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from borelog.schema import SENSORS, TAG_DICTIONARY


def tag_dictionary(spark: SparkSession) -> DataFrame:
    """The fixed dimension: tag_id, tag, name, unit."""
    return spark.createDataFrame(TAG_DICTIONARY, "tag_id int, tag string, name string, unit string")


def tags_long(
    observations: DataFrame,
    tags: Sequence[str] = SENSORS,
    ids: Sequence[str] = ("well_number", "timestamp"),
) -> DataFrame:
    """One row per (observation, tag) with the tag's name and unit, NULL where the dictionary lacks the tag."""
    long = observations.unpivot(list(ids), list(tags), "tag", "value")
    return long.join(F.broadcast(tag_dictionary(observations.sparkSession)), "tag", "left")
