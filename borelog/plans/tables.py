"""From episode files to the observation table."""

from pyspark.sql import DataFrame, SparkSession

from borelog.functions.states import add_state_name
from borelog.operators.cleaning import clean
from borelog.operators.filling import forward_fill
from borelog.sources.episodes import normalise_episodes, read_episodes, read_raw_episodes, write_normalised
from borelog.sources.trees import read_tree, write_table


def process_tree(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Read, clean and name in one pass over the files: a scan with filters, no shuffle."""
    return add_state_name(clean(read_tree(spark, root, pattern)))


def normalise_tree(spark: SparkSession, raw_root: str, out: str, pattern: str = "*.parquet") -> None:
    """Rewrite a raw tree in the clean layout; ``streaming.ingest`` does so for new files only."""
    write_normalised(normalise_episodes(read_raw_episodes(spark, raw_root, pattern)), out)


def observations(spark: SparkSession, root: str, by_file: bool = False) -> DataFrame:
    """Cleaned and forward-filled observations of a normalised tree."""
    keys = ("well_number", "source_file") if by_file else ("well_number",)
    return forward_fill(clean(read_episodes(spark, root)), partition_cols=keys)


def build_table(
    spark: SparkSession, root: str, table: str | None = None, path: str | None = None, by_file: bool = False
) -> None:
    write_table(observations(spark, root, by_file), table, path)
