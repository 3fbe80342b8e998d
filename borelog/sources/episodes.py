"""Raw episode files: any types and units of time in, one clean layout out."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from borelog.schema import EPISODE_SCHEMA, RAW_COLUMNS
from borelog.sources.footers import read_typed
from borelog.sources.trees import scan_tree, stored_schema


def declared_schema(sample: T.StructType, columns: Sequence[str]) -> T.StructType:
    """Schema to read ``columns`` with, whichever of them a single file has; a file that lacks one gives NULL.

    Sensors are doubles. ``state`` and ``timestamp`` are taken as stored, since the Parquet reader only widens types.
    """
    stored = {field.name: field.dataType for field in sample}
    special = {"timestamp": stored.get("timestamp", T.TimestampType()), "state": stored.get("state", T.LongType())}
    if isinstance(special["state"], T.IntegralType):
        special["state"] = T.LongType()
    return T.StructType([T.StructField(c, special.get(c, T.DoubleType())) for c in columns])


RAW_TYPES = {c: T.DoubleType() for c in RAW_COLUMNS} | {"state": T.LongType(), "timestamp": T.TimestampType()}


def raw_tree(
    spark: SparkSession, root: str, pattern: str = "*.parquet", epoch_unit: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of raw files that may differ in their types and units of time, and the files that cannot be read."""
    return read_typed(spark, root, RAW_TYPES, pattern, epoch_unit)


def read_raw_episodes(
    spark: SparkSession, root: str, pattern: str = "*.parquet", epoch_unit: str | None = None
) -> DataFrame:
    """``raw_tree`` for trees in which every file must be readable; raises ValueError with the first that is not."""
    rows, quarantine = raw_tree(spark, root, pattern, epoch_unit)
    bad = quarantine.orderBy("path").first()
    if bad is not None:
        raise ValueError(f"cannot read {bad.path}: {bad.reason}")
    return rows


def normalise_episodes(raw: DataFrame) -> DataFrame:
    """Keep the known columns and the labelled rows, with timestamps cut to the millisecond.

    ``source_file`` is kept when present; a known column that the files lack becomes NULL.
    """
    known = [F.col(c) if c in raw.columns else F.lit(None).cast("double").alias(c) for c in RAW_COLUMNS]
    source = [F.col("source_file")] if "source_file" in raw.columns else []
    kept = raw.select(*known, *source).dropna(subset=["state"])
    cut = F.date_trunc("millisecond", "timestamp").cast(raw.schema["timestamp"].dataType)
    return kept.withColumn("timestamp", cut)


def write_normalised(episodes: DataFrame, out: str, mirrored: bool = False) -> None:
    """Write files of even size, sorted by raw file and time; each row keeps the path of its raw file in ``source_file``.

    With ``mirrored`` there is one folder per episode as in the raw tree, ``subdir=<dir>/episode=<file name>/``, and the
    path of a file stands for ``source_file``. That takes a file per episode, however small.
    """
    if not mirrored:
        episodes.hint("rebalance").sortWithinPartitions("source_file", "timestamp").write.mode("overwrite").parquet(out)
        return
    parts = F.split("source_file", "/")
    (
        episodes.withColumn("subdir", F.element_at(parts, -2))
        .withColumn("episode", F.regexp_replace(F.element_at(parts, -1), r"\.parquet$", ""))
        .drop("source_file")
        .hint("rebalance", "subdir", "episode")
        .write.mode("overwrite")
        .partitionBy("subdir", "episode")
        .parquet(out)
    )


def read_episodes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Read normalised files, of either layout, with the declared columns and types, and ``source_file``."""
    sample = stored_schema(spark, root, pattern)
    schema = declared_schema(sample, EPISODE_SCHEMA.fieldNames())
    if "source_file" in sample.names:
        schema = schema.add("source_file", "string")
    stored = scan_tree(spark, root, pattern, schema)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EPISODE_SCHEMA], "source_file")
