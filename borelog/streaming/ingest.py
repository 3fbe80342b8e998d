"""Incremental ingest: each run handles the files that earlier runs have not seen."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from borelog.sources.episodes import RAW_TYPES, normalise_episodes
from borelog.sources.footers import epoch_to_timestamp, time_unit


def stream_raw_episodes(
    spark: SparkSession, root: str, pattern: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Stream of raw rows with ``source_file``; ``max_files`` bounds the files of one micro-batch.

    A stream has one schema: times are scanned as the integers they are stored as, and the footer of a row's own file says
    their unit. A file that stores ``state`` as a real number, or times without a unit, fails the batch, which is never
    half-written; ``sources.ledger`` takes such files.
    """
    types = {c: T.LongType() if c in ("state", "timestamp") else kind for c, kind in RAW_TYPES.items()}
    reader = (
        spark.readStream.schema(T.StructType([T.StructField(c, kind) for c, kind in types.items()]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if max_files and max_files > 0:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(root).withColumn("source_file", F.col("_metadata.file_path"))
    unit = time_unit("source_file", F.lit("timestamp"))
    return rows.withColumn("timestamp", epoch_to_timestamp("timestamp", unit))


def ingest_new_files(
    spark: SparkSession, root: str, out: str, checkpoint: str, pattern: str = "*.parquet", max_files: int | None = None
) -> StreamingQuery:
    """Normalise the files that are new since the last run with this ``checkpoint``, then stop.

    The checkpoint is the ledger of files seen, and the sink commits whole batches, so a run that dies is simply
    started again. Output: files as ``sources.episodes.write_normalised`` lays them out, some per batch; each row keeps the
    path of its raw file.
    """
    episodes = normalise_episodes(stream_raw_episodes(spark, root, pattern, max_files))
    return (
        episodes.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
