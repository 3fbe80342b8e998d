"""Ingest with a ledger that commits: which files were taken up, in which batch, and whether the batch was finished."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from borelog.schema import EPISODE_SCHEMA
from borelog.sources.episodes import RAW_TYPES, normalise_episodes
from borelog.sources.footers import read_typed
from borelog.sources.manifest import tree_listing
from borelog.support import folder_exists, materialise

FILES = "batch string, path string, name string, subdir string, size long, reason string"
COMMITS = "batch string, n_files long, committed_at timestamp"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Every file that a batch took up: batch, path, name, subdir, size, reason and ``state``.

    ``done`` files are in the table, ``unreadable`` ones are not, for the ``reason`` given; files of a batch that has not
    finished, or died, are ``started``.
    """
    files, commits = _read(spark, f"{ledger}/files", FILES), _read(spark, f"{ledger}/commits", COMMITS)
    finished = commits.select("batch").distinct().withColumn("finished", F.lit(True))
    state = F.when(F.col("finished").isNull(), "started").when(F.col("reason").isNull(), "done").otherwise("unreadable")
    return files.join(finished, "batch", "left").select(*files.columns, state.alias("state"))


def new_listing(spark: SparkSession, root: str, ledger: str, pattern: str = "*.parquet", max_files: int | None = None) -> DataFrame:
    """Files under ``root`` that no finished batch took up in their present size, the first ``max_files`` by path."""
    listed = tree_listing(spark, root).where(F.regexp_like("name", F.lit(_as_expression(pattern))))
    known = read_ledger(spark, ledger).where("state <> 'started'").select("path", "size")
    files = listed.join(known, ["path", "size"], "left_anti")
    return files.orderBy("path").limit(max_files) if max_files and max_files > 0 else files


def _as_expression(pattern: str) -> str:
    wild = {"*": ".*", "?": "."}
    return "^" + "".join(wild.get(c, c if c.isalnum() else f"\\{c}") for c in pattern) + "$"


def ingest(
    spark: SparkSession, root: str, out: str, ledger: str, pattern: str = "*.parquet", max_files: int | None = None,
    epoch_unit: str | None = None,
) -> str | None:
    """Normalise the new files under ``root`` into a batch of their own below ``out``; its name, or None without new files.

    The files are noted before they are read, each with the reason if it cannot be, and the batch is committed by one row
    after its rows are written. A run that dies in between leaves files noted as ``started`` and rows that ``read_ingested``
    does not read; the next run takes these files up again. One run at a time.
    """
    batch = f"{spark.sql('SELECT current_timestamp()').first()[0]:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    # Written first: what is noted is what is read, whatever arrives in the meantime.
    new = materialise(new_listing(spark, root, ledger, pattern, max_files))
    if new.isEmpty():
        return None
    rows, bad = read_typed(spark, root, RAW_TYPES, epoch_unit=epoch_unit, files=new)
    noted = new.join(bad.select("path", "reason"), "path", "left")
    noted.select(F.lit(batch).alias("batch"), "path", "name", "subdir", "size", "reason").write.mode("append").parquet(f"{ledger}/files")
    write_batch(normalise_episodes(rows), f"{out}/batch={batch}")
    commit = new.agg(F.lit(batch).alias("batch"), F.count("*").alias("n_files"), F.current_timestamp().alias("committed_at"))
    commit.coalesce(1).write.mode("append").parquet(f"{ledger}/commits")
    return batch


def write_batch(episodes: DataFrame, folder: str) -> None:
    """Rows of a batch in files of even size, sorted so that their footers tell where a file's rows are."""
    episodes.hint("rebalance").sortWithinPartitions("source_file", "timestamp").write.parquet(folder)


def read_ingested(spark: SparkSession, out: str, ledger: str) -> DataFrame:
    """The rows of all finished batches: the declared columns and types, and the raw file of each row as ``source_file``."""
    commits = _read(spark, f"{ledger}/commits", COMMITS).select("batch").distinct().collect()
    stored = T.StructType([T.StructField(c, kind) for c, kind in RAW_TYPES.items()]).add("source_file", "string")
    if commits:
        rows = spark.read.schema(stored).parquet(*[f"{out}/batch={row.batch}" for row in commits])
    else:
        rows = spark.createDataFrame([], stored)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EPISODE_SCHEMA], "source_file")
