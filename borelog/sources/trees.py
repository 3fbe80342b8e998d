"""Parquet trees and tables."""

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_tree(
    spark: SparkSession,
    root: str,
    pattern: str = "*.parquet",
    schema=None,
    merge_schema: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Read every Parquet file under ``root`` at any depth, in parallel, with its path in ``source_file``.

    With ``merge_schema`` the files are united by column name and a column that a file lacks is NULL.
    Filters on ``source_file`` prune whole files, because it is the scan's own metadata column, unless the rows bring
    their own from the file that they were first read from.
    """
    if schema is not None and list_files(spark, root, pattern).isEmpty():
        raise ValueError(f"no file under {root} matches {pattern}")
    return _with_source(_inferred(spark, root, pattern, schema, merge_schema, skip_corrupt))


def stored_schema(spark: SparkSession, root: str, pattern: str = "*.parquet") -> T.StructType:
    """Schema of the files under ``root`` as one of them has it; raises ValueError where no file matches."""
    return _inferred(spark, root, pattern).schema


def _inferred(spark, root, pattern, *options) -> DataFrame:
    try:
        return _scan(spark, root, pattern, *options)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no readable Parquet file under {root} matches {pattern}") from error
        raise


def scan_tree(
    spark: SparkSession, root: str, pattern: str, schema=None, merge_schema: bool = False, skip_corrupt: bool = False
) -> DataFrame:
    """``read_tree`` without its check that there is a file."""
    return _with_source(_scan(spark, root, pattern, schema, merge_schema, skip_corrupt))


def _scan(spark, root, pattern, schema=None, merge_schema=False, skip_corrupt=False) -> DataFrame:
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("mergeSchema", merge_schema)
        .option("ignoreCorruptFiles", skip_corrupt)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(str(root))


def _with_source(rows: DataFrame) -> DataFrame:
    """Where a row comes from: the file that it was first read from, if that is stored with it, or the file it is in."""
    path = F.col("_metadata.file_path")
    return rows.withColumn("source_file", F.coalesce("source_file", path) if "source_file" in rows.columns else path)


def scan_files(spark: SparkSession, paths: Sequence[str], schema) -> DataFrame:
    """The rows of some files, given by their paths as ``list_files`` names them."""
    literal = [re.sub(r"([\[\]{}*?,\\])", r"\\\1", path) for path in paths]
    reader = spark.read.option("recursiveFileLookup", True).schema(schema)
    return _with_source(reader.parquet(*literal))


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path and size of every file under ``root``; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(str(root))
        .select("path", F.col("length").alias("size"))
    )


def write_table(
    df: DataFrame, table: str | None = None, path: str | None = None, by_well: bool = True, buckets: int = 64
) -> None:
    """Overwrite a table or a Parquet folder, schema included.

    With ``by_well`` the wells are dealt to ``buckets`` by hash and the rows sorted by well and time within each file.
    The rebalance hint lets adaptive execution put small buckets into one task and split large ones over several, so the
    number of files follows the bytes, with at most one small file per bucket. A table of the catalog knows its buckets:
    a query on one well opens the files of one bucket only, and their footers say which parts hold the well. A folder
    without a table keeps the order, not the buckets.
    """
    writer = df.write
    if by_well:
        # Spark's own rule for the bucket of a row, so that rows of one bucket meet in the task that writes it.
        bucket = F.pmod(F.hash("well_number"), F.lit(buckets))
        sorted_by = ["well_number", *[c for c in ("timestamp",) if c in df.columns]]
        placed = df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *sorted_by)
        writer = placed.drop("_bucket").write
        if table is not None:
            writer = writer.bucketBy(buckets, "well_number").sortBy(*sorted_by)
    writer = writer.mode("overwrite").option("overwriteSchema", True)
    if table is None:
        writer.parquet(path)
    elif path is None:
        writer.saveAsTable(table)
    else:
        writer.option("path", path).saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
