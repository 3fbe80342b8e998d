"""Which listed files to ingest, and what that comes to."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from borelog.sources.trees import list_files


def tree_listing(spark: SparkSession, root: str) -> DataFrame:
    """List the files under ``root`` in the shape of a ledger: name, subdir, path, size."""
    parts = F.split("path", "/")
    return list_files(spark, root).select(
        F.element_at(parts, -1).alias("name"),
        F.element_at(parts, -2).alias("subdir"),
        "path",
        "size",
    )


def _first(df: DataFrame, cap: int | None, *order) -> DataFrame:
    return df.orderBy(*order).limit(cap) if cap and cap > 0 else df


def ingest_manifest(
    listing: DataFrame, ledger: DataFrame, max_dirs: int | None = None, max_files: int | None = None
) -> DataFrame:
    """Select the Parquet files of the listed directories; ``is_new`` tells those absent from ``ledger``.

    Entries without ``subdir`` are the top level. ``max_dirs`` counts top-level entries of any type, by name, before
    directories are told from files; ``max_files`` counts files by (subdir, name) before known ones are left out.
    No cap, or one below 1, means all. ``ledger`` needs ``subdir`` and ``name``.
    """
    top = _first(listing.where(F.col("subdir").isNull()).select("name", "type"), max_dirs, "name")
    dirs = top.where(F.col("type") == "dir").select(F.col("name").alias("subdir")).distinct()
    files = listing.where((F.col("type") == "file") & F.col("name").endswith(".parquet")).join(
        dirs, "subdir", "left_semi"
    )
    chosen = _first(files, max_files, "subdir", "name").select("subdir", "name", "path", "download_url", "size")
    known = ledger.select("subdir", "name").distinct().withColumn("known", F.lit(True))
    return chosen.join(known, ["subdir", "name"], "left").select(
        *chosen.columns, F.col("known").isNull().alias("is_new")
    )


def new_files(manifest: DataFrame) -> DataFrame:
    return manifest.where("is_new").drop("is_new")


def ingest_report(manifest: DataFrame) -> DataFrame:
    """One row: files processed, skipped as known, new, and the bytes of the new ones."""
    new = F.col("is_new").cast("bigint")
    return manifest.agg(
        F.count("*").alias("processed_files"),
        F.coalesce(F.sum(1 - new), F.lit(0)).alias("skipped_files"),
        F.coalesce(F.sum(new), F.lit(0)).alias("new_files"),
        F.coalesce(F.sum(F.when(F.col("is_new"), F.col("size"))), F.lit(0)).alias("new_bytes"),
    )
