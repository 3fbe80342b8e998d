"""Footers of Parquet files, read in tasks: which file holds which columns in which type, and which files cannot be read."""

import functools
import json
import re
from collections.abc import Mapping
from urllib.parse import unquote

import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from borelog.sources.trees import list_files, scan_files, scan_tree
from borelog.support import materialise

CATALOGUE = (
    "path string, size long, n_rows long, columns map<string, struct<physical: string, logical: string>>, error string"
)
# Names that Hadoop and Arrow give to the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "abfs": "abfs", "abfss": "abfss"}
UNITS = {"milliseconds": "ms", "microseconds": "us", "nanoseconds": "ns"}
PER_MILLI = {"ms": 1, "us": 1000, "ns": 1_000_000}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path as Spark names it, and the place in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem(), re.sub("^/+", "/", rest if colon else path)
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def _logical(column) -> str:
    """How a column is annotated: a unit of time, ``text``, ``integer`` and so on; empty without an annotation."""
    noted = json.loads(column.logical_type.to_json())
    kind = noted.get("Type", "None")
    if kind == "Timestamp":
        return UNITS[noted["timeUnit"]]
    if kind == "Int":
        return "int" if noted["isSigned"] else "unsigned"
    return "" if kind == "None" else kind.lower()


def _read(path: str) -> tuple:
    try:
        store, place = file_system(path)
        with store.open_input_file(place) as file:  # reads only the ranges asked for
            footer = pq.ParquetFile(file).metadata
            schema = footer.schema
            columns = {schema.column(i).path: (schema.column(i).physical_type, _logical(schema.column(i))) for i in range(len(schema))}
        return footer.num_rows, columns, None
    except Exception as error:  # whatever is wrong with a file is what its row says
        return None, None, f"{type(error).__name__}: {error}"[:500]


def _footers(batches):
    for batch in batches:
        read = [_read(path) for path in batch.path]
        yield pd.DataFrame({
            "path": batch.path, "size": batch["size"], "n_rows": pd.array([r[0] for r in read], "Int64"),
            "columns": pd.Series([None if r[1] is None else {k: {"physical": p, "logical": l} for k, (p, l) in r[1].items()} for r in read], dtype=object),
            "error": pd.Series([r[2] for r in read], dtype=object),
        })


def footer_catalogue(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file under ``root``: path, size, n_rows, columns (name to physical type and annotation) and error.

    The files are listed by Spark, the footers read by its tasks, a few kilobytes of each file. ``error`` says why a
    footer could not be read; such a file has no rows and no columns here. Spark lists no file without a byte.
    """
    return list_files(spark, root, pattern).mapInPandas(_footers, CATALOGUE)


def unreadable(catalogue: DataFrame) -> DataFrame:
    """The quarantine list of a catalogue: path, size and reason of every file whose footer cannot be read."""
    return catalogue.where("error IS NOT NULL").select("path", "size", F.col("error").alias("reason"))


def _way(stored: tuple[str, str] | None, kind: T.DataType, epoch_unit: str | None) -> str | None:
    """How to scan a column as ``kind``: ``epoch:<unit>``, ``timestamp``, ``bigint`` or ``double``; None if there is no right way.

    A column that a file lacks is scanned like most of its kind, and gives NULL.
    """
    physical, logical = stored or (None, None)
    if isinstance(kind, T.TimestampType):
        if logical in PER_MILLI:
            return f"epoch:{logical}"
        if physical == "INT64" and logical == "" and epoch_unit is not None:
            return f"epoch:{epoch_unit}"
        return "timestamp" if physical == "INT96" else "epoch:us" if stored is None else None
    if stored is None:
        return "bigint" if isinstance(kind, T.IntegralType) else "double"
    # An annotation other than that of a signed integer changes what the number means.
    return {"INT32": "bigint", "INT64": "bigint", "FLOAT": "double", "DOUBLE": "double"}.get(physical) if logical in ("", "int") else None


def _ways(types: Mapping[str, T.DataType], epoch_unit: str | None):
    def decide(path):
        _, columns, error = _read(path)
        if error:
            return None, error
        ways = {name: _way(columns.get(name), kind, epoch_unit) for name, kind in types.items()}
        problems = [" ".join([name, "is stored as", *filter(None, columns[name])]) for name, way in ways.items() if way is None]
        return (None, "; ".join(problems)) if problems else (list(ways.values()), None)

    def read(batches):
        for batch in batches:
            decided = [decide(path) for path in batch.path]
            yield pd.DataFrame({
                "path": batch.path, "size": batch["size"], "ways": pd.Series([d[0] for d in decided], dtype=object),
                "reason": pd.Series([d[1] for d in decided], dtype=object),
            })

    return read


def epoch_to_timestamp(column: str, unit: str | Column) -> Column:
    """Timestamp, cut to the millisecond, of a count of ``unit`` (``ms``, ``us`` or ``ns``) since 1970."""
    units = F.create_map(*[F.lit(x) for pair in PER_MILLI.items() for x in pair])
    per_milli = F.lit(PER_MILLI[unit]) if isinstance(unit, str) else F.element_at(units, unit)
    # Less its remainder, so that times before 1970 are cut downwards too.
    return F.timestamp_millis(F.call_function("div", F.col(column) - F.pmod(F.col(column), per_milli), per_milli))


_SCANNED = {"bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def read_typed(
    spark: SparkSession, root: str, types: Mapping[str, T.DataType], pattern: str = "*.parquet", epoch_unit: str | None = None,
    files: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of a tree whose files store the same columns in different types, and the files that cannot be read.

    The rows have the columns of ``types`` (whole numbers, doubles or timestamps) and ``source_file``. The footers say how
    each file stores them: integers or reals of 32 or 64 bits, times in any unit, cut to the millisecond. Files that are
    stored alike are scanned together, one scan per way of storing. A time without an annotation is read with
    ``epoch_unit``; without that, or if a type does not fit, the file is in the second table (path, size, reason) and
    none of its rows is in the first. A column that a file lacks is NULL; a real number stands for a whole one only if it
    is one, NaN is NULL there. Raises ValueError where no file matches. With ``files`` (path, size) only these are read.

    The paths of a way pass through the driver, as the listing of any tree does.
    """
    listed = list_files(spark, root, pattern) if files is None else files.select("path", "size")
    decided = listed.mapInPandas(
        _ways(types, epoch_unit), "path string, size long, ways array<string>, reason string"
    )
    catalogue = materialise(decided)
    quarantine = catalogue.where("reason IS NOT NULL").select("path", "size", "reason")
    readable = catalogue.where("reason IS NULL")
    kinds = [row.ways for row in readable.select("ways").distinct().orderBy("ways").collect()]
    if not kinds and catalogue.isEmpty():
        raise ValueError(f"no file under {root} matches {pattern}")
    one_way = files is None and len(kinds) == 1 and quarantine.isEmpty()
    parts = []
    for kind in kinds:
        how = dict(zip(types, kind))
        schema = T.StructType([T.StructField(name, _SCANNED.get(way, T.LongType())) for name, way in how.items()])
        if one_way:
            scanned = scan_tree(spark, root, pattern, schema)
        else:
            paths = readable.where(F.col("ways") == F.array(*map(F.lit, kind))).select("path").collect()
            scanned = scan_files(spark, [row.path for row in paths], schema)
        parts.append(scanned.select(*[_as_wanted(name, how[name], wanted).alias(name) for name, wanted in types.items()], "source_file"))
    if not parts:
        schema = T.StructType([T.StructField(name, kind) for name, kind in types.items()]).add("source_file", "string")
        return spark.createDataFrame([], schema), quarantine
    return functools.reduce(DataFrame.unionByName, parts), quarantine


def _as_wanted(name: str, way: str, wanted: T.DataType) -> Column:
    if way.startswith("epoch:"):
        return epoch_to_timestamp(name, way.removeprefix("epoch:"))
    if way == "timestamp":
        return F.date_trunc("millisecond", name)
    if way == "double" and isinstance(wanted, T.IntegralType):
        value = F.nanvl(name, F.lit(None).cast("double"))
        broken = F.raise_error(F.concat(F.lit(f"{name} holds "), value.cast("string"), F.lit(", not a whole number")))
        return F.when(value.isNull() | (value == F.floor(value)), value.cast(wanted)).otherwise(broken.cast(wanted))
    return F.col(name).cast(wanted)


def read_readable(
    spark: SparkSession, root: str, pattern: str = "*.parquet", schema=None, merge_schema: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``read_tree`` without the files whose footers cannot be read, and those files (path, size, reason).

    Only the list of bad files passes through the driver; the filter on their paths keeps the scan from opening them.
    """
    catalogue = materialise(footer_catalogue(spark, root, pattern))
    bad = unreadable(catalogue)
    if catalogue.where("error IS NULL").isEmpty():
        raise ValueError(f"no readable Parquet file under {root} matches {pattern}")
    if schema is None:
        schema = scan_tree(spark, root, pattern, None, merge_schema, skip_corrupt=True).drop("source_file").schema
    rows = scan_tree(spark, root, pattern, schema)
    paths = [spark._jvm.org.apache.hadoop.fs.Path(row.path).toUri().toString() for row in bad.select("path").collect()]
    return rows.where(~F.col("_metadata.file_path").isin(paths)) if paths else rows, bad


@F.pandas_udf(T.StringType())
def time_unit(source_file: pd.Series, column: pd.Series) -> pd.Series:
    """Unit of a column of times in the file that a row comes from, by its footer, which a worker reads once."""
    return pd.Series([_unit(*pair) for pair in zip(source_file, column)], dtype=object)


@functools.lru_cache(maxsize=1024)
def _unit(source_file: str, column: str) -> str:
    _, columns, error = _read(unquote(source_file))
    unit = "" if error else columns.get(column, ("", ""))[1]
    if unit not in PER_MILLI:
        raise ValueError(f"{source_file}: {error or f'{column} has no unit of time'}")
    return unit
