"""Sorting, top lists, row ranges and repeatable samples."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def sort_series(observations: DataFrame) -> DataFrame:
    """Sort by well and time. Range partitioning splits a long well, or many rows of one time, over several tasks."""
    return observations.orderBy("well_number", "timestamp", F.xxhash64(*observations.columns))


def top_k(rows: DataFrame, column: str, k: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest values."""
    return rows.orderBy(F.desc_nulls_last(column), *tie_break).limit(k)


def row_range(rows: DataFrame, start: int, stop: int, *order) -> DataFrame:
    """Rows ``start`` to ``stop - 1``, counted from 0 along ``order``."""
    return rows.orderBy(*order).offset(start).limit(stop - start)


def seeded_key(rows: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """A hash of the key columns that is the same in every run, session time zone and SQL engine.

    Moments count as microseconds since 1970; NULL has a mark of its own, so it is not confused with a missing column.
    """

    def text(column):
        moment = isinstance(rows.schema[column].dataType, T.TimestampType)
        value = F.unix_micros(column) if moment else F.col(column)
        return F.coalesce(value.cast("string"), F.lit("\\N"))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *map(text, keys)))


def seeded_sample(rows: DataFrame, keys: Sequence[str], n: int = 5, seed: int = 42) -> DataFrame:
    """``n`` rows picked by a hash of their keys."""
    return rows.orderBy(seeded_key(rows, keys, seed), *keys).limit(n)
