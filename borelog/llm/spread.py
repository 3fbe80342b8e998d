"""Joins on a key that may be that of a third of all rows."""

from pyspark.sql import DataFrame, functions as F

# A key with more rows than this share of all, of which there can be no more than this many, is broadcast.
HOT_KEYS, HOT_ROWS = 100_000, 1_000


def spread_join(rows: DataFrame, table: DataFrame, key: str, n_rows: int, held: str = "held", left: bool = False) -> DataFrame:
    """``rows`` joined to ``table``, which has one row per ``key`` and says in ``held`` how many of the rows have it.

    Keys with over a 100,000th of all ``n_rows`` rows are 100,000 at most and are broadcast, so that their rows stay where
    they are; the rows of the others are shuffled. With ``left`` rows without a match stay, with NULLs. ``table`` is read
    twice: it should be a written one.
    """
    limit = max(HOT_ROWS, n_rows // HOT_KEYS)
    hot = F.broadcast(table.where(F.col(held) > limit))
    rare = table.where(F.col(held) <= limit)
    cold = rows.join(hot.select(key), key, "left_anti").join(rare, key, "left" if left else "inner")
    return rows.join(hot, key).unionByName(cold)
