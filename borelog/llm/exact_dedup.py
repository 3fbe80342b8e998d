"""Exact dedup over an extendible-hash index on shared files, in DataFrame operations only.

Every text has a 64-bit key. A directory of key prefixes says which bucket owns a key: it starts with one bucket, and
where a bucket holds more keys than its capacity the directory doubles and the bucket splits by the next bit. Texts are
sent to the owner of their bucket, a range of keys. The owner compares them byte by byte and chains the different texts
that share a key. Copies of texts that fill much of the table are merged in the scanning tasks before they are sent.
"""

import math

from pyspark.sql import DataFrame, functions as F

from borelog.llm.spread import HOT_KEYS, spread_join
from borelog.support import materialise

DOC = "doc_id"

# A bucket of the default capacity is some megabytes of texts, small beside a task's share. Beyond this many buckets they grow instead, so
# that the directory, which every task holds, has 16 times as many addresses at most: two million rows of three numbers.
CAPACITY, MAX_BUCKETS = 1024, 1 << 17
# Copies of one text that weigh less than this need no merging on the way.
HOT_BYTES, ROW_BYTES = 4 << 20, 64


def keyed(docs: DataFrame) -> DataFrame:
    """Number, text (NULL counts as empty) and 64-bit key of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(DOC), text.alias("text")).withColumn("key", F.xxhash64("text"))


def directory(keys: DataFrame, n_keys: int, capacity: int) -> DataFrame:
    """The buckets of distinct ``keys``: rows (depth, prefix, held), at most ``capacity`` keys in each.

    Keys are counted once in cells finer than any bucket needs to be; the counts of all coarser prefixes come from the
    cells. A prefix is a bucket if it is not overfull and its parent is. The directory has as many rows as buckets.
    """
    depth = max(1, math.ceil(math.log2(max(1, n_keys / capacity))) + 4)
    cells = keys.select(F.shiftrightunsigned("key", 64 - depth).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    prefixes = (
        cells.select("n", "cell", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
        .select("n", "depth", F.expr(f"shiftrightunsigned(cell, {depth} - depth)").alias("prefix"))
        .groupBy("depth", "prefix").agg(F.sum("n").alias("held"))
    )
    overfull = prefixes.where(F.col("held") > capacity).select(
        (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
    )
    fits = (F.col("held") <= capacity) | (F.col("depth") == depth)
    return prefixes.where(fits & (F.col("depth") == 0)).unionByName(prefixes.where(fits).join(overfull, ["depth", "prefix"]))


def addresses(buckets: DataFrame, depth: int) -> DataFrame:
    """The directory at full size: the bucket (depth, prefix) of each address, the first ``depth`` bits of a key."""
    span = F.expr(f"shiftleft(1L, {depth} - depth)")
    first = F.col("prefix") * span
    return buckets.select("depth", "prefix", F.explode(F.sequence(first, first + span - 1)).alias("address"))


def merged_texts(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (key, text, keep_id, group_size), in which all copies of a hot text are one.

    A key is hot if its rows weigh over a 100,000th of the table, which holds for 100,000 keys at most. Others stay as they are.
    """
    total = keys.agg(F.sum("weight")).first()[0] or 0
    hot = F.broadcast(keys.where((F.col("n") > 1) & (F.col("weight") > max(HOT_BYTES, total // HOT_KEYS))).select("key"))
    alone = rows.join(hot, "key", "left_anti").select("key", "text", F.col(DOC).alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    copies = rows.join(hot, "key").groupBy("key", "text").agg(F.max(DOC).alias("keep_id"), F.count("*").alias("group_size"))
    return alone.unionByName(copies)


def routed(texts: DataFrame, buckets: DataFrame) -> DataFrame:
    """``texts`` with the bucket of their key, each bucket whole in the one task that owns it."""
    depth = max(1, buckets.agg(F.max("depth")).first()[0] or 0)
    found = texts.withColumn("address", F.shiftrightunsigned("key", 64 - depth))
    return found.join(F.broadcast(addresses(buckets, depth)), "address").drop("address").repartition("depth", "prefix")


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The index of all texts that occur more than once: rows (depth, prefix, key, held, chain).

    ``held`` counts the key's rows. ``chain`` has one entry (text_sha256, keep_id, group_size) for each different text with that key; a key of a single
    row gets none. Texts are compared whole by the task that owns their bucket. The index is written to the shared folder.
    """
    rows = keyed(docs)
    weight = F.sum(F.octet_length("text").cast("long") + ROW_BYTES)
    keys = materialise(rows.groupBy("key").agg(F.count("*").alias("n"), weight.alias("weight")))
    n_keys = keys.count()
    buckets = materialise(directory(keys, n_keys, max(capacity, math.ceil(n_keys / MAX_BUCKETS))).drop("held"))
    texts = routed(merged_texts(rows, keys), buckets)
    # Both groupings stay within the owner: a bucket's rows are in one task already.
    texts = texts.groupBy("depth", "prefix", "key", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    link = F.struct(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    chains = texts.select("depth", "prefix", "key", "group_size", link.alias("link")).groupBy("depth", "prefix", "key")
    chains = chains.agg(F.sum("group_size").alias("held"), F.array_sort(F.collect_list("link")).alias("chain"))
    return materialise(chains.where("held > 1"))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a NULL text is an empty one. Of equal texts the largest doc_id stays. A NULL doc_id
    stays only where no equal text has a number. Rows that repeat doc_id and text are the same document: each of them is
    counted in group_size and has the same ``kept``. An empty table gives an empty result; other columns are ignored.
    """
    chains = build_index(docs, capacity).select("key", "chain", "held")
    rows = keyed(docs).select(DOC, "key", F.sha2("text", 256).alias("text_sha256"))
    link = F.get(F.filter("chain", lambda c: c["text_sha256"] == F.col("text_sha256")), F.lit(0))
    found = spread_join(rows, chains, "key", docs.count(), left=True).withColumn("link", link)
    keep = F.when(F.col("link").isNull(), F.col(DOC)).otherwise(F.col("link.keep_id"))
    return found.select(
        DOC, keep.alias("keep_id"), F.coalesce("link.group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col(DOC).eqNullSafe(keep).alias("kept"), "text_sha256",
    )
