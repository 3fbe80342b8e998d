"""Incremental, reversible line dedup: exact reference counts behind sharded cuckoo filters.

The index lives in a folder and outlives the process. The space of line keys is cut into shards. A shard has a table of
counts (key, smallest document, number of documents), the references (key, document) behind them, and a cuckoo filter with
one fingerprint per key. A batch asks the filters first: a key that they do not know gets a count of its own at once, and
only the others are looked up in the shards that the batch touches. Which lines go is read off the counts. Cuckoo filters
can forget, so documents can be taken out again: counts go down, a key that loses its smallest document gets the next one,
and one that nobody holds leaves its filter.
"""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.support import folder_exists, materialise, scratch_folder

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = 2**63 - 1
SLOTS = 4
LOAD = 0.8


def _key(line):
    """Digest of a line's key in SQL, NULL if the key is short; ``_python_key`` is the same in Python."""
    key = F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)
    return lambda least: F.when(F.char_length(key) >= least, F.substring(F.sha2(key, 256), 1, 32))


def _python_key(line: str, least: int) -> str | None:
    line = line.strip(SPACE)
    return hashlib.sha256(line.encode().lower()).hexdigest()[:32] if len(line) >= least else None


def _ids():
    return F.coalesce("doc_id", F.lit(NO_ID)).alias("id")


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """Rows (key, id): each row's distinct keys of at least ``least`` code points."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    keys = F.array_compact(F.array_distinct(F.transform(lines, lambda line: _key(line)(least))))
    rows = docs.select(_ids(), F.explode(keys).alias("key"))
    return rows.select(F.unhex("key").alias("key"), "id")


# --- cuckoo filters -------------------------------------------------------------------------------------------------


def _places(keys, n_buckets: int):
    """Fingerprint (1 to 65535) and first bucket of each 16-byte key; ``n_buckets`` is a power of two."""
    words = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    fingerprint = (words[:, 1] % 65535 + 1).astype(np.uint32)
    return fingerprint, ((words[:, 0] >> np.uint64(20)) & np.uint64(n_buckets - 1)).astype(np.uint32)


def _other(bucket, fingerprint, n_buckets: int):
    return (bucket ^ (fingerprint * np.uint32(0x5BD1E995))) & np.uint32(n_buckets - 1)


def _grown(n_keys: int) -> int:
    return 1 << max(1, math.ceil(math.log2(max(1, n_keys) / (SLOTS * LOAD))))


def _insert(table, fingerprint, bucket) -> bool:
    """Put all fingerprints into ``table`` (buckets x slots), many at once; False if they do not fit."""
    n_buckets, random = len(table), np.random.default_rng(len(fingerprint))
    for _ in range(500):
        if not len(fingerprint):
            return True
        order = np.argsort(bucket, kind="stable")
        fingerprint, bucket = fingerprint[order], bucket[order]
        first = np.r_[True, bucket[1:] != bucket[:-1]]
        rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(first, np.arange(len(bucket)), 0))
        free = table[bucket] == 0
        fits = rank < free.sum(axis=1)
        slot = np.argmax((np.cumsum(free, axis=1) == rank[:, None] + 1) & free, axis=1)
        table[bucket[fits], slot[fits]] = fingerprint[fits]
        fingerprint, bucket, first = fingerprint[~fits], bucket[~fits], (rank == 0)[~fits]
        kicks = first | np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)]
        at, seat = bucket[kicks], random.integers(0, SLOTS, int(kicks.sum()))
        fingerprint[kicks], table[at, seat] = table[at, seat], fingerprint[kicks]
        bucket = _other(bucket, fingerprint, n_buckets)
    return False


def build_filter(keys, n_keys: int | None = None) -> np.ndarray:
    """A cuckoo filter of distinct 16-byte keys, with room for ``n_keys``."""
    n_buckets = _grown(max(len(keys), n_keys or 0))
    while True:
        table = np.zeros((n_buckets, SLOTS), np.uint16)
        if not len(keys) or _insert(table, *_places(keys, n_buckets)):
            return table
        n_buckets *= 2


def in_filter(table: np.ndarray, keys) -> np.ndarray:
    """Whether each key may be held; a key that is held never gives False."""
    if not len(keys):
        return np.zeros(0, bool)
    fingerprint, bucket = _places(keys, len(table))
    hit = lambda at: (table[at] == fingerprint[:, None]).any(axis=1)
    return hit(bucket) | hit(_other(bucket, fingerprint, len(table)))


def drop_from_filter(table: np.ndarray, keys) -> None:
    """Take one fingerprint of each held key out of the filter."""
    if not len(keys):
        return
    fingerprint, bucket = _places(keys, len(table))
    for f, *places in zip(fingerprint, bucket, _other(bucket, fingerprint, len(table))):
        for at in places:
            held = np.flatnonzero(table[at] == f)
            if len(held):
                table[at, held[0]] = 0
                break


# --- the index ------------------------------------------------------------------------------------------------------

REFS, COUNTS, FILTERS = "key binary, id long", "key binary, owner long, refs long", "n_keys long, cells binary"
MANIFEST = "version int, shard int, generation int, n_keys long, n_refs long, n_shards int, least int"
# A key with more references than this share of all rows, of which there can be no more than this many, is broadcast.
HOT_KEYS, HOT_REFS = 100_000, 1_000


def _table(cells) -> np.ndarray:
    return np.frombuffer(cells, np.uint16).reshape(-1, SLOTS).copy()


def _load(filters: pd.DataFrame) -> np.ndarray:
    return _table(filters.cells.iloc[0]) if len(filters) else np.zeros((2, SLOTS), np.uint16)


def with_counts(rows: DataFrame, counts: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` (key, ...) joined to ``counts`` (key, refs, ...), of which ``refs`` says how many of the rows have a key.

    A line of a third of all documents is not brought to one task: keys with over a 100,000th of all rows, 100,000 at
    most, are broadcast, so that their rows stay where they are; the others are shuffled.
    """
    limit = max(HOT_REFS, n_rows // HOT_KEYS)
    hot = F.broadcast(counts.where(F.col("refs") > limit))
    cold = rows.join(hot.select("key"), "key", "left_anti").join(counts.where(F.col("refs") <= limit), "key")
    return rows.join(hot, "key").unionByName(cold)


class LineIndex:
    """The index in a folder that all executors reach; a folder that holds one is opened as it was left.

    Each change writes the shards that it touches anew, as a generation of files beside the older ones, and then one small
    manifest that names the generation of every shard. A change that dies before its manifest has changed nothing.
    ``shard_keys`` bounds the keys of a shard, and with them the filter that one task holds. One change at a time.
    """

    def __init__(self, spark, path: str | None = None, least: int = 10, shard_keys: int = 100_000):
        self.spark, self.path, self.least, self.shard_keys = spark, path or scratch_folder(spark), least, shard_keys
        self.version, self.n_shards, self.shards = 0, 1, {}  # shard: (generation, number of keys, number of references)
        if folder_exists(spark, f"{self.path}/manifest"):
            manifest = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
            newest = manifest.where(F.col("version") == manifest.agg(F.max("version")).first()[0])
            for row in newest.collect():
                self.version, self.n_shards, self.least = row.version, row.n_shards, row.least
                if row.shard >= 0:
                    self.shards[row.shard] = (row.generation, row.n_keys, row.n_refs)

    def _shard(self, n_shards: int | None = None):
        return F.pmod(F.xxhash64("key"), F.lit(n_shards or self.n_shards)).cast("int").alias("shard")

    def _read(self, table: str, schema: str, shards=None) -> DataFrame:
        """A table's present rows with their ``shard``, of some shards only; the folders of others are not opened."""
        chosen = sorted(self.shards if shards is None else self.shards.keys() & set(shards))
        folders = [f"{self.path}/{table}/generation={self.shards[s][0]}/shard={s}" for s in chosen]
        columns = f"{schema}, generation int, shard int"
        if not folders:
            return self.spark.createDataFrame([], columns).drop("generation")
        return self.spark.read.schema(columns).option("basePath", f"{self.path}/{table}").parquet(*folders).drop("generation")

    def references(self, shards=None) -> DataFrame:
        """Rows (key, id, shard): the documents that hold a key."""
        return self._read("refs", REFS, shards)

    def counts(self, shards=None) -> DataFrame:
        """Rows (key, owner, refs, shard): the smallest document that holds a key, and how many do."""
        return self._read("counts", COUNTS, shards)

    def filters(self, shards=None) -> DataFrame:
        return self._read("filters", FILTERS, shards)

    def _write(self, table: str, rows: DataFrame, generation: int, n_shards: int) -> DataFrame:
        """Write a table's touched shards; a shard with a very common line is written by several tasks."""
        folder = f"{self.path}/{table}/generation={generation}"
        rows.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _commit(self, touched, refs: DataFrame, counts: DataFrame, added: DataFrame | None, gone: DataFrame | None, n_shards: int | None = None) -> None:
        """Write ``touched`` shards with their new references and counts, and their filters after ``added`` and ``gone`` keys."""
        n_shards, generation = n_shards or self.n_shards, self.version + 1
        resharded = n_shards != self.n_shards
        refs, counts = self._write("refs", refs, generation, n_shards), self._write("counts", counts, generation, n_shards)
        sizes = {r.shard: [r["count"], 0] for r in counts.groupBy("shard").count().collect()}
        for row in refs.groupBy("shard").count().collect():
            sizes[row.shard][1] = row["count"]
        nothing = self.spark.createDataFrame([], "key binary, shard int, gone boolean")
        changes = [rows.select("key", "shard", F.lit(out).alias("gone")) for rows, out in ((added, False), (gone, True)) if rows is not None]
        changes = changes[0].unionByName(changes[1]) if len(changes) == 2 else changes[0] if changes else nothing

        def change(shard, keys, filters):
            table, n_keys = _load(filters), int(filters.n_keys.iloc[0]) if len(filters) else 0
            drop_from_filter(table, keys.key[keys.gone].tolist())
            new = keys.key[~keys.gone].tolist()
            n_keys += len(new) - int(keys.gone.sum())
            fits = n_keys <= SLOTS * LOAD * len(table) and (not new or _insert(table, *_places(new, len(table))))
            return pd.DataFrame({"shard": [shard[0]], "n_keys": [n_keys], "cells": [table.tobytes() if fits else None]})

        def build(shard, keys):
            return pd.DataFrame({"shard": [shard[0]], "n_keys": [len(keys)], "cells": [build_filter(keys.key.tolist(), 2 * len(keys)).tobytes()]})

        columns = f"shard int, {FILTERS}"
        if resharded:
            filters = counts.select("key", "shard").groupBy("shard").applyInPandas(build, columns)
        else:
            old = self.filters(touched).groupBy("shard")
            changed = materialise(changes.groupBy("shard").cogroup(old).applyInPandas(change, columns))
            full = [row.shard for row in changed.where("cells IS NULL").select("shard").collect()]
            filters = changed.where("cells IS NOT NULL")
            if full:  # too small by now: made anew, twice as large as the keys need
                keys = counts.where(F.col("shard").isin(full)).select("key", "shard")
                filters = filters.unionByName(keys.groupBy("shard").applyInPandas(build, columns))
        self._write("filters", filters.where(F.col("shard").isin(list(sizes))), generation, n_shards)
        kept = {} if resharded else {s: v for s, v in self.shards.items() if s not in set(touched)}
        shards = kept | {s: (generation, *size) for s, size in sizes.items()}
        rows = [(generation, s, *v, n_shards, self.least) for s, v in shards.items()] or [(generation, -1, 0, 0, 0, n_shards, self.least)]
        # One file, which is there or not.
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.version, self.n_shards, self.shards = generation, n_shards, shards

    def _make_room(self, n_new: int) -> None:
        """Deal the keys to more shards before they outgrow them."""
        total = n_new + sum(n for _, n, _ in self.shards.values())
        if total <= 2 * self.n_shards * self.shard_keys and self.version:
            return
        n_shards = 1 << max(0, math.ceil(math.log2(max(1, total / self.shard_keys))))
        if not self.shards:
            self.n_shards = n_shards
            return
        place = self._shard(n_shards)
        refs, counts = self.references().select("key", "id", place), self.counts().select("key", "owner", "refs", place)
        self._commit(list(self.shards), refs, counts, None, None, n_shards)

    def ask(self, keys: DataFrame, shards) -> DataFrame:
        """``keys`` (key, shard, refs) with ``maybe``: False means that no document in the index holds the key."""

        def answer(shard, rows, filters):
            return rows.assign(maybe=in_filter(_load(filters), rows.key.tolist()))[["key", "shard", "refs", "maybe"]]

        asked = keys.select("key", "shard", "refs").groupBy("shard").cogroup(self.filters(shards).groupBy("shard"))
        return asked.applyInPandas(answer, "key binary, shard int, refs long, maybe boolean")

    def insert(self, docs: DataFrame) -> None:
        """Put documents (doc_id, text) in; what a document already holds is not counted again."""
        rows = materialise(line_keys(docs, self.least).distinct())
        n_rows = rows.count()
        if not n_rows:
            return
        per_key = materialise(rows.groupBy("key").agg(F.min("id").alias("owner"), F.count("*").alias("refs")))
        self._make_room(per_key.count())
        per_key = per_key.withColumn("shard", self._shard())
        touched = [row.shard for row in per_key.select("shard").distinct().collect()]
        if not self.shards.keys() & set(touched):
            self._commit(touched, rows.withColumn("shard", self._shard()), per_key, per_key, None)
            return
        asked = materialise(self.ask(per_key, touched))
        # Keys that the filters rule out go in as they come.
        new_keys = per_key.join(asked.where("NOT maybe").select("key"), "key", "left_semi")
        flagged = materialise(with_counts(rows, asked, n_rows))
        looked_up = flagged.where("maybe").join(self.references(touched).select("key", "id"), ["key", "id"], "left_anti")
        fresh = flagged.where("NOT maybe").unionByName(looked_up).select("key", "id", "shard")
        more = materialise(looked_up.groupBy("key", "shard").agg(F.min("id").alias("owner"), F.count("*").alias("refs")))
        old = self.counts(touched)
        grown = old.unionByName(more).groupBy("key", "shard").agg(F.min("owner").alias("owner"), F.sum("refs").alias("refs"))
        false_alarms = more.join(old.select("key"), "key", "left_anti").select("key", "shard")
        self._commit(
            touched, self.references(touched).unionByName(fresh), grown.unionByName(new_keys),
            new_keys.select("key", "shard").unionByName(false_alarms), None,
        )

    def delete(self, ids: DataFrame) -> None:
        """Take documents (doc_id) out; ids that the index does not hold, an empty table or index change nothing."""
        out = materialise(ids.select(_ids()).distinct())
        gone = materialise(self.references().join(out, "id", "left_semi").select("key", "id", "shard"))
        touched = [row.shard for row in gone.select("shard").distinct().collect()]
        if not touched:
            return
        lost = gone.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        before = self.counts(touched)
        changed = materialise(before.join(lost, "key").withColumns({"left": F.col("refs") - F.col("n"), "orphan": F.col("first") == F.col("owner")}))
        refs = self.references(touched).join(gone.select("key", "id"), ["key", "id"], "left_anti")
        orphans = changed.where("orphan AND left > 0").select("key", "refs")
        n_refs = sum(self.shards[s][2] for s in touched)
        owners = with_counts(refs.select("key", "id"), materialise(orphans), n_refs).groupBy("key").agg(F.min("id").alias("next"))
        fewer = changed.where("left > 0").join(owners, "key", "left").select(
            "key", F.coalesce("next", "owner").alias("owner"), F.col("left").alias("refs"), "shard"
        )
        counts = before.join(changed.select("key"), "key", "left_anti").unionByName(fewer)
        self._commit(touched, refs, counts, None, changed.where("left = 0").select("key", "shard"))

    def resolve(self, docs: DataFrame) -> DataFrame:
        """``docs`` (doc_id, text) without the lines that a smaller document holds: doc_id, n_lines, n_dropped, kept.

        Lines end at \\n; a NULL or empty text is one empty line. A line's key is the line without white space at its
        ends and with A-Z lowered. Keys of at least ``least`` code points that two or more documents hold stay in the
        smallest of them only. Rows with the same doc_id are one document, also rows without one, which come after all
        others. A document that is not in the index loses nothing. An empty table gives an empty result; other columns
        are ignored.
        """
        shared = self.counts().where("refs > 1").select("key", "owner", "refs")
        n_refs = sum(n for *_, n in self.shards.values())
        extra = with_counts(self.references().select("key", "id"), shared, n_refs).where("id > owner")
        extra = extra.groupBy("id").agg(F.collect_set(F.hex("key")).alias("drops"))
        least = self.least

        def keep(batches):
            for batch in batches:
                out = []
                for text, drops in zip(batch.text, batch.drops):
                    lines = text.split("\n")
                    if drops is None:
                        out.append((len(lines), 0, text))
                        continue
                    drops = {d.lower() for d in drops}
                    kept = [line for line in lines if _python_key(line, least) not in drops]
                    out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
                yield pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"]).assign(doc_id=batch.doc_id.array)[["doc_id", "n_lines", "n_dropped", "kept"]]

        rows = docs.select("doc_id", _ids(), F.coalesce("text", F.lit("")).alias("text")).join(extra, "id", "left").drop("id")
        return rows.mapInPandas(keep, "doc_id long, n_lines long, n_dropped long, kept string")
