"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window has as many words as the item it is held against. Its fingerprint is the sign of the sum of its shingles' bits.
Fingerprints are cut into blocks: two that differ in at most ``RADIUS`` bits differ in at most RADIUS // BLOCKS bits of
some block, so looking up every block with so many bits flipped finds all items within the radius. Candidates are verified
by the weighted Jaccard similarity of the two bags of shingles.
"""

import functools
import itertools
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.llm.shingles import windows, word_hashes
from borelog.support import materialise

WIDTH = 5
BITS, BLOCKS, RADIUS = 64, 6, 22
EDGES = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
REGION = 20_000


def _signs(shingles: np.ndarray) -> np.ndarray:
    """A row of BITS values -1 or 1 for each shingle."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def simhash(shingles: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of ``size`` shingles."""
    sums = np.cumsum(np.vstack([np.zeros((1, BITS), np.int32), _signs(shingles)]), axis=0)
    return _fingerprints(sums[size:] - sums[:-size])


class HammingIndex:
    """All given fingerprints within RADIUS of a queried one."""

    def __init__(self, fingerprints: np.ndarray):
        self.fingerprints, self.tables = fingerprints, []
        for low, high in itertools.pairwise(EDGES):
            flips = [sum(1 << b for b in c) for n in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(high - low), n)]
            values = self._block(fingerprints, low, high)[:, None] ^ np.array(flips, np.int64)[None, :]
            order = np.argsort(values.ravel(), kind="stable")
            items = np.repeat(np.arange(len(fingerprints)), len(flips))[order]
            self.tables.append((np.searchsorted(values.ravel()[order], np.arange((1 << (high - low)) + 1)), items))

    @staticmethod
    def _block(fingerprints, low: int, high: int):
        return ((fingerprints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def near(self, fingerprints: np.ndarray):
        """Pairs (position in the query, position in the index), each once."""
        found = []
        for (low, high), (starts, items) in zip(itertools.pairwise(EDGES), self.tables):
            values = self._block(fingerprints, low, high)
            sizes = starts[values + 1] - starts[values]
            query = np.repeat(np.arange(len(fingerprints)), sizes)
            item = items[np.repeat(starts[values] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(query))]
            close = np.bitwise_count(fingerprints[query] ^ self.fingerprints[item]) <= RADIUS
            found.append(query[close] * len(self.fingerprints) + item[close])
        pairs = np.unique(np.concatenate(found))
        return np.divmod(pairs, len(self.fingerprints))


class Benchmark:
    """Items by shingle width and number of shingles, ready for search."""

    def __init__(self, items: list[tuple[int, str]]):
        self.groups: dict[tuple[int, int], list] = {}
        for item, text in items:
            hashes = word_hashes(text)
            if len(hashes):
                width = min(WIDTH, len(hashes))
                shingles = windows(hashes, width)
                self.groups.setdefault((width, len(shingles)), []).append((item, shingles))
        self.indexes = {
            key: HammingIndex(np.concatenate([simhash(s, len(s)) for _, s in group])) for key, group in self.groups.items()
        }
        self.known = {
            width: np.unique(np.concatenate([s for (w, _), group in self.groups.items() if w == width for _, s in group]))
            for width in {w for w, _ in self.groups}
        }

    def search(self, text: str, percent: int):
        """Best match of each item: {item: (similarity, first word, words)}; of equal windows the first.

        A window that shares no shingle with any item has similarity 0, so only windows around shared shingles are hashed.
        """
        hashes, best = word_hashes(text), {}
        for width, known in self.known.items():
            if len(hashes) < width:
                continue
            shingles = windows(hashes, width)
            at = np.searchsorted(known, shingles)
            hits = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == shingles)
            if not len(hits):
                continue
            for (w, size), index in self.indexes.items():
                if w == width:
                    self._around(shingles, hits, width, size, index, percent, best)
        return best

    def _around(self, shingles, hits, width, size, index, percent, best):
        group, last = self.groups[width, size], max(0, len(shingles) - size)
        edges = np.flatnonzero(np.r_[True, (hits[1:] - hits[:-1] >= size) | (hits[1:] // REGION != hits[:-1] // REGION)])
        for low, high in zip(hits[edges], hits[np.r_[edges[1:] - 1, len(hits) - 1]]):
            first, end = max(0, min(low - size + 1, last)), min(high, last)
            part = shingles[first : end + size]
            for x, y in zip(*index.near(simhash(part, min(size, len(part))))):
                item, own = group[y]
                a, b = Counter(part[x : x + size].tolist()), Counter(own.tolist())
                common = sum((a & b).values())
                union = sum(a.values()) + sum(b.values()) - common
                found = common / union, -int(first + x)
                if 100 * common >= percent * union and found > best.get(item, (0.0, 0))[:2]:
                    best[item] = (*found, min(size, len(part)) + width - 1)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = 75, block_items: int = 5_000, block_bytes: int = 8 << 20
) -> DataFrame:
    """Passages of ``benchmark`` (item_id, text) in whole texts of ``docs`` (doc_id, text).

    A row per document and item with doc_id, item_id, similarity, start (first word of the best window) and n_words, where
    100 * common >= ``percent`` * union of the bags of five-word shingles; words are lower-cased in A-Z and end at ASCII
    white space. An item of fewer than five words is one shingle of its own length. A NULL or blank text on either side
    matches nothing; a NULL doc_id or item_id and repeated rows are kept; an empty table gives an empty result; other
    columns are ignored. A window at the threshold lies outside the radius with a chance below 1 in 1000. ``doc_id`` may
    be of any type.

    The items are the query set. They are searched in blocks of about ``block_items`` items and ``block_bytes`` bytes, or
    a single longer item: a block is broadcast, the few rows that it finds are written, and it is released before the
    next one is fetched, so neither the driver nor a task ever holds more than one. Documents are read once per block and
    not shuffled.
    """
    spark, items = docs.sparkSession, benchmark.select("item_id", "text").where("text IS NOT NULL")
    n_items, n_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    n_blocks = max(1, -(-n_items // block_items), -(-n_bytes // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    rows, parts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), []
    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")

    def search(given):
        def run(batches):
            bench = Benchmark([(k, text) for k, _, text in given.value])
            names = [item for _, item, _ in given.value]
            for batch in batches:
                out = []
                for doc_id, text in zip(batch.doc_id.astype("Int64") if whole else batch.doc_id, batch.text):
                    for k, (similarity, start, n) in sorted(bench.search(text, percent).items()) if bench.groups else ():
                        out.append((doc_id, names[k], similarity, -start, n))
                frame = pd.DataFrame(out, columns=["doc_id", "item_id", "similarity", "start", "n_words"])
                yield frame.astype({"item_id": "Int64"} | ({"doc_id": "Int64"} if whole else {}))

        return run

    for i in range(n_blocks):
        given = spark.sparkContext.broadcast([(k, r.item_id, r.text) for k, r in enumerate(items.where(block == i).collect())])
        found = rows.mapInPandas(search(given), f"doc_id {kind}, item_id long, similarity double, start long, n_words long")
        parts.append(materialise(found))
        given.unpersist()
    return functools.reduce(DataFrame.unionByName, parts)
