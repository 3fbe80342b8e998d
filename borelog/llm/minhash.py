"""Near-duplicate groups: SuperMinHash signatures, bands, exact verification and union-find.

Documents with equal shingle sets are one class, which has a number and one of its documents as representative.
Representatives whose signatures agree in a band share a bucket; the class with the smallest number in a bucket is its
pivot, and all that share a pivot form a cell.
A cell is verified on full sets inside one task, in blocks of bounded size if it is large, and gives only the links that
join its parts, never all pairs. The links of all cells are contracted to components.
"""

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.llm.shingles import MIX, scramble, shingle_set
from borelog.llm.spread import spread_join
from borelog.support import materialise, remove_folder, scratch_folder

BANDS, ROWS = 32, 4
NEVER = np.uint64(2**64 - 1)
SLICE = 1 << 16


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, a row of ``m`` registers for each set of 64-bit hashes.

    Every element deals the numbers 0, 1, 2, ... plus a random fraction to the registers in a random order of its own;
    a register keeps the least. Once all registers of a set are below j, no element's j-th number can matter, so large
    sets stop after a few steps. A register is the step in the upper and the fraction in the lower 32 bits.
    """
    registers = np.full((len(sets), m), NEVER)
    sizes = np.array([len(s) for s in sets], np.int64)
    owners, elements = np.repeat(np.arange(len(sets)), sizes), np.concatenate([*sets, np.zeros(0, np.uint64)])
    for start in range(0, len(elements), SLICE):
        owner, element = owners[start : start + SLICE], elements[start : start + SLICE]
        order = np.tile(np.arange(m, dtype=np.uint16), (len(element), 1))
        for j in range(m):
            row = np.arange(len(element))
            random = scramble(element + MIX[:1] * np.uint64(j + 1))
            k = (j + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
            chosen = order[row, k]
            order[row, k] = order[:, j]
            order[:, j] = chosen
            np.minimum.at(registers, (owner, chosen), np.uint64(j << 32) | (random >> np.uint64(32)))
            first, last = owner[0], owner[-1]
            open_ = registers[first : last + 1].max(axis=1) >= np.uint64((j + 1) << 32)
            stay = open_[owner - first]
            if not stay.all():
                owner, element, order = owner[stay], element[stay], order[stay]
                if not len(owner):
                    break
    return registers


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's number and registers."""
    bands = registers.reshape(len(registers), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for i in range(ROWS):
        total = scramble(total * MIX[3] + bands[:, :, i])
    return total.view(np.int64)


def text_sha(text):
    """The first half of a text's SHA-256, which with its doc_id tells a row from others; NULL counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def _text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_sha(F.col("text")).alias("sha"), F.coalesce("text", F.lit("")).alias("text"))


def profiles(docs: DataFrame, pieces: int = 256) -> DataFrame:
    """Per row of ``docs``: doc_id, sha, size and digest of its shingle set (NULL if empty) and its band hashes."""

    def profile(batches):
        for batch in batches:
            for start in range(0, len(batch), pieces):
                part = batch.iloc[start : start + pieces]
                sets = [shingle_set(t) for t in part.text]
                bands = band_hashes(superminhash(sets, BANDS * ROWS))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pd.DataFrame({"doc_id": part.doc_id.array, "sha": part.sha.array, "n": [len(s) for s in sets], "digest": digests, "bands": list(bands)})

    return _text(docs).mapInPandas(profile, "doc_id long, sha binary, n long, digest binary, bands array<long>")


# --- components -----------------------------------------------------------------------------------------------------


def pairs(rows: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Rows (a, b) of several pairs of columns; ``rows`` is planned and computed once, not for each pair as a union would."""
    return rows.select(F.inline(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in columns])))


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every number in ``links`` (a, b): the smallest number it is joined to, itself included.

    Each round hangs larger neighbours on the smallest one around a number, then smaller neighbours, until the links are
    stars. Rounds are written to the shared folder, so a lost executor costs no earlier round; no number of rows leaves
    the cluster but a count and a checksum.
    """
    spark, path = links.sparkSession, scratch_folder(links.sparkSession)
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = materialise(links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), path)
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        both = pairs(links, ("a", "b"), ("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        downward = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(downward, "a")
        hung = pairs(small, ("b", "m"), ("a", "m"))
        new = scratch_folder(spark)
        links = materialise(hung.where("a <> b").distinct(), new)
        remove_folder(spark, path)
        path, before = new, state
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


# --- verification ---------------------------------------------------------------------------------------------------


def _linked(sets: list[np.ndarray], group: np.ndarray, asks: np.ndarray, percent: int):
    """Links that join parts: pairs (x, y) of positions with x among ``asks``, similar and not in the same part so far.

    ``group`` has each set's part and is brought up to date. Intersections of one set with all others are counted at once.
    """
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    mark = np.zeros(ids.max() + 1, bool)
    for x in asks:
        near = (group != group[x]) & (100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x]))
        if not near.any():
            continue
        own = ids[starts[x] : starts[x] + sizes[x]]
        mark[own] = True
        common = np.add.reduceat(mark[ids].astype(np.int64), starts)
        mark[own] = False
        hits = np.flatnonzero(near & (100 * common >= percent * (sizes + sizes[x] - common)))
        for y in hits:
            if group[y] != group[x]:
                yield x, y
                group[group == group[y]] = group[x]


def _verify(percent: int):
    def within(rows: pd.DataFrame) -> pd.DataFrame:
        """Links inside a block; the pivot asks first."""
        rows = rows.sort_values("id").drop_duplicates("id")
        ids, sets = rows.id.to_numpy(), [shingle_set(t) for t in rows.text]
        asks = np.argsort(ids != rows.hub.iloc[0], kind="stable")
        return pd.DataFrame([(ids[x], ids[y]) for x, y in _linked(sets, np.arange(len(ids)), asks, percent)], columns=["a", "b"], dtype="int64")

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the movers of one block and the members of another."""
        rows = rows.sort_values("mover", ascending=False).drop_duplicates("id")
        ids, sets, group = rows.id.to_numpy(), [shingle_set(t) for t in rows.text], np.unique(rows.part, return_inverse=True)[1]
        asks = np.flatnonzero(rows.mover)
        return pd.DataFrame([(ids[x], ids[y]) for x, y in _linked(sets, group, asks, percent)], columns=["a", "b"], dtype="int64")

    return within, across


def near_groups(docs: DataFrame, percent: int = 75, block_shingles: int = 1 << 16) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, and sha as ``text_sha`` gives it.

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles of both; words are lower-cased in A-Z and
    end at ASCII white space. A text with fewer than five words is one shingle; NULL, empty and blank texts have none and
    are linked with nothing. A document's component is the smallest doc_id it reaches. A row without doc_id is linked with
    nothing and stays, with a NULL component. Rows that repeat a doc_id with another text are documents of their own: each
    is linked by its own text, whatever the order of the rows. An empty table gives an empty result; other columns are
    ignored.

    A pair at the threshold misses all bands with a chance of 5 in a million; what shares a band is compared exactly.
    ``block_shingles`` bounds the shingles that one task compares at a time.
    """
    within, across = _verify(percent)
    rows = materialise(profiles(docs))
    n_rows = rows.count()
    named = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "sha")).alias("first"), F.count("*").alias("held")
    )
    # Numbers of classes stand in for documents from here on; written once, they stay what they are.
    classes = materialise(named.select("digest", "first.doc_id", "first.sha", "held", F.monotonically_increasing_id().alias("id")))
    reps = rows.join(classes.drop("held"), ["digest", "doc_id", "sha"]).select("id", "n", "bands")
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("held")).where("held > 1")
    cells = materialise(banded.join(buckets, "band").select("hub", "id", "n").distinct())
    n_cells = cells.count()
    sizes = materialise(cells.groupBy("hub").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"), F.count("*").alias("held")))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = materialise(spread_join(cells, sizes, "hub", n_cells).withColumn("block", block).drop("n", "held"))
    routes = placed.where("id <> hub").select("hub", "block", "id").unionByName(
        placed.where("id = hub").select("hub", F.explode(every).alias("block"), "id")
    )
    whose = classes.select("id", "doc_id", "sha")
    # Merged at every size: a broadcast on small tables would hide how the plan grows.
    texts = _text(docs).hint("merge")
    of_routes = lambda sent: sent.join(whose, "id").join(texts, ["doc_id", "sha"]).drop("doc_id", "sha")
    found = [materialise(of_routes(routes).groupBy("hub", "block").applyInPandas(within, "a long, b long"))]
    joined = materialise(components(found[0]))
    large = placed.where("blocks > 1")
    part = joined.select("id", F.col("component").alias("part"))
    members = materialise(large.join(part, "id", "left").withColumn("part", F.coalesce("part", "id")))
    of_hub = members.where("id = hub").select("hub", F.col("part").alias("hub_part")).join(sizes.select("hub", "held"), "hub")
    members = spread_join(members, materialise(of_hub), "hub", n_cells).drop("held")
    members = materialise(members.withColumn("mover", F.col("part") != F.col("hub_part")))
    movers = members.where("mover")
    if movers.limit(1).count():
        asking = movers.select("hub", F.col("block").alias("asks")).distinct()
        sent = movers.select("hub", F.col("block").alias("asks"), F.explode(every).alias("answers"), "id", "part", "mover")
        sent = sent.unionByName(
            members.join(asking, "hub").select("hub", "asks", F.col("block").alias("answers"), "id", "part", F.lit(False).alias("mover"))
        ).where("asks <> answers")
        found.append(materialise(of_routes(sent).groupBy("hub", "asks", "answers").applyInPandas(across, "a long, b long")))
        joined = materialise(components(reduce(DataFrame.unionByName, found)))
    # The smallest doc_id of a component, to its classes and from them to their documents.
    of_class = classes.join(joined, "id", "left").select("digest", "doc_id", "held", F.coalesce("component", "id").alias("component"))
    of_class = materialise(of_class)
    smallest = of_class.groupBy("component").agg(F.min("doc_id").alias("found"), F.count("*").alias("classes"))
    n_classes = of_class.count()
    answers = spread_join(of_class.select("digest", "held", "component"), materialise(smallest), "component", n_classes, "classes")
    answers = materialise(answers.select("digest", "held", "found"))
    result = spread_join(rows.select("doc_id", "sha", "n", "digest"), answers, "digest", n_rows, left=True)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(component).alias("kept")
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept, "sha")
