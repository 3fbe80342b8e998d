"""Substring dedup by super-k-mers: windows that share a minimiser travel together to its bucket.

A window is ``K`` consecutive words, its minimiser the least hash of the runs of ``M`` words inside it, so equal windows
have equal minimisers. Consecutive windows with one minimiser form a super-k-mer. Only super-k-mers whose minimiser occurs
in two documents are packed as strings and sent to its bucket; equal strings become one row on the way. A bucket sorts the
windows of its strings and finds the smallest document of each. Where very many strings agree in two minimisers, as they do
at the edges of a passage that many documents hold, the windows themselves are dealt out by their hashes.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.llm.shingles import MIX, scramble, windows, word_hashes
from borelog.support import materialise, remove_folder, scratch_folder, small_side

K, M = 50, 20
LONGEST = 256
PIECES = 256
NO_ID = 2**63 - 1


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, from runs of doubled length."""
    have = 1
    while 2 * have <= width:
        values, have = np.minimum(values[:-have], values[have:]), 2 * have
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(hashes: np.ndarray, salt: int = 0):
    """Start, number of windows and minimiser of each super-k-mer of a text's words; one has ``LONGEST`` windows at most."""
    if len(hashes) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = windows(hashes ^ np.uint64(salt), M)
    least = _sliding_min(runs, K - M + 1)
    new = np.r_[True, least[1:] != least[:-1]]
    place = np.arange(len(least))
    since = place - np.maximum.accumulate(np.where(new, place, 0))
    starts = np.flatnonzero(new | (since % LONGEST == 0))
    return starts, np.diff(np.r_[starts, len(least)]), least[starts].view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", "text").alias("row"), "text")


def _cut(batches):
    """Narrow rows of all super-k-mers."""
    for batch in batches:
        for at in range(0, len(batch), PIECES):
            part = batch.iloc[at : at + PIECES]
            found = [super_kmers(word_hashes(text, lower=False)) for text in part.text]
            sizes = [len(starts) for starts, _, _ in found]
            starts, counts, least = (np.concatenate(x) for x in zip(*found))
            ids, rows = np.repeat(part.id.to_numpy(), sizes), np.repeat(part.row.to_numpy(), sizes)
            yield pd.DataFrame({"minimiser": least, "id": ids, "row": rows, "start": starts, "windows": counts})


def _pack(batches):
    """The wanted super-k-mers of each text as strings."""
    for batch in batches:
        out = []
        for id_, row, text, wanted in zip(batch.id, batch.row, batch.text, batch.wanted):
            words = text.encode().split()
            for w in wanted:
                packed = b" ".join(words[w["start"] : w["start"] + w["windows"] + K - 1])
                out.append((w["minimiser"], hashlib.blake2b(packed, digest_size=16).digest(), packed.decode(), id_, row, w["start"]))
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["minimiser", "sid", "packed", "id", "row", "start"])
                out = []
        yield pd.DataFrame(out, columns=["minimiser", "sid", "packed", "id", "row", "start"])


def _split(batches):
    """Strings of one crowded minimiser, cut again by the minimisers of another order."""
    for batch in batches:
        out = []
        for least, sid, packed, owner in zip(batch.minimiser, batch.sid, batch.packed, batch.owner):
            words = packed.encode().split()
            for start, count, second in zip(*super_kmers(word_hashes(packed, lower=False), salt=int(MIX[4]))):
                out.append((least, int(second), sid, int(start), b" ".join(words[start : start + count + K - 1]).decode(), owner))
        yield pd.DataFrame(out, columns=["minimiser", "second", "sid", "offset", "packed", "owner"])


def _window_hashes(hashes: np.ndarray):
    """Two 64-bit hashes of each window."""
    return windows(hashes, K), windows(scramble(hashes ^ MIX[2]), K)


def _list_windows(batches):
    """Narrow rows of all windows of strings."""
    for batch in batches:
        for at in range(0, len(batch), PIECES):
            part = batch.iloc[at : at + PIECES]
            found = [_window_hashes(word_hashes(packed, lower=False)) for packed in part.packed]
            sizes = [len(first) for first, _ in found]
            first, second = (np.concatenate(x).view(np.int64) for x in zip(*found))
            repeated = {c: np.repeat(part[c].to_numpy(), sizes) for c in ("sid", "offset", "owner")}
            place = np.concatenate([np.arange(n) for n in sizes])
            yield pd.DataFrame({"first": first, "other": second, **repeated, "place": place})


def _resolve(rows: pd.DataFrame) -> pd.DataFrame:
    """The smallest document of every window of a bucket's strings, as runs of equal documents."""
    hashes = [word_hashes(packed, lower=False) for packed in rows.packed]
    words = np.array([len(h) for h in hashes])
    sizes = words - K + 1
    # Windows are hashed over all strings at once; those that reach over the end of one are left out.
    joined = np.concatenate(hashes)
    inside = np.repeat(np.cumsum(words) - K, words) >= np.arange(len(joined))
    inside = inside[: len(joined) - K + 1]
    first, second = (x[inside] for x in _window_hashes(joined))
    owner = np.repeat(rows.owner.to_numpy(), sizes)
    order = np.lexsort((second, first))
    new = np.r_[True, (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])]
    least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    smallest = np.empty_like(owner)
    smallest[order] = least[np.cumsum(new) - 1]
    lengths, owners, at = [], [], 0
    for size in sizes:
        part = smallest[at : at + size]
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        lengths.append(np.diff(np.r_[edges, size]))
        owners.append(part[edges])
        at += size
    return pd.DataFrame({"sid": rows.sid.array, "offset": rows.offset.array, "lengths": lengths, "owners": owners})


def _resolve_apart(strings: DataFrame, path: str) -> DataFrame:
    """What ``_resolve`` finds, for strings of which too many would meet: every window goes by its own hash.

    The smallest documents are combined in the scanning task first, so a window of very many strings is one row per task.
    """
    listed = strings.select("sid", "offset", "packed", "owner")
    listed = materialise(listed.mapInPandas(_list_windows, "first long, other long, sid binary, offset int, owner long, place int"), path)
    least = listed.groupBy("first", "other").agg(F.min("owner").alias("least"), F.max("owner").alias("last"))
    # A window of one document only keeps the owner of its string.
    least = least.where("least < last").drop("last")
    judged = listed.join(least, ["first", "other"], "left").select("sid", "offset", "place", F.coalesce("least", "owner").alias("least"))
    runs = judged.groupBy("sid", "offset").agg(F.array_sort(F.collect_list(F.struct("place", "least"))).alias("found"))
    return runs.select("sid", "offset", F.transform("found", lambda f: F.lit(1)).alias("lengths"), F.col("found.least").alias("owners"))


def _keep(batches):
    for batch in batches:
        out = []
        for doc_id, id_, text, found in zip(batch.doc_id, batch.id, batch.text, batch.found):
            words = text.encode().split()
            covered = np.zeros(len(words) + 1, np.int64)
            for f in found if found is not None else ():
                at = f["start"]
                for length, owner in zip(f["lengths"], f["owners"]):
                    if owner < id_:
                        covered[at] += 1
                        covered[at + length + K - 1] -= 1
                    at += length
            stays = np.cumsum(covered[:-1]) == 0
            kept = words if stays.all() else [w for w, s in zip(words, stays) if s]
            out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
        frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        yield frame.assign(doc_id=batch.doc_id.array)


def remove_repeats(docs: DataFrame, bucket_rows: int = 5_000) -> DataFrame:
    """Whole texts without repeated passages: a row per row of ``docs`` with doc_id, n_words, n_removed and kept.

    Words end at ASCII white space and are compared unchanged. A word goes if it is covered by a window of 50 words of
    which an equal one starts in a document with a smaller doc_id; windows are judged on the input. What stays is joined
    by single spaces. A NULL text has no words. Rows that repeat a doc_id are one document, so none of them loses words to
    the others; rows without doc_id are one document after all others. An empty table gives an empty result; other columns
    are ignored.

    ``bucket_rows`` is the number of strings that one task sorts at a time. The strings of a minimiser with more different
    ones are cut again by a second minimiser. Strings around one passage mostly agree in that one as well; where more than
    ``bucket_rows`` agree in both, their windows are spread over all tasks by their own hashes.
    """
    spark, rows = docs.sparkSession, _rows(docs)
    paths = [scratch_folder(spark) for _ in range(5)]
    cut = materialise(rows.drop("doc_id").mapInPandas(_cut, "minimiser long, id long, row long, start int, windows int"), paths[0])
    shared = cut.groupBy("minimiser").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("minimiser")
    wanted = cut.join(shared, "minimiser").groupBy("row").agg(F.collect_set(F.struct("start", "windows", "minimiser")).alias("wanted"))
    packs = rows.hint("merge").join(wanted, "row").select("id", "row", "text", "wanted")
    packs = materialise(packs.mapInPandas(_pack, "minimiser long, sid binary, packed string, id long, row long, start int"), paths[1])
    remove_folder(spark, paths[0])
    strings = materialise(packs.groupBy("minimiser", "sid", "packed").agg(F.min("id").alias("owner")), paths[2])
    crowds = strings.groupBy("minimiser").agg(F.count("*").alias("crowd"), F.first("sid").alias("only"), F.min("owner").alias("owner"))
    n_windows = F.size(F.split("packed", " ")) - K + 1
    alone = strings.join(crowds.where("crowd = 1").select("minimiser"), "minimiser").select(
        "sid", F.lit(0).alias("offset"), F.array(n_windows).alias("lengths"), F.array("owner").alias("owners")
    )
    met = strings.join(crowds.where("crowd > 1").select("minimiser", "crowd"), "minimiser")
    few = met.where(F.col("crowd") <= bucket_rows).select("minimiser", F.lit(0).cast("long").alias("second"), "sid", F.lit(0).alias("offset"), "packed", "owner")
    many = met.where(F.col("crowd") > bucket_rows).mapInPandas(
        _split, "minimiser long, second long, sid binary, offset int, packed string, owner long"
    )
    many = materialise(many, paths[3])
    cells = many.groupBy("minimiser", "second").agg(F.count("*").alias("held")).where(F.col("held") > bucket_rows)
    cells = small_side(cells.drop("held"))
    apart = many.join(cells, ["minimiser", "second"], "left_semi")
    many = many.join(cells, ["minimiser", "second"], "left_anti")
    n_buckets = max(1, strings.count() // bucket_rows)
    bucket = F.pmod(F.xxhash64("minimiser", "second"), F.lit(n_buckets)).alias("bucket")
    dealt = few.unionByName(many).select(bucket, "sid", "offset", "packed", "owner")
    resolved = dealt.groupBy("bucket").applyInPandas(_resolve, "sid binary, offset int, lengths array<int>, owners array<long>")
    owners = alone.unionByName(resolved).unionByName(_resolve_apart(apart, paths[4]))
    older = F.exists("owners", lambda o: o < F.col("id"))
    found = packs.select("sid", "id", "row", "start").distinct().join(owners, "sid").where(older).groupBy("row").agg(
        F.collect_list(F.struct((F.col("start") + F.col("offset")).alias("start"), "lengths", "owners")).alias("found")
    )
    judged = rows.hint("merge").join(found, "row", "left").select("doc_id", "id", "text", "found")
    return judged.mapInPandas(_keep, "doc_id long, n_words long, n_removed long, kept string")
