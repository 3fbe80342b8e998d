"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

The target model counts hashed words and word pairs of documents labelled good, the raw model those of all documents. A
document's log weight is the log of the ratio of its chances under both. Adding Gumbel noise and keeping the k largest
sums draws k documents without replacement in proportion to their weights.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.llm.shingles import windows, word_hashes
from borelog.llm.toxicity import held_out
from borelog.support import materialise

BUCKETS = 10_000
BINS = 4096


def features(text: str) -> np.ndarray:
    """Buckets of a text's words and of its pairs of neighbouring words."""
    hashes = word_hashes(text)
    pairs = windows(hashes, 2) if len(hashes) > 1 else hashes[:0]
    return (np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def _count(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, good in zip(batch.text, batch.good):
            counts = np.bincount(features(text), minlength=BUCKETS)
            raw += counts
            if good:
                target += counts
    yield pd.DataFrame({"bucket": np.arange(BUCKETS), "raw": raw, "target": target})


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log of target over raw frequency of each bucket, counted over all documents; each task gives one vector.

    Every count is one larger than seen. Without any good document the ratios are 0.
    """
    good = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    good = good.where(~held_out())
    # Merged at every size: a broadcast on small tables would hide how the plan grows.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).hint("merge").join(good, "doc_id", "left")
    counts = rows.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInPandas(_count, "bucket int, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def threshold(scores: DataFrame, k: int, column: str = "key") -> float:
    """The k-th largest value of a column, by histograms of ever narrower bounds; each is at most BINS rows."""
    low, high = scores.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / BINS
        if low + width <= low:
            break
        rows = scores.where(F.col(column).between(low, high))
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1))
        bins = rows.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        above = 0
        for b in sorted(bins, key=lambda b: -b.bin):
            if above + b.n >= k:
                break
            above += b.n
        k, low, high = k - above, b.low, b.high
        if b.n == k:
            return low
    return low if k > 1 or low == high else high


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 7) -> DataFrame:
    """A row per row of ``docs``: doc_id, log_weight, key and kept.

    ``share`` of all rows stay, rounded up; by default as large a share as is labelled good. Learns from ``labels``
    (doc_id, quality) of documents that are not held out; several labels of one document count as the best of them. The
    noise hangs on doc_id, text and ``seed`` alone, so a rerun keeps the same rows. Rows that tie with the last one kept
    stay too, and so do rows that repeat doc_id and text of it. A NULL or empty text has log weight 0; a NULL doc_id is
    kept like any other; an empty table gives an empty result, no labels keep everything; other columns are ignored.
    """
    if share is None:
        of_labels = labels.where("quality IS NOT NULL").where(~held_out()).agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        share = 1.0 if of_labels is None else of_labels
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels))

    def weigh(batches):
        for batch in batches:
            weights = [float(ratios.value[features(t)].sum()) for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id.array, "draw": batch.draw.array, "log_weight": weights})

    draw = F.xxhash64("doc_id", "text", F.lit(seed)).alias("draw")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", draw)
    weighed = rows.mapInPandas(weigh, "doc_id long, draw long, log_weight double")
    uniform = (F.shiftrightunsigned("draw", 11) + 0.5) / 2.0**53
    key = (F.col("log_weight") - F.log(-F.log(uniform))).alias("key")
    scores = materialise(weighed.select("doc_id", "log_weight", key))
    k = math.ceil(share * scores.count())
    least = threshold(scores, k) if k else math.inf
    return scores.withColumn("kept", F.col("key") >= least)
