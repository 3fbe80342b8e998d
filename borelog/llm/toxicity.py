"""Toxicity scores from subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams, a text the mean of its distinct words and ``PADDING`` null
vectors, so that a few words say little; a softmax over a linear map of that mean gives the class. Embeddings and map are learned together. N-grams are hashed to a fixed number of rows,
so a spelling that was never seen still has the vectors of the n-grams it shares with known ones. For scoring, rows and
map fold into one number per n-gram, which is all that is broadcast.
"""

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.llm.bpe import Memo

WORD = re.compile(r"[^\W\d_]+")
SHORTEST, LONGEST = 3, 6
HELD_OUT = 2
PADDING = 20
THRESHOLD = 0.3


def held_out(doc_id="doc_id"):
    """Whether a document is kept from learning; a row without doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def ngrams(word: str, buckets: int) -> list[int]:
    """Rows of a word's character n-grams, its ends marked, and of the whole word."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in [*grams, marked]]


def distinct_words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Features:
    """Words of a set of texts with their n-gram rows, and the words of each text, as flat arrays."""

    def __init__(self, texts, buckets: int):
        number, self.texts = {}, []
        for text in texts:
            words = [number.setdefault(w, len(number)) for w in sorted(distinct_words(text))]
            self.texts.append(np.array(words, np.int32))
        rows, sizes = array("i"), array("i")
        for word in number:
            of_word = ngrams(word, buckets)
            rows.extend(of_word)
            sizes.append(len(of_word))
        self.sizes, self.rows = np.array(sizes, np.int32), np.array(rows, np.int32)
        self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes


def _spread(starts, sizes):
    """Positions of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _sums(index, values, n):
    return np.stack([np.bincount(index, v, n) for v in values.T], axis=1)


def train(texts, labels, buckets: int = 1 << 20, width: int = 4, epochs: int = 5, rate: float = 4.0,
          still: float = 1e-5, weight: float = 3.0, batch: int = 64, seed: int = 7):
    """One number per n-gram row and the bias: the log-odds of label 1 are the mean over words and padding of the mean
    of their rows.

    Mini-batches go through in a random order; AdaGrad scales each coordinate's step; it starts
    as if gradients of ``still`` in square had been seen, so n-grams that few texts have move little. Texts
    of label 1, the rarer, count ``weight`` times. Without both labels every text gets
    the log-odds of the share of label 1, which is taken as at least 1 in 1000 and at most 999.
    """
    labels = np.asarray(labels, np.int64)
    share = min(max(labels.mean() if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    if not 0 < labels.sum() < len(labels):
        return np.zeros(buckets, np.float32), float(np.log(share / (1 - share)))
    random, features = np.random.default_rng(seed), Features(texts, buckets)
    table = random.uniform(-0.1, 0.1, (buckets, width))
    heads, bias = None, np.log([1 - share, share])
    heads = random.uniform(-1, 1, (2, width))
    seen = [np.full_like(table, still), np.full_like(heads, 1e-2), np.full_like(bias, 1e-2)]
    used = [i for i, t in enumerate(features.texts) if len(t)]
    for _ in range(epochs):
        for at in range(0, len(used), batch):
            if at == 0:
                random.shuffle(used)
            chosen = used[at : at + batch]
            owner = np.repeat(np.arange(len(chosen)), [len(features.texts[i]) for i in chosen])
            words, word = np.unique(np.concatenate([features.texts[i] for i in chosen]), return_inverse=True)
            sizes = features.sizes[words].astype(np.int64)
            rows = features.rows[_spread(features.starts[words], sizes)]
            firsts = np.r_[0, np.cumsum(sizes)[:-1]]
            vectors = np.add.reduceat(table[rows], firsts) / sizes[:, None]
            lengths = np.bincount(owner, minlength=len(chosen))[:, None] + PADDING
            means = _sums(owner, vectors[word], len(chosen)) / lengths
            logits = means @ heads.T + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(chosen)), labels[chosen]] -= 1
            chance *= np.where(labels[chosen] == 1, weight, 1.0)[:, None]
            back = (chance @ heads / lengths)[owner]
            back = _sums(word, back, len(words)) / sizes[:, None]
            touched, row = np.unique(rows, return_inverse=True)
            step = _sums(row, np.repeat(back, sizes, axis=0), len(touched))
            seen[0][touched] += step * step
            table[touched] -= rate * step / np.sqrt(seen[0][touched])
            for value, step, total in ((heads, chance.T @ means, seen[1]), (bias, chance.sum(axis=0), seen[2])):
                total += step * step
                value -= 0.05 * step / np.sqrt(total)
    return (table @ (heads[1] - heads[0])).astype(np.float32), float(bias[1] - bias[0])


def _sampled(docs: DataFrame, labels: DataFrame, max_rows: int, max_chars: int) -> DataFrame:
    """Rows (doc_id, h, text, toxic) of at most ``max_rows`` labelled documents with at most ``max_chars`` characters in all.

    Rows come in the order of a hash of doc_id, and of equal numbers in that of their text; texts are whole. A text that
    would go beyond ``max_chars`` is passed over, those after it are not. Raises ValueError if only one of both labels is
    left by that. Lengths and hashes reach the driver, texts do not.
    """
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(marked), "doc_id")  # at most max_rows numbers
    order = (F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    sizes = rows.orderBy(*order).select(F.length("text").alias("n"), "doc_id", F.xxhash64("text").alias("h"), "toxic").limit(max_rows).toPandas()
    taken, chosen = 0, []
    for n in sizes.n:
        chosen.append(taken + n <= max_chars)
        taken += n if chosen[-1] else 0
    fits = sizes[np.array(chosen, bool)]
    if sizes.toxic.nunique() > fits.toxic.nunique():
        raise ValueError(f"no text of one of the labels fits a sample of {max_chars} characters")
    few = docs.sparkSession.createDataFrame(fits[["doc_id", "h"]].drop_duplicates(), "doc_id long, h long")
    return rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(few), ["doc_id", "h"]).select("doc_id", "h", "text", "toxic")


def _ordered(found: pd.DataFrame):
    found = found.sort_values(["doc_id", "h"])
    return found.text.tolist(), found.toxic.tolist()


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_chars: int):
    """The sample's texts and labels as lists."""
    return _ordered(_sampled(docs, labels, max_rows, max_chars).toPandas())


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000, max_chars: int = 40_000_000):
    """Learn from ``labels`` (doc_id, toxic) of documents that are not held out, at most so many rows and characters.

    One task holds the sample and learns; the driver gets the model alone.
    """

    def learn(batches):
        parts = list(batches)
        table, bias = train(*_ordered(pd.concat(parts)) if parts else ([], []))
        yield pd.DataFrame({"weights": [table.tobytes()], "bias": [bias]})

    sample = _sampled(docs, labels, max_rows, max_chars).repartition(1)
    learnt = sample.mapInPandas(learn, "weights binary, bias double").first()
    if learnt is None:  # without a row Spark may leave the task out
        return train([], [])
    return np.frombuffer(learnt.weights, np.float32), learnt.bias


def scorer(spark, model):
    """A column function: the chance of label 1 of each whole text. The model, about 4 MB of fixed size, is broadcast."""
    given = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, bias = given.value
        weights, buckets = table.tolist(), len(table)

        def word(w):
            rows = ngrams(w, buckets)
            return sum([weights[r] for r in rows]) / len(rows)

        def one(text):
            words = sorted(distinct_words(text))  # sums do not depend on the order of a set
            odds = bias + sum(map(known, words)) / (len(words) + PADDING)
            return 1 / (1 + math.exp(min(-odds, 700)))

        known = Memo(word)
        for part in texts:
            yield part.map(one)

    return lambda text: chance(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model) -> DataFrame:
    """Score whole texts: doc_id and score, the chance of label 1.

    A text without letters, a NULL and an empty one get the chance of the bias alone. A NULL doc_id and repeated rows are
    kept; an empty table gives an empty result; other columns are ignored. Nothing is shuffled.
    """
    return docs.select("doc_id", scorer(docs.sparkSession, model)(F.col("text")).alias("score"))
