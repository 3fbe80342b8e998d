import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from borelog.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_held_out_rule(spark, frame):
    rows = frame([(i, "") for i in range(50)] + [(None, "")]).select("doc_id", toxicity.held_out().alias("out")).collect()
    assert all(r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_unseen_misspellings_score_high():
    rng = random.Random(0)
    clean = [" ".join(rng.choice(["river", "stone", "cloud", "meadow", "forest", "window"]) + rng.choice("abcdefgh") for _ in range(30)) for _ in range(300)]
    toxic = [t + " " + rng.choice(["grumblefoot", "grumblefeet", "grumblefoots"]) for t in clean[:100]]
    table, bias = toxicity.train([*clean, *toxic], [0] * 300 + [1] * 100, epochs=20)
    word = lambda w: np.mean(table[toxicity.ngrams(w, len(table))])
    assert word("grumblefooot") > 5 * abs(word("meadowish")) and bias < 0


def test_accuracy_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where(toxicity.held_out()).join(labels, "doc_id").toPandas()
    high = scored.score >= toxicity.THRESHOLD
    assert scored.toxic[high].mean() > 0.75 and high[scored.toxic == 1].mean() > 0.75


@pytest.mark.parametrize("labelled", [[], [(1, 0)], [(1, None), (2, 1), (2, 0), (None, 1)]])
def test_edge_cases(spark, frame, labelled):
    rows = [(1, "a b c"), (2, None), (3, ""), (None, "x"), (1, "a b c"), (4, "long " * 100_000), (5, "123 !!")]
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    found = toxicity.score(frame(rows), toxicity.fit(frame(rows), labels)).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(frame([]), toxicity.fit(frame([]), labels)).collect() == []


def test_a_giant_text_does_not_end_the_sample(spark, frame):
    """One labelled text is longer than the bound; the others are learnt from all the same."""
    rng = random.Random(2)
    word = lambda: rng.choice(["river", "stone", "cloud", "meadow"])
    rows = [(i, " ".join(word() for _ in range(20)) + (" grumblefoot grumblefeet" if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    texts, _ = toxicity._sample(frame(rows), labels, 8000, 60_000)
    first = min((r.h, r.doc_id) for r in frame(rows).join(labels, "doc_id").where(~toxicity.held_out()).select("doc_id", F.xxhash64("doc_id").alias("h")).collect())[1]
    rows = [(i, "word " * 20_000 if i == first else t) for i, t in rows]
    fewer, marks = toxicity._sample(frame(rows), labels, 8000, 60_000)
    assert len(fewer) == len(texts) - 1 and set(marks) == {0, 1}
    model = toxicity.fit(frame(rows), labels, max_chars=60_000)
    scores = {r.doc_id: r.score for r in toxicity.score(frame(rows), model).collect()}
    assert sum(scores[i] >= toxicity.THRESHOLD for i in range(0, 300, 3) if i != first) > 90
    with pytest.raises(ValueError, match="no text of one of the labels"):
        toxicity.fit(frame([(i, t * 1000 if i % 3 == 0 else t) for i, t in rows if i != first]), labels, max_chars=100_000)


def test_scores_by_hand(spark, frame):
    """The score of a text, from the table of n-gram rows alone, in plain loops."""
    texts, marks = ["river stone cloud", "grumble river grumble", "stone stone", "meadow grumbles"], [0, 1, 0, 1]
    table, bias = toxicity.train(texts * 10, marks * 10, epochs=3)
    found = toxicity.score(frame(list(enumerate([*texts, "", "Grumble! GRUMBLE 12"]))), (table, bias)).collect()
    for r, text in zip(sorted(found), [*texts, "", "Grumble! GRUMBLE 12"]):
        words = sorted(set(re.findall(r"[a-z]+", text.lower())))
        means = [np.mean([float(table[g]) for g in toxicity.ngrams(w, len(table))]) for w in words]
        odds = bias + sum(means) / (len(words) + toxicity.PADDING)
        assert r.score == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-9)


def test_the_model_is_learnt_in_a_task(spark, frame, monkeypatch):
    """The driver's process could not learn here; the task's model is the same to the last bit."""
    rows = [(i, f"river stone {i} cloud" + (" grumblefoot" if i % 3 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    table, bias = toxicity.train(*toxicity._sample(frame(rows), labels, 8_000, 60_000))
    monkeypatch.setattr(toxicity, "Features", None)
    found = toxicity.fit(frame(rows), labels, max_chars=60_000)
    assert table.any() and np.array_equal(found[0], table) and found[1] == bias
