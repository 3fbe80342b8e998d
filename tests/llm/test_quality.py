import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from borelog.llm.quality import BUCKETS, features, log_ratios, resample, threshold
from borelog.llm.toxicity import held_out

FOLDER = "/root/testdata/sf0.1"


def test_ratios_count_all_documents(spark, frame):
    rows = [(i, f"common word{i} {'good text' if i % 2 else 'junk | junk'}") for i in range(40)] + [(None, "no number"), (41, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    learnt = {r.doc_id for r in labels.where(~held_out()).where("quality = 1").collect()}
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for i, t in rows:
        counts = np.bincount(features(t or ""), minlength=BUCKETS)
        raw += counts
        target += counts if i in learnt else 0
    assert np.allclose(log_ratios(frame(rows), labels), np.log(target / target.sum() / (raw / raw.sum())))


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0, 2.0], [5.0] * 10, [float(i % 7) for i in range(100)], [1e-300, 1.0, 1e300], [math.exp(i) for i in range(50)]])
def test_threshold_is_exact(spark, values):
    scores = spark.createDataFrame([(v,) for v in values], "key double")
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        if k <= len(values):
            assert threshold(scores, k) == sorted(values, reverse=True)[k - 1]


def test_share_is_kept_and_good_documents_win(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = resample(docs, labels, share=0.8)
    assert found.where("kept").count() == math.ceil(0.8 * docs.count())
    scored = resample(docs, labels).where(held_out()).join(labels, "doc_id").toPandas()
    good, bad = scored.log_weight[scored.quality == 1].to_numpy(), scored.log_weight[scored.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert scored.kept[scored.quality == 1].mean() > 0.9 and scored.kept[scored.quality == 0].mean() < 0.3


def test_edge_cases(spark, frame):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "x"), (1, "a b"), (4, "long text " * 100_000)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = resample(frame(rows), none).collect()
    assert len(found) == len(rows) and all(r.kept and r.log_weight == 0 for r in found)
    few = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (None, 1)], "doc_id long, quality int")
    first, again = (sorted(map(str, resample(frame(rows), few, share=0.5).collect())) for _ in range(2))
    assert first == again
    assert resample(frame([]), few).collect() == []
