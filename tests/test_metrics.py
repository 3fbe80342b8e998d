import itertools
import random

import pytest

from borelog.operators.metrics import accuracy, class_report, confusion_counts, ovr_auc, weighted_ovr_auc


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(5)
    rows = [(draw.choice([0, 0, 3, 8]), draw.choice([0, 3, 8, 9]), *[round(draw.random(), 2) for _ in range(3)]) for _ in range(600)]
    return rows, spark.createDataFrame(rows, "state int, prediction int, s0 double, s3 double, s8 double")


def pair_auc(positives, negatives):
    wins = sum((p > n) + (p == n) / 2 for p, n in itertools.product(positives, negatives))
    return wins / (len(positives) * len(negatives))


@pytest.mark.parametrize("slice_rows", [1_000_000, 20])
def test_auc_counts_pairs(scored, slice_rows):
    rows, frame = scored
    found = {r["class"]: r for r in ovr_auc(frame, {0: "s0", 3: "s3", 8: "s8"}, slice_rows=slice_rows).collect()}
    total = 0.0
    for at, c in enumerate((0, 3, 8), start=2):
        wanted = pair_auc([r[at] for r in rows if r[0] == c], [r[at] for r in rows if r[0] != c])
        assert found[c].auc == pytest.approx(wanted, abs=1e-12)
        total += wanted * sum(r[0] == c for r in rows)
    weighted = weighted_ovr_auc(frame, {0: "s0", 3: "s3", 8: "s8"}, slice_rows=slice_rows).first()
    assert weighted.weighted_auc == pytest.approx(total / len(rows), abs=1e-12) and weighted.message is None


def test_auc_without_positives_gives_a_message(scored):
    row = weighted_ovr_auc(scored[1], {0: "s0", 3: "s3", 7: "s8"}).first()
    assert row.weighted_auc is None and "not calculated" in row.message


def test_confusion_and_accuracy(scored):
    rows, frame = scored
    assert confusion_counts(frame).groupBy().sum("n").first()[0] == len(rows)
    assert accuracy(frame).first()[0] == pytest.approx(sum(r[0] == r[1] for r in rows) / len(rows))


def test_report(scored):
    rows, frame = scored
    report = {r.class_name: r for r in class_report(frame).collect()}
    assert set(report) == {"State_0", "State_3", "State_8", "State_9", "accuracy", "macro avg", "weighted avg"}
    per_class = {}
    for c in (0, 3, 8, 9):
        hits = sum(r[0] == r[1] == c for r in rows)
        support, predicted = sum(r[0] == c for r in rows), sum(r[1] == c for r in rows)
        p, r_ = hits / predicted if predicted else 0.0, hits / support if support else 0.0
        f = 2 * p * r_ / (p + r_) if p + r_ else 0.0
        per_class[c] = (p, r_, f, support)
        assert report[f"State_{c}"][1:] == pytest.approx((p, r_, f, support))
    for i, score in enumerate(("precision", "recall", "f1_score")):
        assert report["macro avg"][score] == pytest.approx(sum(v[i] for v in per_class.values()) / 4)
        assert report["weighted avg"][score] == pytest.approx(sum(v[i] * v[3] for v in per_class.values()) / len(rows))
    assert report["accuracy"].f1_score == pytest.approx(sum(r[0] == r[1] for r in rows) / len(rows))
    assert report["accuracy"].precision is None and report["accuracy"].support == len(rows)
