import random

import pytest

from borelog.llm import substring_dedup
from borelog.llm.substring_dedup import K, remove_repeats


def brute(rows):
    rank = lambda i: 2**63 - 1 if i is None else i
    texts = [(rank(i), (t or "").encode().split()) for i, t in rows]
    owner = {}
    for i, words in texts:
        for s in range(len(words) - K + 1):
            w = tuple(words[s : s + K])
            owner[w] = min(i, owner.get(w, i))
    out = []
    for i, words in texts:
        gone = set()
        for s in range(len(words) - K + 1):
            if owner[tuple(words[s : s + K])] < i:
                gone |= set(range(s, s + K))
        out.append((i, len(words), len(gone), b" ".join(w for p, w in enumerate(words) if p not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [5_000, 2])
def test_against_brute_force(frame, bucket_rows):
    """With two rows per bucket most minimisers are crowded and cut again."""
    rng = random.Random(1)
    words = lambda n: [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)]
    passages = [words(n) for n in (49, 50, 51, 80, 400)]
    rows = []
    for i in range(60):
        text = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(passages) + words(rng.randint(0, 5))
        rows.append((i, "\t".join(text)))
    rows += [(100, rows[7][1]), (101, "x " * 700), (102, "x " * 60), (103, "X " * 60), (None, rows[7][1]), (None, rows[7][1]), (104, None), (105, ""), (3, rows[3][1])]
    found = remove_repeats(frame(rows), bucket_rows=bucket_rows).collect()
    assert sorted((2**63 - 1 if r[0] is None else r[0], *r[1:]) for r in found) == brute(rows)


def test_empty_and_long(frame):
    assert remove_repeats(frame([])).collect() == []
    rng = random.Random(2)
    long = " ".join(str(rng.randint(0, 10**6)) for _ in range(50_000))
    found = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(frame([(1, long), (2, "first " + long)])).collect()}
    assert found == {1: (50_000, 0), 2: (50_001, 50_000)}


def test_passage_of_very_many_documents(frame, monkeypatch):
    """The strings around the edges of a common passage agree in both minimisers; they do not meet in one bucket."""
    rng, resolve, bucket_rows = random.Random(3), substring_dedup._resolve, 40
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = words(80)
    rows = [(i, " ".join(words(60) + passage + words(60))) for i in range(1_000)]

    def checked(strings):
        assert len(strings) <= 4 * bucket_rows, f"{len(strings)} strings in one bucket"
        return resolve(strings)

    monkeypatch.setattr(substring_dedup, "_resolve", checked)
    found = remove_repeats(frame(rows), bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, found)) == brute(rows)
