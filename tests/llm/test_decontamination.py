import random

import numpy as np
from pyspark.sql import functions as F

from borelog.llm.decontamination import RADIUS, HammingIndex, find_leaks


def test_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    asked = base.copy()
    for i in range(len(asked)):
        for b in rng.choice(64, rng.integers(0, 40), replace=False):
            asked[i] ^= np.uint64(1 << int(b))
    found = set(zip(*map(np.ndarray.tolist, HammingIndex(base).near(asked))))
    close = np.bitwise_count(asked[:, None] ^ base[None, :]) <= RADIUS
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(close))))


def bag(words):
    return sorted(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def similar(a, b):
    rest, common = list(b), 0
    for x in a:
        if x in rest:
            rest.remove(x)
            common += 1
    return common / (len(a) + len(b) - common)


def brute(rows, items):
    out = {}
    for i, t in rows:
        words = (t or "").lower().split()
        for k, item in items:
            own = (item or "").lower().split()
            if len(own) >= 5 and len(words) >= 5:
                best = max(similar(bag(words[s : s + len(own)]), bag(own)) for s in range(max(1, len(words) - len(own) + 1)))
                if best >= 0.75:
                    out[i, k] = round(best, 9)
    return out


def test_against_brute_force(spark, frame):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randint(0, 300)}" for _ in range(n)]
    items = [(k, " ".join(words(rng.randint(12, 50)))) for k in range(12)] + [(50, None), (51, "")]
    rows = []
    for i in range(60):
        own = rng.choice(items[:12])[1].split()
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = "changed"
        rows.append((i, " ".join(words(rng.randint(0, 60)) + own + words(rng.randint(0, 60))).title()))
    rows += [(100, None), (101, ""), (102, " ".join(words(200))), (103, items[3][1])]
    benchmark = frame(items, "item_id")
    for bounds in ({}, {"block_items": 4}, {"block_bytes": 500}):
        found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in find_leaks(frame(rows), benchmark, **bounds).collect()}
        assert found == brute(rows, items)


def test_blocks_are_fetched_one_after_the_other_and_keys_are_of_any_type(spark, frame, monkeypatch):
    """Many items by bytes; what a block finds is written before the next one is fetched."""
    from borelog.llm import decontamination

    order = []
    write, send = decontamination.materialise, spark.sparkContext.broadcast
    monkeypatch.setattr(decontamination, "materialise", lambda df: order.append("written") or write(df))
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: order.append(len(value)) or send(value))
    items = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(40)]
    rows = [(k, f"before {t} after") for k, t in items]
    docs = frame(rows).withColumn("doc_id", F.unhex(F.md5(F.col("doc_id").cast("string"))))
    found = find_leaks(docs, frame(items, "item_id"), block_bytes=1500)
    assert found.count() == 40 and dict(found.dtypes)["doc_id"] == "binary"
    assert order[1::2] == ["written"] * (len(order) // 2) and len(order) > 6 and sum(order[::2]) == 40 and max(order[::2]) < 20


def test_place_short_items_nulls_and_long_texts(spark, frame):
    item = "one two three four five six seven eight nine ten"
    benchmark = frame([(1, item), (2, "just these"), (None, "four more words here")], "item_id")
    long = "filler " * 100_000 + item
    rows = [(1, f"a b c {item} d"), (1, f"a b c {item} d"), (None, item), (2, "well just THESE words"), (3, long), (4, "four more words here")]
    found = sorted(map(tuple, find_leaks(frame(rows), benchmark).select("doc_id", "item_id", "start", "n_words").collect()), key=repr)
    assert found == sorted([(1, 1, 3, 10), (1, 1, 3, 10), (None, 1, 0, 10), (2, 2, 1, 2), (3, 1, 100_000, 10), (4, None, 0, 4)], key=repr)
    assert find_leaks(frame([]), benchmark).collect() == [] and find_leaks(frame(rows), frame([], "item_id")).collect() == []
