import random

import numpy as np
import pytest

from borelog.llm.minhash import components, near_groups, pairs, superminhash
from borelog.llm.spread import spread_join

SPACE = " \t\n\x0b\x0c\r"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}
    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and common and 100 * common >= 75 * len(sets[i] | sets[j]) and part[i] != part[j]:
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = {k: new if v == old else v for k, v in part.items()}
    return sorted((i, len(sets[i]), part[i], i == part[i]) for i in sets)


def family(rng, size, edits, start):
    base, rows = [f"w{rng.randint(0, 500)}" for _ in range(120)], []
    for k in range(size):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 500)}"
        rows.append((start + k, " ".join(words)))
    return rows


def test_signatures_estimate_similarity_and_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    for n in (1, 3, 30, 400):
        a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for _ in range(2))
        b[: n // 2] = a[: n // 2]
        b = np.unique(b)
        both = superminhash([a, b], 128)
        assert (both[0] == superminhash([a], 128)[0]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((both[0] == both[1]).mean() - true) < 0.2


@pytest.mark.parametrize("block_shingles", [1 << 16, 600])
def test_against_brute_force(frame, block_shingles):
    """The small block makes cells of many blocks, with movers that are compared across them."""
    rng = random.Random(3)
    rows = [*family(rng, 60, 12, 0), *family(rng, 30, 3, 100), *family(rng, 10, 40, 200)]
    rows += [(300, "one two"), (301, "ONE\ttwo"), (302, "one two three"), (303, rows[5][1]), (304, rows[70][1].upper())]
    found = near_groups(frame(rows), block_shingles=block_shingles).drop("sha").collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (None, "a b c d e f"), (5, "A b c d e f"), (5, "A b c d e f"), (6, "z " * 200_000), (7, "z " * 100)]
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_groups(frame(rows)).drop("sha").collect()}
    assert found == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (None, 2, None, True), (5, 2, 4, False), (6, 1, 6, True), (7, 1, 6, False)}
    assert near_groups(frame([])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(50))


def test_repeated_ids_with_other_texts_in_any_order(frame):
    """Each text of a number is linked for itself; the order of the rows does not show."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    a, b, c = ([word() for _ in range(60)] for _ in range(3))
    like = lambda words: " ".join([*words[:-1], word()])
    rows = [(1, " ".join(a)), (5, like(a)), (5, " ".join(b)), (7, like(b)), (5, " ".join(b)), (9, " ".join(c)), (1, " ".join(c)), (None, " ".join(b))]
    sizes = lambda text: len(shingles(text))
    wanted = {0: 1, 1: 1, 2: 5, 3: 5, 4: 5, 5: 1, 6: 1, 7: None}
    expected = sorted(((i, sizes(t), wanted[k], i == wanted[k]) for k, (i, t) in enumerate(rows)), key=repr)
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        assert sorted(map(tuple, near_groups(frame(rows).repartition(3)).drop("sha").collect()), key=repr) == expected


def test_hot_cells_classes_and_components_are_spread(spark, frame, monkeypatch):
    """The same groups where every key with more than four rows is hot."""
    rng = random.Random(4)
    rows = [*family(rng, 40, 6, 0), *family(rng, 20, 2, 100)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(300, None), (301, "")]
    monkeypatch.setattr("borelog.llm.spread.HOT_ROWS", 4)
    assert sorted(map(tuple, near_groups(frame(rows), block_shingles=900).drop("sha").collect())) == brute(rows)


def test_spread_join(spark, monkeypatch):
    monkeypatch.setattr("borelog.llm.spread.HOT_ROWS", 50)
    rows = spark.range(4000).selectExpr("IF(id % 4 > 0, 1, id) AS k", "id")
    table = rows.where("k <> 8").groupBy("k").count().withColumnRenamed("count", "held")
    assert spread_join(rows, table, "k", 4000).count() == 3999
    found = spread_join(rows, table, "k", 4000, left=True)
    assert found.count() == 4000 and found.where("held IS NULL").select("k").collect() == [(8,)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2


def test_pairs_of_columns_come_from_one_pass(spark):
    rows = spark.range(3).selectExpr("id AS a", "id + 10 AS b", "id + 20 AS m")
    found = pairs(rows, ("b", "m"), ("a", "m"))
    assert sorted(map(tuple, found.collect())) == [(0, 20), (1, 21), (2, 22), (10, 20), (11, 21), (12, 22)]
    assert found._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
