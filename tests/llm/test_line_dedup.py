import os
import random

import pytest
from pyspark.sql import functions as F

from borelog.llm.line_dedup import SPACE, LineIndex, _table, build_filter, drop_from_filter, in_filter, with_counts


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(rows):
    rank = lambda i: 2**63 - 1 if i is None else i
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if min(held.get(key(x), {rank(i)})) == rank(i)]
        out.append((rank(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def resolved(index, docs):
    return sorted((2**63 - 1 if r[0] is None else r[0], *r[1:]) for r in index.resolve(docs).collect())


def random_rows(n, seed):
    rng = random.Random(seed)
    line = lambda: rng.choice([f"Line number {rng.randint(0, 40)} here", " short", f"\t LINE number {rng.randint(0, 40)} HERE\r", "ÄÖÜ lines äöü"])
    return [(i, "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(n)]


def test_filter_holds_and_forgets():
    keys = [os.urandom(16) for _ in range(20_000)]
    table = build_filter(keys)
    assert in_filter(table, keys).all() and in_filter(table, [os.urandom(16) for _ in range(20_000)]).mean() < 0.001
    drop_from_filter(table, keys[:5000])
    assert in_filter(table, keys[5000:]).all() and (table > 0).sum() == 15_000


def test_one_batch_with_edge_cases(spark, frame):
    rows = [*random_rows(30, 1), (None, "Line number 3 here\nonly without a number"), (None, "only without a number"), (40, None), (41, ""),
            (42, "same line same line\nsame line same line"), (43, "Same line same line"), (42, "same line same line"), (44, "x" * 300_000)]
    index = LineIndex(spark)
    index.insert(frame(rows))
    assert resolved(index, frame(rows)) == brute(rows)


def test_empty_table(spark, frame):
    index = LineIndex(spark)
    index.insert(frame([]))
    assert resolved(index, frame([])) == []


def state(index):
    """Counts and references as the index holds them."""
    counts = {bytes(r.key): (r.owner, r.refs) for r in index.counts().collect()}
    held = {}
    for r in index.references().collect():
        held.setdefault(bytes(r.key), []).append(r.id)
    return counts, held


def check(index):
    """Counts agree with references, no reference is there twice, and the filters hold every key and nothing else."""
    counts, held = state(index)
    assert counts == {k: (min(ids), len(ids)) for k, ids in held.items()}
    assert all(len(ids) == len(set(ids)) for ids in held.values())
    filters = {r.shard: r for r in index.filters().collect()}
    assert sum(r.n_keys for r in filters.values()) == len(counts)
    assert sum((_table(r.cells) > 0).sum() for r in filters.values()) == len(counts)
    by_shard = {}
    for r in index.counts().collect():
        by_shard.setdefault(r.shard, []).append(bytes(r.key))
    assert all(in_filter(_table(filters[s].cells), keys).all() for s, keys in by_shard.items())


@pytest.mark.parametrize("shard_keys", [8, 100_000])
def test_batches_and_deletions(spark, frame, shard_keys):
    rows, index = random_rows(60, 2), LineIndex(spark, shard_keys=shard_keys)
    for part in (rows[40:], rows[:20], rows[20:40]):
        index.insert(frame(part))
        check(index)
    assert resolved(index, frame(rows)) == brute(rows)
    index.delete(frame(rows[:30]).select("doc_id"))
    check(index)
    assert resolved(index, frame(rows[30:])) == brute(rows[30:])
    index.insert(frame(rows[:30]))
    check(index)
    assert resolved(index, frame(rows)) == brute(rows)


def test_index_outlives_the_object_that_made_it(spark, frame, tmp_path):
    """Only the folder is handed on, as from one process to the next."""
    rows, path = random_rows(40, 5), str(tmp_path / "index")
    LineIndex(spark, path, shard_keys=10).insert(frame(rows[:20]))
    LineIndex(spark, path, shard_keys=10).insert(frame(rows[20:]))
    LineIndex(spark, path, shard_keys=10).delete(frame(rows[5:15]).select("doc_id"))
    index, left = LineIndex(spark, path, shard_keys=10), rows[:5] + rows[15:]
    check(index)
    assert resolved(index, frame(left)) == brute(left)


def test_the_same_document_twice_and_deletions_of_nothing(spark, frame):
    rows, index = [(1, "a line of its own\nshared by both of them"), (2, "Shared by both of them")], LineIndex(spark)
    index.delete(frame(rows).select("doc_id"))
    assert index.version == 0
    index.insert(frame([]))
    index.insert(frame([(9, "short")]))
    for _ in range(2):
        index.insert(frame(rows))
    check(index)
    assert sorted(refs for _, refs in state(index)[0].values()) == [1, 2]
    version = index.version
    index.delete(frame([(77, "")]).select("doc_id"))
    index.delete(frame([]).select("doc_id"))
    assert index.version == version
    index.delete(frame(rows).select("doc_id"))
    check(index)
    assert state(index) == ({}, {}) and resolved(index, frame(rows)) == [(i, t.count("\n") + 1, 0, t) for i, t in rows]
    index.insert(frame(rows))
    assert resolved(index, frame(rows)) == brute(rows)


def test_a_key_gets_its_next_owner(spark, frame):
    rows = [(i, f"the line that all of them hold\nnumber {i} is alone with this") for i in range(6)]
    index = LineIndex(spark)
    index.insert(frame(rows))
    for n in (1, 3):
        index.delete(frame(rows[:n]).select("doc_id"))
        check(index)
        assert resolved(index, frame(rows[n:])) == brute(rows[n:])


def test_what_a_filter_says_is_what_counts(spark, frame, monkeypatch):
    """A filter that denies a key it holds changes the result: the counts are reached through it."""
    rows = random_rows(30, 7)
    index = LineIndex(spark)
    index.insert(frame(rows[:15]))
    shard, = index.shards
    empty = spark.createDataFrame([(shard, 0, bytes(16))], "shard int, n_keys long, cells binary")
    monkeypatch.setattr(index, "filters", lambda shards=None: empty)
    index.insert(frame(rows[15:]))
    assert resolved(index, frame(rows)) != brute(rows)


def test_untouched_shards_are_not_read(spark, frame, tmp_path):
    rows = random_rows(40, 9)
    index = LineIndex(spark, str(tmp_path / "index"), shard_keys=4)
    index.insert(frame(rows))
    more = [(90, "Line number 3 here\nsomething entirely new")]
    touched = {r[0] for r in frame(more).select(F.explode(F.split("text", "\n")).alias("line")).select(
        F.unhex(F.substring(F.sha2(F.lower("line"), 256), 1, 32)).alias("key")).select(index._shard()).collect()}
    assert len(index.shards) > 2 * len(touched)
    for table in ("refs", "counts", "filters"):
        for file in (tmp_path / "index" / table).glob("generation=*/shard=*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in touched:
                file.rename(file.with_suffix(".away"))
    index.insert(frame(more))
    for file in (tmp_path / "index").glob("*/generation=*/shard=*/*.away"):
        file.rename(file.with_suffix(".parquet"))
    check(index)
    assert resolved(index, frame(rows + more)) == brute(rows + more)


def test_a_change_that_dies_changes_nothing(spark, frame, tmp_path, monkeypatch):
    rows, path = random_rows(30, 11), str(tmp_path / "index")
    index = LineIndex(spark, path)
    index.insert(frame(rows[:20]))
    write = LineIndex._write

    def die(self, table, *rest):
        if table == "filters":
            raise KeyboardInterrupt
        return write(self, table, *rest)

    monkeypatch.setattr(LineIndex, "_write", die)
    with pytest.raises(KeyboardInterrupt):
        index.insert(frame(rows[20:]))
    monkeypatch.undo()
    again = LineIndex(spark, path)
    check(again)
    assert resolved(again, frame(rows[:20])) == brute(rows[:20])
    again.insert(frame(rows[20:]))
    check(again)
    assert resolved(again, frame(rows)) == brute(rows)


def test_rows_of_a_common_line_are_not_shuffled_by_it(spark, monkeypatch):
    """A line of nearly all rows is joined where its rows are; no task of the join reads more than the rare ones."""
    monkeypatch.setattr("borelog.llm.line_dedup.HOT_REFS", 100)
    rows = spark.range(20_000).selectExpr("unhex(IF(id % 20 > 0, '00', hex(id + 1000))) AS key", "id").repartition(16)
    counts = rows.groupBy("key").agg(F.count("*").alias("refs"), F.min("id").alias("owner"))
    joined = with_counts(rows, counts, 20_000)
    assert joined.count() == 20_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
    cold = joined.where("refs <= 100").groupBy(F.spark_partition_id()).count()
    assert cold.agg(F.sum("count")).first()[0] == 1000


def test_query_asks_the_filters(spark, monkeypatch):
    """The registered query puts documents in by more than one batch, so that the filters are read."""
    from borelog.llm import line_dedup, queries

    asked, ask = [], line_dedup.LineIndex.ask

    def counted(self, keys, shards):
        asked.append({r.maybe for r in ask(self, keys, shards).select("maybe").distinct().collect()})
        return ask(self, keys, shards)

    monkeypatch.setattr(line_dedup.LineIndex, "ask", counted)
    queries.op2_line_dedup(spark, "/root/testdata/sf0.001")
    assert asked == [{True, False}]


def test_a_full_filter_is_made_anew(spark, frame):
    index = LineIndex(spark)
    index.insert(frame([(1, "the first line of all\nand another")]))
    before = len(index.filters().first().cells)
    rows = [(2, "\n".join(f"a line that is new to it {i}" for i in range(200)))]
    index.insert(frame(rows))
    check(index)
    assert len(index.filters().first().cells) > before
