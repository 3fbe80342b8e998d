import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from borelog.llm import toxicity
from tests.llm import test_decontamination, test_minhash

FOLDER = "/root/testdata/sf0.001"


def test_whole_run_against_brute_force(spark):
    """Each stage by plain Python on the rows of the smallest tables; only the model is shared."""
    import public_tokenizers

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] < toxicity.THRESHOLD]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for i, t in rows if last[t] == i]
    stays = {i for i, *_, kept in test_minhash.brute(rows) if kept}
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    leaks = {i for i, t in rows if i in stays and leaks_from(t, items)}
    short = [r for r in rows if r[0] in stays and len(r[1] or "") < 4000]
    assert leaks & {i for i, _ in short} == {i for i, _ in test_decontamination.brute(short, items)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    digest = lambda data: hashlib.sha256(data).hexdigest()
    wanted = {}
    for i, t in rows:
        if i in stays - leaks:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            wanted[i] = len(ids), digest(np.array(ids, "<u4").tobytes()), digest(tokenizer.decode(ids, skip_special_tokens=False).encode())
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == wanted and max(n for n, *_ in found.values()) > 1000


def leaks_from(text, items):
    """Whether a text holds a passage of an item: of its windows only those that share a shingle with the item can."""
    words = (text or "").lower().split()
    shingles = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    for _, item in items:
        own = (item or "").lower().split()
        bag = test_decontamination.bag(own)
        hits = [i for i, s in enumerate(shingles) if s in set(bag)]
        last = max(0, len(words) - len(own))
        starts = {min(max(0, s), last) for i in hits for s in range(i - len(bag) + 1, i + 1)}
        if any(test_decontamination.similar(test_decontamination.bag(words[s : s + len(own)]), bag) >= 0.75 for s in starts):
            return True
    return False


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_take_odd_rows(spark, frame, stage):
    rows = [(1, None), (2, ""), (None, "some text of no number"), (3, "plain words that are clean " * 3), (4, "word " * 100_000), (None, None)]
    docs = frame(rows)
    kept = stage(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} >= {3, None}
    assert stage(spark, frame([]), FOLDER).count() == 0


def test_last_stage(spark, frame):
    found = corpus_pipeline.encode(spark, frame([(1, None), (None, "hello")]), FOLDER).collect()
    assert {(r.doc_id, r.n_tokens) for r in found} == {(1, 0), (None, 1)}
    assert found[0].ids_sha256 == hashlib.sha256(b"").hexdigest() or found[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
