"""Ingest in batches: a run that dies is told from one that finished, and its files are taken up again, once."""

import pytest

import borelog.sources.ledger as ledger_module
from borelog.sources.ledger import ingest, read_ingested, read_ledger
from borelog.sources.manifest import ingest_manifest, ingest_report, tree_listing
from test_sources import write_episode


@pytest.fixture
def place(tmp_path):
    write_episode(tmp_path / "raw" / "0", "WELL-00019_a.parquet")
    write_episode(tmp_path / "raw" / "0", "WELL-00019_b.parquet", unit="ms")
    write_episode(tmp_path / "raw" / "8" / "0", "WELL-00019_a.parquet", unit="us", states=(8, 8))
    return str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ledger")


def states(spark, ledger):
    return sorted((r.path.rsplit("raw/", 1)[1], r.state) for r in read_ledger(spark, ledger).collect())


def rows_by_file(spark, out, ledger):
    counts = read_ingested(spark, out, ledger).groupBy("source_file").count().collect()
    return {r.source_file.rsplit("raw/", 1)[1]: r["count"] for r in counts}


ALL = {"0/WELL-00019_a.parquet": 3, "0/WELL-00019_b.parquet": 3, "8/0/WELL-00019_a.parquet": 4}


def test_every_file_once_over_several_runs(spark, place, tmp_path):
    root, out, ledger = place
    assert read_ingested(spark, out, ledger).isEmpty() and read_ledger(spark, ledger).isEmpty()
    first = ingest(spark, root, out, ledger, max_files=2)
    second = ingest(spark, root, out, ledger)
    assert first and second and first != second and ingest(spark, root, out, ledger) is None
    assert rows_by_file(spark, out, ledger) == ALL
    assert states(spark, ledger) == [(f, "done") for f in sorted(ALL)]
    write_episode(tmp_path / "raw" / "0", "WELL-00031_c.parquet")
    assert ingest(spark, root, out, ledger) and len(rows_by_file(spark, out, ledger)) == 4
    manifest = ingest_manifest(
        tree_listing(spark, root).selectExpr("name", "path", "path AS download_url", "size", "subdir", "'file' AS type").union(
            spark.sql("SELECT d, d, NULL, 0L, NULL, 'dir' FROM VALUES ('0'), ('8') AS t(d)")),
        read_ledger(spark, ledger).where("state = 'done'"),
    )
    assert ingest_report(manifest).first().new_files == 0


@pytest.mark.parametrize("dies_at", ["rows", "commit"])
def test_a_run_that_dies(spark, place, monkeypatch, dies_at):
    root, out, ledger = place
    ingest(spark, root, out, ledger, max_files=1)
    write = ledger_module.write_batch

    def die(episodes, folder):
        if dies_at == "commit":
            write(episodes, folder)
        raise KeyboardInterrupt

    monkeypatch.setattr(ledger_module, "write_batch", die)
    with pytest.raises(KeyboardInterrupt):
        ingest(spark, root, out, ledger)
    monkeypatch.undo()
    assert rows_by_file(spark, out, ledger) == {f: ALL[f] for f in sorted(ALL)[:1]}
    assert states(spark, ledger) == [(f, state) for f, state in zip(sorted(ALL), ["done", "started", "started"])]
    assert ingest(spark, root, out, ledger)
    assert rows_by_file(spark, out, ledger) == ALL
    assert [s for s in states(spark, ledger) if s[1] == "done"] == [(f, "done") for f in sorted(ALL)]
    assert ingest(spark, root, out, ledger) is None


def test_unreadable_files_are_noted_and_taken_up_when_replaced(spark, place, tmp_path):
    root, out, ledger = place
    torn = tmp_path / "raw" / "0" / "WELL-00050_t.parquet"
    torn.write_bytes(b"PAR1 torn")
    ingest(spark, root, out, ledger)
    assert rows_by_file(spark, out, ledger) == ALL
    assert ("0/WELL-00050_t.parquet", "unreadable") in states(spark, ledger)
    assert read_ledger(spark, ledger).where("state = 'unreadable'").first().reason
    assert ingest(spark, root, out, ledger) is None
    write_episode(tmp_path / "raw" / "0", "WELL-00050_t.parquet")
    assert ingest(spark, root, out, ledger) and rows_by_file(spark, out, ledger)["0/WELL-00050_t.parquet"] == 3


def test_pattern(spark, place):
    root, out, ledger = place
    assert ingest(spark, root, out, ledger, pattern="WELL-?????_b*") and list(rows_by_file(spark, out, ledger)) == ["0/WELL-00019_b.parquet"]
