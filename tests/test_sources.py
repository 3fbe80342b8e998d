import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from borelog.operators.cleaning import clean
from borelog.plans.tables import build_table, normalise_tree, observations, process_tree
from borelog.schema import EPISODE_SCHEMA, RAW_COLUMNS, SENSORS
from borelog.sources.episodes import normalise_episodes, read_episodes, read_raw_episodes, write_normalised
from borelog.sources.manifest import ingest_manifest, ingest_report, new_files, tree_listing
from borelog.sources.tags import tag_dictionary
from borelog.sources.trees import read_table, read_tree, write_table
from borelog.schema import LISTING_SCHEMA
from borelog.streaming.ingest import ingest_new_files

START = dt.datetime(2017, 2, 1, 1, 2, 3, 456789)


def write_episode(folder, name, unit="ns", n=4, states=(0, None, 8, 0), start=START, extra=(), lacks=()):
    folder.mkdir(parents=True, exist_ok=True)
    times = [start + dt.timedelta(seconds=i) for i in range(n)]
    columns = {c: pa.array([float(i) if i % 2 else None for i in range(n)], pa.float64()) for c in RAW_COLUMNS[:-2] if c not in lacks}
    columns |= {c: pa.array([1.0] * n) for c in extra}
    columns["state"] = pa.array([states[i % len(states)] for i in range(n)], pa.int64())
    if unit == "us":
        times = [t.replace(microsecond=0) for t in times]
    columns["timestamp"] = pa.array(times, pa.timestamp("us")).cast(pa.timestamp(unit), safe=False)
    pq.write_table(pa.table(columns), folder / name, version="2.6")


@pytest.fixture
def raw_tree(tmp_path):
    root = tmp_path / "raw"
    write_episode(root / "0", "WELL-00019_20170201010203.parquet")
    write_episode(root / "0", "WELL-00019_20170301010203.parquet", unit="ms", start=START + dt.timedelta(days=28))
    write_episode(root / "8" / "deep", "WELL-00002_20170201010203.parquet", unit="us", extra=("P-NEW",))
    write_episode(root / "8", "DRAWN_00001.parquet")
    write_episode(root / "3", "SIMULATED_00001.parquet")
    return root


def test_mixed_timestamp_precisions_are_cut_to_the_millisecond(spark, raw_tree):
    rows = read_raw_episodes(spark, str(raw_tree))
    assert rows.count() == 20
    first = {r[0].rsplit("/", 1)[1]: r[1] for r in rows.groupBy("source_file").agg({"timestamp": "min"}).collect()}
    millis = START.replace(microsecond=456000)
    assert first["WELL-00019_20170201010203.parquet"] == millis
    assert first["WELL-00019_20170301010203.parquet"] == millis + dt.timedelta(days=28)
    assert first["WELL-00002_20170201010203.parquet"] == START.replace(microsecond=0)


def test_normalised_tree_keeps_provenance_and_feeds_the_table(spark, raw_tree, tmp_path):
    out = str(tmp_path / "clean")
    normalise_tree(spark, str(raw_tree), out)
    episodes = read_episodes(spark, out)
    assert [(f.name, f.dataType) for f in episodes.schema][:-1] == [(f.name, f.dataType) for f in EPISODE_SCHEMA]
    assert episodes.count() == 15 and episodes.where("state IS NULL").isEmpty()
    kept = clean(episodes)
    assert len(kept.columns) == 13
    assert {r.well_number: r["count"] for r in kept.groupBy("well_number").count().collect()} == {19: 6, 2: 3}

    build_table(spark, out, path=str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert set(table.columns) == set(kept.columns) and table.count() == 9
    rows = table.where("well_number = 19").orderBy("timestamp").collect()
    assert [r["P-PDG"] for r in rows] == [None, None, 3.0, 3.0, 3.0, 3.0]
    by_file = observations(spark, out, by_file=True).where("well_number = 19").orderBy("timestamp").collect()
    assert [r["P-PDG"] for r in by_file] == [None, None, 3.0, None, None, 3.0]


def test_mirrored_layout(spark, raw_tree, tmp_path):
    out = tmp_path / "mirror"
    write_normalised(normalise_episodes(read_raw_episodes(spark, str(raw_tree))), str(out), mirrored=True)
    assert {p.name for p in out.glob("subdir=*/episode=*")} == {f"episode={p.stem}" for p in raw_tree.rglob("*.parquet")}
    assert clean(read_episodes(spark, str(out))).count() == 9


def test_sensors_that_some_files_lack(spark, tmp_path):
    """Which file the schema is sampled from does not decide what is read."""
    for at, lacks in enumerate([("QGL",), ("P-PDG", "P-MON-CKGL"), ()]):
        write_episode(tmp_path / "raw" / "0", f"WELL-0000{at}_x.parquet", lacks=lacks)
    normalise_tree(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    rows = clean(read_episodes(spark, str(tmp_path / "clean")))
    seen = {r.well_number: (r[1], r[2]) for r in rows.selectExpr("well_number", "QGL", "`P-PDG` AS p").groupBy(
        "well_number").agg(F.count("QGL"), F.count("p")).collect()}
    assert seen == {0: (0, 1), 1: (1, 0), 2: (1, 1)}


def test_a_table_has_few_files_and_a_well_filter_opens_some_of_them(spark, tmp_path):
    """One well holds a third of the rows, the others are small."""
    rows = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, CAST(id % 100 AS INT)) AS well_number", "timestamp_seconds(id * 37 % 60000) AS timestamp", "rand(1) AS a")
    rows = rows.repartition(16)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        write_table(rows, "borelog_wells", str(tmp_path / "table"), buckets=8)
        files = {f.name: pq.ParquetFile(f) for f in (tmp_path / "table").glob("*.parquet")}
        assert 8 <= len(files) <= 40
        # The long well is written by several tasks, sorted by time.
        wells = {name: file.read(["well_number"])["well_number"].to_pylist() for name, file in files.items()}
        assert sum(7 in w for w in wells.values()) > 1 and max(map(len, wells.values())) < 20_000
        assert all(w == sorted(w) for w in wells.values())
        one = spark.table("borelog_wells").where("well_number = 7")
        assert one.count() == rows.where("well_number = 7").count()
        assert sorted(spark.table("borelog_wells").collect()) == sorted(rows.collect())
        # Files of other buckets are not opened: what is in them does not matter.
        bucket = {name: name.split("_")[1].split(".")[0] for name in files}
        of_seven = {bucket[name] for name, w in wells.items() if 7 in w}
        assert len(of_seven) == 1 and len(set(bucket.values())) == 8
        for name in files:
            if bucket[name] not in of_seven:
                (tmp_path / "table" / name).write_bytes(b"junk")
        spark.sql("REFRESH TABLE borelog_wells")
        assert spark.table("borelog_wells").where("well_number = 7").count() == one.count()
        with pytest.raises(Exception):
            spark.table("borelog_wells").collect()
        write_table(rows.limit(5).drop("a"), "borelog_wells", str(tmp_path / "table"), buckets=8)
        assert spark.table("borelog_wells").count() == 5 and spark.table("borelog_wells").columns == ["well_number", "timestamp"]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
        spark.sql("DROP TABLE IF EXISTS borelog_wells")


def test_tree_reading(spark, raw_tree):
    found = read_tree(spark, str(raw_tree), "WELL-00002*.parquet")
    assert found.count() == 4 and found.first().source_file.endswith("/8/deep/WELL-00002_20170201010203.parquet")
    with pytest.raises(ValueError):
        read_tree(spark, str(raw_tree), "*.csv")
    with pytest.raises(ValueError):
        read_tree(spark, str(raw_tree), "*.csv", schema="state bigint")


def test_files_are_united_by_name(spark, tmp_path):
    pq.write_table(pa.table({"a": [1], "b": ["x"]}), tmp_path / "one.parquet")
    pq.write_table(pa.table({"b": ["y"], "c": [2.0]}), tmp_path / "two.parquet")
    rows = read_tree(spark, str(tmp_path), merge_schema=True).orderBy("b").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [(1, "x", None), (None, "y", 2.0)]


def test_unreadable_files_can_be_skipped(spark, tmp_path):
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "good.parquet")
    (tmp_path / "torn.parquet").write_bytes(b"PAR1 not a parquet file")
    assert read_tree(spark, str(tmp_path), schema="a bigint", skip_corrupt=True).count() == 2
    with pytest.raises(Exception):
        read_tree(spark, str(tmp_path), schema="a bigint").count()


def test_paths_without_a_well_do_not_fail(spark, tmp_path):
    write_episode(tmp_path / "0", "elsewhere.parquet", unit="us")
    rows = process_tree(spark, str(tmp_path)).collect()
    assert len(rows) == 3 and {r.well_number for r in rows} == {None} and {r.state_name for r in rows} >= {"Normal"}


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.sql("SELECT 1 AS well_number, 2 AS a"), path=path)
    write_table(spark.sql("SELECT 7 AS well_number, 'x' AS b"), path=path)
    assert spark.read.parquet(path).first().asDict() == {"b": "x", "well_number": 7}


def test_named_table(spark, tmp_path):
    spark.sql("SELECT 1 AS well_number, 2 AS a").createOrReplaceTempView("named_rows")
    write_table(spark.table("named_rows"), table="borelog_named", path=str(tmp_path / "named"), by_well=False)
    try:
        assert read_table(spark, "borelog_named").count() == 1
    finally:
        spark.sql("DROP TABLE borelog_named")


def test_dictionary(spark):
    rows = tag_dictionary(spark).collect()
    assert len(rows) == 7 and len({r.tag for r in rows} & set(SENSORS)) == 6


LISTING = [
    ("README.md", "README.md", None, 10, None, "file"),
    ("a", "a", None, 0, None, "dir"),
    ("b", "b", None, 0, None, "dir"),
    ("top.parquet", "top.parquet", "u", 5, None, "file"),
    ("1.parquet", "a/1.parquet", "u", 100, "a", "file"),
    ("2.parquet", "a/2.parquet", "u", 200, "a", "file"),
    ("notes.txt", "a/notes.txt", "u", 1, "a", "file"),
    ("sub.parquet", "a/sub.parquet", None, 0, "a", "dir"),
    ("1.parquet", "b/1.parquet", "u", 400, "b", "file"),
]


@pytest.mark.parametrize(
    "max_dirs, max_files, processed, new, size",
    [
        (None, None, {"a/1.parquet", "a/2.parquet", "b/1.parquet"}, 2, 500),
        (0, -1, {"a/1.parquet", "a/2.parquet", "b/1.parquet"}, 2, 500),
        (2, None, {"a/1.parquet", "a/2.parquet"}, 1, 100),  # the README is one of the two entries
        (1, None, set(), 0, 0),
        (None, 1, {"a/1.parquet"}, 1, 100),
    ],
)
def test_manifest(spark, max_dirs, max_files, processed, new, size):
    listing = spark.createDataFrame(LISTING, LISTING_SCHEMA)
    ledger = spark.createDataFrame([("a", "2.parquet"), ("a", "2.parquet"), ("z", "1.parquet")], "subdir string, name string")
    manifest = ingest_manifest(listing, ledger, max_dirs, max_files)
    assert {r.path for r in manifest.collect()} == processed
    assert new_files(manifest).count() == new
    assert ingest_report(manifest).first()[:] == (len(processed), len(processed) - new, new, size)


def test_listing_of_a_tree(spark, raw_tree):
    found = {(r.subdir, r.name) for r in tree_listing(spark, str(raw_tree)).collect()}
    assert ("deep", "WELL-00002_20170201010203.parquet") in found and len(found) == 5


def test_streaming_ingest_takes_each_file_once(spark, raw_tree, tmp_path):
    out, seen = str(tmp_path / "clean"), str(tmp_path / "seen")

    def run():
        query = ingest_new_files(spark, str(raw_tree), out, seen, max_files=2)
        assert query.awaitTermination(120)
        return clean(read_episodes(spark, out)).count()

    assert run() == 9
    assert run() == 9
    write_episode(raw_tree / "0", "WELL-00031_20180101000000.parquet")
    assert run() == 12
