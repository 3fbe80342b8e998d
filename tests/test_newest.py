import re

import pytest
from pyspark.sql import functions as F

from borelog.functions.table_functions import register_functions
from borelog.operators.filling import forward_fill
from borelog.operators.newest import latest_n_obs, most_recent_obs, newest_per_group
from borelog.operators.ordering import seeded_key, seeded_sample
from borelog.operators.splitting import stratified_split
from borelog.schema import SENSORS
from borelog.sources.trees import write_table

SCHEMA = (
    "well_number int, timestamp timestamp, `T-JUS-CKP` double, `T-TPT` double, `P-TPT` double, `P-MON-CKP` double,"
    " `P-PDG` double, QGL double, state int, source_file string"
)


def table(spark, at, rows):
    return spark.createDataFrame([(w, at(s), 1.0, 2.0, 3.0, 4.0, float(s), 6.0, st, f) for w, s, st, f in rows], SCHEMA)


def test_cap_hides_quiet_wells(spark, at):
    rows = table(spark, at, [(1, s, 0, "f") for s in range(1000, 2200)] + [(2, 5, 0, "g")])
    assert {r.well_number for r in latest_n_obs(rows, scan_cap=1000).collect()} == {1}
    assert {r.well_number for r in latest_n_obs(rows).collect()} == {1, 2}
    assert [r["P-PDG"] for r in latest_n_obs(rows, well=2).collect()] == [5.0]


def test_capped_is_contained_in_uncapped(spark, at):
    rows = table(spark, at, [(s % 7, s * 13 % 997, 0, "f") for s in range(900)])
    capped, full = latest_n_obs(rows, scan_cap=20), latest_n_obs(rows, scan_cap=None)
    assert capped.exceptAll(full).isEmpty() and capped.count() < full.count()


def test_n_beyond_the_rows_and_absent_well(spark, at):
    rows = table(spark, at, [(1, s, 0, "f") for s in range(3)])
    assert latest_n_obs(rows, n=50).count() == 3
    assert latest_n_obs(rows, well=1023).count() == 0


def test_long_lists_of_long_groups(spark, at):
    rows = table(spark, at, [(1, s, 0, f"f{s % 3}") for s in range(6000)])
    kept = newest_per_group(rows, ["well_number"], 2500)
    assert sorted(r["P-PDG"] for r in kept.collect()) == [float(s) for s in range(3500, 6000)]


def test_newest_row_of_every_state_with_ties_by_file(spark, at):
    rows = table(spark, at, [(1, 1, 0, "a"), (1, 2, 0, "c"), (1, 2, 0, "b"), (1, 0, None, "a"), (None, 9, 0, "n")])
    found = {(r.well_number, r.state): r.source_file for r in most_recent_obs(rows).collect()}
    assert found == {(1, 0): "b", (1, None): "a", (None, 0): "n"}


def test_sql_functions_agree_with_the_operators(spark, at):
    rows = table(spark, at, [(s % 5, s * 31 % 1009, s % 3, "f") for s in range(1000)])
    rows.createOrReplaceTempView("well_rows")
    register_functions(spark, "well_rows")
    same = lambda sql, df: sorted(map(tuple, spark.sql(sql).collect())) == sorted(map(tuple, df.collect()))
    assert same("SELECT * FROM latest_n_obs()", latest_n_obs(rows))
    assert same("SELECT * FROM latest_n_obs(3, 2)", latest_n_obs(rows, 3, 2))
    assert same("SELECT * FROM latest_n_obs(n_obs_param => 7)", latest_n_obs(rows, n=7))
    assert same("SELECT * FROM most_recent_obs(well_number_param => 4)", most_recent_obs(rows, 4))
    assert spark.sql("SELECT * FROM well_time_bounds(2)").count() == 1
    assert spark.sql("SELECT sum(failure_count) FROM well_failure_counts()").first()[0] == 1000
    assert spark.sql("SELECT state_name(8), state_name(9)").first()[:] == ("Hydrate in Production Line", None)
    plan = spark.sql("SELECT * FROM latest_n_obs(3)")._jdf.queryExecution().optimizedPlan().toString()
    assert "well_number" in plan and "= 3" in plan and "-1" not in plan


@pytest.mark.parametrize("n", [1, 3, 40, 2000])
def test_pruned_days_change_nothing(spark, at, n):
    rows = [(s % 3, s * 7919 % 900_000, s % 2, f"f{s % 4}") for s in range(500)] + [(9, 1, 0, "f"), (None, 5, 1, "g")]
    frame = table(spark, at, rows).union(table(spark, at, rows[:9]).withColumn("timestamp", F.lit(None).cast("timestamp")))
    plain = newest_per_group(frame, ["well_number", "state"], n, ["source_file", "P-PDG"])
    pruned = newest_per_group(frame, ["well_number", "state"], n, ["source_file", "P-PDG"], prune_days=True)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, pruned.collect()))


def test_permanent_functions_over_a_table(spark, at, tmp_path):
    rows = table(spark, at, [(s % 5, s, s % 3, "f") for s in range(100)])
    write_table(rows, "borelog_wells", str(tmp_path / "wells"))
    names = ("latest_n_obs", "most_recent_obs", "well_time_bounds", "well_failure_counts", "state_name")
    for name in names:
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    register_functions(spark, "borelog_wells", temporary=False, schema="default")
    try:
        found = spark.sql("SELECT * FROM latest_n_obs(well_number_param => 3, n_obs_param => 2)")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, latest_n_obs(rows, 3, 2).collect()))
        assert spark.sql("SELECT default.state_name(0)").first()[0] == "Normal"
    finally:
        for name in names:
            spark.sql(f"DROP FUNCTION IF EXISTS default.{name}")
        spark.sql("DROP TABLE borelog_wells")


def test_ties_do_not_follow_input_order(spark, at):
    """Rows of one well, time and file differ in their readings only."""
    row = lambda v: (at(0), float(v), 1.0, 1.0, 1.0, 1.0, 1.0, 0, 1, "f")
    columns = "timestamp timestamp, `P-PDG` double, `T-JUS-CKP` double, `T-TPT` double, `P-TPT` double, `P-MON-CKP` double, `QGL` double, state int, well_number int, source_file string"
    results = set()
    for values in (range(8), reversed(range(8)), [3, 1, 7, 0, 2, 6, 5, 4]):
        rows = spark.createDataFrame([row(v) for v in values], columns)
        rows.createOrReplaceTempView("tied")
        register_functions(spark, "tied")
        found = [latest_n_obs(rows, n=2), most_recent_obs(rows), latest_n_obs(rows, n=2000, scan_cap=4)]
        found += [spark.sql("SELECT * FROM latest_n_obs(-1, 2)"), spark.sql("SELECT * FROM most_recent_obs()")]
        results.add(tuple(tuple(sorted(r["P-PDG"] for r in f.collect())) for f in found))
    assert len(results) == 1


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
def test_samples_and_fills_do_not_follow_the_session_time_zone(spark, at, zone):
    rows = spark.range(200).selectExpr("id AS well_number", "timestamp_micros(1700000000000000 + id * 3600000000) AS timestamp", "IF(id % 3 = 0, id, NULL) AS v")
    rows = rows.withColumn("well_number", F.lit(1))
    sample = lambda: {r.v for r in seeded_sample(rows, ["well_number", "timestamp"], 20).collect()}
    fill = lambda: sorted(str(r.v) for r in forward_fill(rows, max_chunk_rows=20).collect())
    split = lambda: stratified_split(rows.withColumn("state", F.lit(0)), keys=("well_number", "timestamp")).where("is_test").agg(F.sum("v")).first()[0]
    before = sample(), fill(), split()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert (sample(), fill(), split()) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_keys_have_their_own_hash(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert rows.select(seeded_key(rows, ["x", "y"], 1)).distinct().count() == 2


def test_sql_ranks_many_rows_of_a_well_in_parts(spark):
    """No window sorts all rows of a well where more than a thousand are asked for; the rows are the same."""
    rows = spark.range(40_000).selectExpr(
        "IF(id % 4 = 0, CAST(id % 7 AS INT), 1) AS well_number", "timestamp_seconds(id * 7919 % 20011) AS timestamp",
        *[f"CAST(id AS DOUBLE) AS `{c}`" for c in SENSORS], "0 AS state", "'f' AS source_file",
    )
    rows.createOrReplaceTempView("many_rows")
    register_functions(spark, "many_rows")
    for n in (3, 1500):
        found = spark.sql(f"SELECT * FROM latest_n_obs(n_obs_param => {n})")
        assert sorted(found.collect()) == sorted(latest_n_obs(rows, n=n).collect())
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
        # The rows pass the ranking in parts before the one of whole wells.
        assert len(windows) == 2 and bool(re.search(r"\bpart#", windows[1])) == (n > 1000)
