import math

from borelog.functions.states import add_state_name, state_name
from borelog.operators.cleaning import add_provenance, clean, for_well, in_wells, model_columns
from borelog.schema import STATE_NAMES
from borelog.sources.tags import tags_long


def test_provenance_is_read_off_the_path(episode_rows):
    tagged = {r.source_file: r for r in add_provenance(episode_rows).collect()}
    assert tagged["/e/0/WELL-00019_a.parquet"].well_number == 19
    assert tagged["/e/0/elsewhere.parquet"].well_number is None
    assert tagged["/e/0/DRAWN_00001.parquet"].is_drawn and not tagged["/e/0/DRAWN_00001.parquet"].is_simulated
    assert tagged["/e/0/SIMULATED_00001.parquet"].is_simulated


def test_marks_are_case_sensitive(spark):
    row = add_provenance(spark.createDataFrame([("/well-1/drawn_simulated",)], "source_file string")).first()
    assert (row.is_drawn, row.is_simulated, row.well_number) == (False, False, None)


def test_clean_drops_unlabelled_untimed_and_synthetic_rows(episode_rows):
    assert clean(episode_rows).count() == 7
    kept = clean(episode_rows, drop_synthetic=False)
    assert kept.count() == 9
    assert kept.where("is_drawn OR is_simulated").count() == 2


def test_well_parameters(episode_rows):
    rows = clean(episode_rows)
    assert for_well(rows).count() == 7
    assert for_well(rows, 19).count() == 3
    assert for_well(rows, 1023).count() == 0
    assert in_wells(rows).count() == 5
    assert in_wells(rows, [29]).count() == 2


def test_state_names(spark):
    rows = spark.createDataFrame([(c,) for c in [*range(9), 9, 101, -1, None]], "state int")
    named = {r.state: r.state_name for r in add_state_name(rows).collect()}
    assert [named[c] for c in range(9)] == list(STATE_NAMES)
    assert {named[c] for c in (9, 101, -1, None)} == {"Unknown"}
    assert rows.select(state_name("state").alias("n")).where("n IS NULL").count() == 4


def test_state_may_be_stored_as_double(spark):
    assert spark.createDataFrame([(8.0,)], "state double").select(state_name("state")).first()[0] == STATE_NAMES[8]


def test_long_form_keeps_tags_without_an_entry(spark, at):
    rows = spark.createDataFrame([(1, at(0), 2.0, None)], "well_number int, timestamp timestamp, `P-PDG` double, `P-JUS-CKP` double")
    long = {r.tag: r for r in tags_long(rows, ["P-PDG", "P-JUS-CKP"]).collect()}
    assert (long["P-PDG"].value, long["P-PDG"].unit, long["P-PDG"].tag_id) == (2.0, "Pa", 1)
    assert long["P-JUS-CKP"].name is None and long["P-JUS-CKP"].value is None


def test_model_columns(spark, at):
    rows = spark.createDataFrame(
        [(at(0), 1.0, 2.0, 3.0, 4.0, 5.0, math.nan, 19, 8, "x")],
        "timestamp timestamp, `P-PDG` double, `P-TPT` double, `T-TPT` double, `P-MON-CKP` double,"
        " `T-JUS-CKP` double, QGL double, well_number int, state int, other string",
    )
    assert model_columns(rows).columns == [
        "timestamp", "P-PDG", "P-TPT", "T-TPT", "P-MON-CKP", "T-JUS-CKP", "QGL", "well_number", "state",
    ]
