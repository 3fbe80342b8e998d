import datetime as dt
import statistics

import numpy as np
import pytest

from borelog.operators.cleaning import clean
from borelog.operators import features
from borelog.operators.features import series_features
from borelog.operators.ordering import row_range, seeded_sample, sort_series, top_k
from borelog.operators.splitting import split_by_time, split_classes, stratified_split
from borelog.operators.summaries import null_census, profile, well_failure_counts, well_time_bounds


def test_null_census_ignores_nan(episode_rows):
    assert null_census(episode_rows).first().asDict() == {
        "timestamp": 1, "P-PDG": 4, "QGL": 4, "state": 1, "source_file": 0,
    }
    assert null_census(episode_rows.limit(0)).first()["state"] is None


def test_failure_counts_keep_unknown_codes_apart(episode_rows):
    rows = clean(episode_rows)
    found = sorted(map(str, well_failure_counts(rows, 19).select("failure_type", "failure_count").collect()))
    assert len(found) == 3 and sum("None" in r for r in found) == 1
    assert well_failure_counts(rows).groupBy().sum("failure_count").first()[0] == rows.count()


def test_bounds_and_profile(episode_rows, at):
    rows = clean(episode_rows)
    bounds = {r.well_number: (r.min_timestamp, r.max_timestamp) for r in well_time_bounds(rows).collect()}
    assert bounds == {19: (at(0), at(2)), 29: (at(0), at(4)), None: (at(6), at(7))}
    assert profile(rows).first()[:4] == (7, len(rows.columns), 2, 4)
    assert profile(rows.limit(0)).first()[0] == 0


def test_ordering(spark):
    rows = spark.createDataFrame([(i * 7 % 50, i) for i in range(50)], "well_number int, timestamp int")
    assert [r.well_number for r in top_k(rows, "well_number", 3).collect()] == [49, 48, 47]
    assert [r.timestamp for r in row_range(rows, 5, 9, "timestamp").collect()] == [5, 6, 7, 8]
    assert [r.well_number for r in sort_series(rows).collect()] == list(range(50))
    first = seeded_sample(rows.repartition(3), ["timestamp"]).collect()
    assert first == seeded_sample(rows.repartition(7), ["timestamp"]).collect() and len(first) == 5
    assert first != seeded_sample(rows, ["timestamp"], seed=1).collect()


@pytest.mark.parametrize("n", [10, 1003, 350_000])
def test_split_is_exact_per_label(spark, n):
    rows = spark.range(n).selectExpr("id AS well_number", "IF(id % 3 > 0, 0, CAST(id % 5 AS INT)) AS state")
    split = stratified_split(rows, keys=("well_number",)).groupBy("state").agg(
        {"is_test": "count", "*": "count"}
    )
    parts = stratified_split(rows, keys=("well_number",)).selectExpr("state", "CAST(is_test AS INT) AS t").groupBy("state").agg(
        {"t": "sum", "*": "count"}
    )
    assert split.count() > 0
    for r in parts.collect():
        assert r["sum(t)"] == int(r["count(1)"] * 0.2 + 0.5)


def test_split_runs_nothing_while_it_is_planned(spark, tmp_path):
    spark.range(5000).selectExpr("id AS well_number", "CAST(id % 3 AS INT) AS state").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema("well_number bigint, state int").parquet(str(tmp_path / "rows"))
    spark.sparkContext.setJobGroup("split", "planning a split")
    split = stratified_split(rows, keys=("well_number",))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("split")
    assert split.where("is_test").count() == 3 * 333
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    # Two passes over two narrow columns, then the rows; neither is shuffled by label.
    assert plan.count("Relation [") == 3 and plan.count("strategy=broadcast") == 2
    spark.sparkContext.setJobGroup("default", "")


def test_split_of_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr("borelog.operators.splitting.BROADCAST_ROWS", 10)
    rows = spark.range(1000).selectExpr("id AS well_number", "CAST(id % 11 AS INT) AS state")
    with pytest.raises(Exception, match="at most 10 labels"):
        stratified_split(rows, keys=("well_number",)).collect()


def test_split_keeps_copies_together(spark):
    rows = spark.range(3000).selectExpr("IF(id < 1000, 0, id) AS well_number", "1 AS state")
    split = stratified_split(rows, keys=("well_number",))
    assert split.groupBy("well_number").agg({"is_test": "count"}).count() == 2001
    assert split.where("well_number = 0").select("is_test").distinct().count() == 1
    assert split.where("is_test").count() >= 600


def test_split_keeps_unlabelled_rows_as_a_stratum(spark):
    rows = spark.range(100).selectExpr("id AS well_number", "IF(id < 50, NULL, 1) AS state")
    assert stratified_split(rows, keys=("well_number",)).where("is_test").count() == 20
    assert {r.n_rows for r in split_classes(stratified_split(rows, keys=("well_number",))).collect()} == {20, 80}


def test_split_by_time(spark, at):
    rows = spark.createDataFrame([(at(s),) for s in range(10)], "timestamp timestamp")
    assert split_by_time(rows, at(7)).where("is_test").count() == 3


@pytest.mark.parametrize("max_series_rows", [1_000_000, 3])
def test_features_on_every_plan(spark, max_series_rows):
    values = {1: [3.0, -9.0, 4.5, None, 2.0], 2: [7.0] * 500 + [1.0] * 400 + [8.0], 3: [None], None: [5.0, 6.0]}
    rows = spark.createDataFrame(
        [(w, v) for w, listed in values.items() for v in listed], "well_number int, a double"
    )
    found = {r.well_number: r for r in series_features(rows, ["a"], max_series_rows=max_series_rows).collect()}
    assert set(found) == set(values)
    for well, listed in values.items():
        numbers, row = [v for v in listed if v is not None], found[well]
        assert row.length == len(numbers)
        if not numbers:
            assert row.sum_values is None and row["median"] is None
            continue
        assert row["median"] == statistics.median(numbers)
        assert row["mean"] == pytest.approx(statistics.fmean(numbers))
        assert row.variance == pytest.approx(statistics.pvariance(numbers))
        assert row.standard_deviation == pytest.approx(statistics.pstdev(numbers))
        assert row.root_mean_square == pytest.approx(statistics.fmean(v * v for v in numbers) ** 0.5)
        assert (row.minimum, row.maximum) == (min(numbers), max(numbers))
        assert row.absolute_maximum == max(map(abs, numbers))


@pytest.mark.parametrize("value", ["pow(hash(id) / 1e6, 3)", "id % 7", "IF(id % 2 = 0, 1e-300, 1e300)", "5.0"])
def test_median_of_a_long_series(spark, value):
    rows = spark.range(300_000).selectExpr("IF(id % 3 > 0, 1, CAST(id % 5 AS INT)) AS well_number", f"CAST({value} AS DOUBLE) AS a")
    plain = {r.well_number: r["median"] for r in series_features(rows, ["a"], max_series_rows=10**9).collect()}
    long = {r.well_number: r["median"] for r in series_features(rows, ["a"], max_series_rows=10).collect()}
    assert long == plain


def test_median_of_special_numbers(spark):
    """NaN is the largest number, -0.0 is 0.0; the middle of an even count lies between two numbers, however far apart."""
    nan, inf = float("nan"), float("inf")
    series = {
        1: [nan, nan, 1.0], 2: [nan, 1.0, 2.0, nan], 3: [-0.0, 0.0, -0.0, 0.0], 4: [-1.0, -0.0], 5: [inf, -inf], 6: [-inf, 5.0, inf],
        7: [1.7e308, 1.6e308], 8: [5e-324, 0.0], 9: [5e-324, 5e-324, 1e-320], 10: [-1.5, -1.5, 2.5, 2.5], 11: [None, 3.0], 12: [None, None, None],
        13: [-3.0, -2.0, -1.0, None], 14: [1.0, np.nextafter(1.0, 2.0)], 15: [7.0] * 9 + [8.0] * 9, None: [4.0, 6.0, None],
    }
    rows = [(w, None if v is None else float(v), None if v is None else -float(v)) for w, listed in series.items() for v in listed]
    frame = spark.createDataFrame(rows, "well_number int, a double, b double").repartition(5)
    found, wanted = (
        sorted((repr(r.well_number), r.tag, repr(None if r["median"] is None else r["median"] + 0.0)) for r in series_features(frame, ["a", "b"], max_series_rows=n).collect())
        for n in (0, 10**9)
    )
    assert found == wanted and len(found) == 32


def test_only_long_series_are_searched(spark):
    rows = spark.range(5000).selectExpr("IF(id < 4000, 1, CAST(id AS INT)) AS well_number", "rand(5) AS a", "-rand(6) AS b")
    plain = series_features(rows, ["a", "b"]).collect()
    assert sorted(map(str, series_features(rows, ["a", "b"], max_series_rows=100).select("well_number", "tag", "median", "length").collect())) == sorted(
        str(r) for r in spark.createDataFrame(plain).select("well_number", "tag", "median", "length").collect())
    plan = series_features(rows, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "percentile_approx" not in plan and plan.count("Aggregate") == 1


def test_ordered_bits():
    values = np.array([-np.inf, -1.7e308, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.7e308, np.inf, np.nan, -np.nan])
    bits = features.ordered_bits(values)
    assert (np.diff(bits[[0, 1, 2, 3, 4, 6, 7, 8, 9, 10]]) > 0).all() and bits[4] == bits[5] and bits[10] == bits[11]
    assert np.array_equal(features.from_ordered_bits(bits), values, equal_nan=True)
