
from __future__ import annotations

import functools
import sys
import warnings
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from borelog.functions.scoring import register_batch_model
from borelog.functions.states import add_state_name, state_name
from borelog.functions.table_functions import register_functions
from borelog.functions.tree_sql import create_model_function
from borelog.operators import cleaning, features, metrics, newest, ordering, splitting, summaries, traces
from borelog.operators.filling import forward_fill
from borelog.plans import event_view, training
from borelog.plans.boosting import BoostingSettings, train_boosted
from borelog.schema import MODEL_FEATURES, SCAN_CAP
from borelog.plans.tables import build_table, process_tree
from borelog.sources.episodes import normalise_episodes, read_episodes, read_raw_episodes, write_normalised
from borelog.sources.ledger import ingest, read_ingested
from borelog.sources.manifest import ingest_manifest, ingest_report, new_files
from borelog.sources.tags import tags_long
from borelog.sources.trees import read_table, read_tree
from borelog.support import materialise, scratch_folder
from oracles import ORACLES

try:
    import corpus_pipeline
    import borelog.llm.queries as llm_queries
except ImportError as error:  # the text part, or a library that only it needs, is not there
    warnings.warn(f"the text operators are left out: {error}")
    corpus_pipeline = llm_queries = None


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(event_view.episodes_from_events(spark, sf_dir))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that models and table functions read."""
    return forward_fill(_clean(spark, sf_dir))


def _scored(spark, sf_dir):
    """Observations with a fixed rule in the place of a model, so that SQL can compute the same predictions."""
    pressure, temperature = F.coalesce("P-PDG", F.lit(0.0)), F.coalesce("P-TPT", F.lit(0.0))
    rule = F.when(pressure > 60, 8).when(temperature > 80, 3).otherwise(0)
    return _clean(spark, sf_dir).withColumn("prediction", rule)


def _rule_scores():
    pressure, double_pressure, gas = (F.coalesce(c, F.lit(0.0)) for c in ("P-PDG", "P-TPT", "QGL"))
    return {0: 1 / (1 + pressure), 3: double_pressure / 1000, 8: pressure / 1000, 101: gas / 1000}


def _single(df: DataFrame, *columns: str) -> DataFrame:
    """Single-precision values: the order in which an engine adds up doubles does not show in them."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


def _sql(statement: str, with_model: Callable | None = None, scan_cap: int | None = None, source: Callable = _filled):
    def run(spark, sf_dir):
        source(spark, sf_dir).createOrReplaceTempView("well_data")
        name = with_model(spark, sf_dir) if with_model else None
        register_functions(spark, "well_data", name, scan_cap)
        return spark.sql(statement)

    return run


def _per_input(make):
    """Keep what ``make`` returns for a session and folder until a file of the folder's events changes."""
    kept = {}

    @functools.wraps(make)
    def cached(spark, sf_dir):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        listed = files.load(f"{sf_dir}/events.parquet").agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")))
        key = spark, sf_dir, listed.first()[0]
        if key not in kept:
            kept[key] = make(spark, sf_dir)
        return kept[key]

    return cached


def _graded(spark, sf_dir):
    """Filled observations with a pressure in steps of ten, and the state that it alone decides."""
    pressure = F.floor(F.col("P-PDG") / 10) * 10.0
    state = F.when(pressure >= 60, 8).when(pressure >= 30, 3).otherwise(0)
    return _filled(spark, sf_dir).where(F.col("P-PDG").isNotNull()).withColumns({"P-PDG": pressure, "state": state})


@_per_input
def _graded_split(spark, sf_dir):
    """Rows for the forest, written once per session as a training job would find them, with their split."""
    return splitting.stratified_split(materialise(_graded(spark, sf_dir)))


@_per_input
def _forest(spark, sf_dir):
    return training.train_state_model(_graded_split(spark, sf_dir).where("NOT is_test"))


@_per_input
def _bare_split(spark, sf_dir):
    """Rows for the boosted trees: not filled, so that which sensor is missing tells the state."""
    return splitting.stratified_split(materialise(_clean(spark, sf_dir)))


@_per_input
def _boosted(spark, sf_dir):
    return training.train_state_model(_bare_split(spark, sf_dir).where("NOT is_test"), "boosted", num_trees=10)


@_per_input
def _graded_boosted(spark, sf_dir):
    """Trees on two states that one threshold of the pressure tells apart, so that nothing else can gain."""
    rows = _graded_split(spark, sf_dir).where("NOT is_test").withColumn("state", F.when(F.col("P-PDG") >= 60, 8).otherwise(0))
    return train_boosted(rows, settings=BoostingSettings(rounds=3, feature_share=1.0))


def _held_out(split, model):
    def scored(spark, sf_dir):
        fitted = model(spark, sf_dir)
        return training.apply_model(fitted, split(spark, sf_dir).where("is_test")), training.class_scores(fitted)

    return scored


_forest_held_out, _boosted_held_out = _held_out(_graded_split, _forest), _held_out(_bare_split, _boosted)


def _report(scored):
    return _single(metrics.class_report(scored), "precision", "recall", "f1_score")


def _auc(scored, scores):
    return _single(metrics.weighted_ovr_auc(scored, scores), "weighted_auc")


def _leading_feature(model):
    def run(spark, sf_dir):
        return _single(training.feature_importance(model(spark, sf_dir), _clean(spark, sf_dir), top=1), "importance")

    return run


def _function_of(model):
    """A permanent function of the session's catalog, made of the model's trees."""
    return lambda spark, sf_dir: create_model_function(spark, model(spark, sf_dir), f"state_{model.__name__.strip('_')}", temporary=False)


def _rule_function(spark, sf_dir):
    """A fixed rule where a loaded model would be, so that SQL can compute the same predictions."""

    def load():
        pressure, temperature = MODEL_FEATURES.index("P-PDG"), MODEL_FEATURES.index("P-TPT")

        def predict(rows):
            rows = np.nan_to_num(rows, nan=0.0)
            return np.where(rows[:, pressure] > 60, 8.0, np.where(rows[:, temperature] > 80, 3.0, 0.0))

        return predict

    return register_batch_model(spark, load, "rule_model")


def _features(spark, sf_dir, **options):
    table = features.series_features(_clean(spark, sf_dir), **options)
    return _single(table, *[c for c, kind in table.dtypes if kind == "double"])


def _manifest(spark, sf_dir, max_dirs=None, max_files=None):
    listing = event_view.listing_from_pages(spark, sf_dir)
    return ingest_manifest(listing, event_view.ledger_from_pages(spark, sf_dir), max_dirs, max_files)


def _conversation_tools(spark, sf_dir):
    turns = event_view.traces_from_conversations(spark, sf_dir)
    message = F.get(F.get("spans", F.lit(0))["outputs"]["messages"], F.lit(0))
    messages = turns.select("run_id", message["tool_calls"].alias("tool_calls"))
    return traces.tools_called_by_message(messages, "run_id", "tool_calls")


def _requests(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where(F.col("role") == "user")
    first = F.get(F.col("inputs")["messages"], F.lit(0))
    return traces.evaluation_requests(turns.select("conv_id", "turn", "text"), "text").select(
        "conv_id", "turn", first["role"].alias("role"), first["content"].alias("content"),
        F.size("inputs.messages").alias("n_messages"),
    )


def _united_files(spark, sf_dir):
    tree = read_tree(spark, sf_dir, "{customer,supplier}.parquet", merge_schema=True)
    return tree.select(
        "c_custkey", "c_name", "s_suppkey", "s_name",
        F.regexp_extract("source_file", "([^/]+)$", 1).alias("file_name"),
    )


@_per_input
def _episode_tree(spark, sf_dir):
    """The events as a tree of episode files below the checkpoint folder, written once per session."""
    folder = scratch_folder(spark)
    write_normalised(normalise_episodes(event_view.episodes_from_events(spark, sf_dir)), folder)
    return folder


@_per_input
def _raw_tree(spark, sf_dir):
    """The events as raw files of every way of storing, written once per session."""
    folder = scratch_folder(spark)
    event_view.write_raw_files(event_view.episodes_from_events(spark, sf_dir), folder)
    return folder


def _ingested(spark, sf_dir):
    """The raw files taken up in two runs, of which a third finds nothing new."""
    folder = scratch_folder(spark)
    for cap in (7, None, None):
        ingest(spark, _raw_tree(spark, sf_dir), f"{folder}/rows", f"{folder}/ledger", max_files=cap)
    return folder


def _ingested_rows(spark, sf_dir):
    folder = _ingested(spark, sf_dir)
    return _local_times(read_ingested(spark, f"{folder}/rows", f"{folder}/ledger"))


def _local_times(df: DataFrame) -> DataFrame:
    """Without the paths of files, and with times as the events have them."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).drop("source_file")


def _episode_table(spark, sf_dir):
    """Clean, fill and overwrite a table of the session's catalog, twice, then read it."""
    name, folder = f"episodes_{Path(sf_dir).name.replace('.', '_').replace('-', '_')}", scratch_folder(spark)
    for _ in range(2):
        build_table(spark, _episode_tree(spark, sf_dir), table=name, path=folder)
    return _local_times(read_table(spark, name))


def entry(spark: SparkSession) -> DataFrame:
    """The newest observations of every well, cleaned, forward-filled and named."""
    filled = forward_fill(_clean(spark, "/root/testdata/sf0.001"))
    newest_rows = newest.newest_per_group(filled, ["well_number"], 5)
    return add_state_name(newest_rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    view = event_view.episodes_from_events
    by_file = ("well_number", "source_file")
    text_queries = {} if llm_queries is None else llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return text_queries | {
        "clean_observations": _clean,
        "clean_keep_synthetic": lambda s, d: cleaning.clean(view(s, d), drop_synthetic=False),
        "normalised_episodes": lambda s, d: normalise_episodes(view(s, d)),
        "united_files": _united_files,
        "ingest_manifest": _manifest,
        "ingest_manifest_capped": lambda s, d: _manifest(s, d, max_dirs=20, max_files=40),
        "ingest_new_files": lambda s, d: new_files(_manifest(s, d)),
        "ingest_report": lambda s, d: ingest_report(_manifest(s, d)),
        "tags_long": lambda s, d: tags_long(_clean(s, d)),
        "model_columns": lambda s, d: cleaning.model_columns(_clean(s, d)),
        "well_filter": lambda s, d: cleaning.in_wells(_clean(s, d)),
        "one_well": lambda s, d: cleaning.for_well(_clean(s, d), 19),
        "state_name": lambda s, d: add_state_name(_clean(s, d)).select(
            "well_number", "timestamp", "state", "state_name"
        ),
        "state_name_nullable": lambda s, d: view(s, d).select("timestamp", "state", state_name("state").alias("state_name")),
        "null_census": lambda s, d: summaries.null_census(view(s, d)),
        "well_failure_counts": lambda s, d: summaries.well_failure_counts(_clean(s, d)),
        "well_time_bounds": lambda s, d: summaries.well_time_bounds(_clean(s, d)),
        "profile": lambda s, d: summaries.profile(_clean(s, d)),
        "forward_fill": lambda s, d: forward_fill(_clean(s, d)),
        "forward_fill_by_file": lambda s, d: forward_fill(_clean(s, d), by_file),
        "forward_fill_in_days": lambda s, d: forward_fill(_clean(s, d), max_chunk_rows=20),
        "forward_fill_short_gaps": lambda s, d: forward_fill(_clean(s, d), max_gap="12 hours"),
        "latest_n_obs": lambda s, d: newest.latest_n_obs(_clean(s, d)),
        "latest_n_obs_uncapped": lambda s, d: newest.latest_n_obs(_clean(s, d), scan_cap=None),
        "latest_n_obs_capped": lambda s, d: newest.latest_n_obs(_clean(s, d), scan_cap=SCAN_CAP),
        "latest_n_obs_one_well": lambda s, d: newest.latest_n_obs(_clean(s, d), well=19, n=10),
        "latest_filled": lambda s, d: newest.latest_n_obs(forward_fill(_clean(s, d)), scan_cap=None),
        "latest_n_obs_pruned": lambda s, d: newest.latest_n_obs(_clean(s, d), scan_cap=None, prune_days=True),
        "most_recent_obs_pruned": lambda s, d: newest.most_recent_obs(_clean(s, d), prune_days=True),
        "most_recent_obs": lambda s, d: newest.most_recent_obs(_clean(s, d)),
        "sql_latest_n_obs": _sql("SELECT * FROM latest_n_obs()"),
        "sql_latest_n_obs_uncapped": _sql("SELECT * FROM latest_n_obs(n_obs_param => 3)", scan_cap=None),
        "sql_latest_n_obs_capped": _sql("SELECT * FROM latest_n_obs()", scan_cap=SCAN_CAP),
        "sql_latest_n_obs_many": _sql("SELECT * FROM latest_n_obs(n_obs_param => 2000)"),
        "sql_most_recent_obs": _sql("SELECT * FROM most_recent_obs(19)"),
        "sql_most_recent_obs_all": _sql("SELECT * FROM most_recent_obs()"),
        "sql_well_time_bounds": _sql("SELECT * FROM well_time_bounds()"),
        "sql_well_failure_counts": _sql("SELECT * FROM well_failure_counts()"),
        "sort_series": lambda s, d: ordering.sort_series(_clean(s, d)),
        "newest_rows": lambda s, d: newest.newest_rows(_clean(s, d), 1000),
        "top_k": lambda s, d: ordering.top_k(_clean(s, d), "P-PDG", 10, ["timestamp"]),
        "row_range": lambda s, d: ordering.row_range(cleaning.model_columns(_clean(s, d)), 5, 9, "timestamp"),
        "seeded_sample": lambda s, d: ordering.seeded_sample(_clean(s, d), ["well_number", "timestamp"]),
        "stratified_split": lambda s, d: splitting.stratified_split(_clean(s, d)),
        "split_by_time": lambda s, d: splitting.split_by_time(_clean(s, d), "2024-01-25 00:00:00"),
        "split_classes": lambda s, d: splitting.split_classes(splitting.stratified_split(_clean(s, d))),
        "series_features": _features,
        "series_features_bracketed": lambda s, d: _features(s, d, max_series_rows=20),
        "confusion_counts": lambda s, d: metrics.confusion_counts(_scored(s, d)),
        "accuracy": lambda s, d: metrics.accuracy(_scored(s, d)),
        "class_report": lambda s, d: _single(metrics.class_report(_scored(s, d)), "precision", "recall", "f1_score"),
        "ovr_auc": lambda s, d: _single(metrics.ovr_auc(_scored(s, d), _rule_scores()), "auc"),
        "ovr_auc_sliced": lambda s, d: _single(metrics.ovr_auc(_scored(s, d), _rule_scores(), slice_rows=500), "auc"),
        "weighted_ovr_auc": lambda s, d: _single(
            metrics.weighted_ovr_auc(_scored(s, d), _rule_scores()), "weighted_auc"
        ),
        "tools_called": lambda s, d: traces.tools_called(event_view.traces_from_conversations(s, d)).drop("spans"),
        "tool_calls_per_conversation": _conversation_tools,
        "response_time_good": lambda s, d: traces.response_time_good(
            event_view.traces_from_conversations(s, d)
        ).drop("spans"),
        "first_trace": lambda s, d: traces.response_time_good(
            traces.first_trace(event_view.traces_from_conversations(s, d))
        ).drop("spans"),
        "evaluation_requests": _requests,
        "traces_of_run": lambda s, d: traces.response_time_good(
            traces.traces_of_run(event_view.traces_from_conversations(s, d), "7")
        ).drop("spans"),
        "episode_files": lambda s, d: _local_times(read_episodes(s, _episode_tree(s, d))),
        "episode_table": _episode_table,
        "raw_files": lambda s, d: _local_times(normalise_episodes(read_raw_episodes(s, _raw_tree(s, d)))),
        "ingested_rows": _ingested_rows,
        "process_tree": lambda s, d: _local_times(process_tree(s, _episode_tree(s, d))).select(
            "well_number", "timestamp", "state", "state_name"
        ),
        "json_props": lambda s, d: s.read.parquet(f"{d}/events.parquet").select(
            "event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k")
        ),
        "predict_state": lambda s, d: training.predict_state(_forest(s, d), _graded(s, d)),
        "sql_predict_state": _sql("SELECT * FROM predict_state()", _function_of(_forest), source=_graded),
        "sql_predict_state_rule": _sql("SELECT * FROM predict_state()", _rule_function),
        "sql_predict_state_boosted": _sql("SELECT * FROM predict_state()", _function_of(_boosted), source=_clean),
        "boosted_predictions": lambda s, d: _boosted_held_out(s, d)[0].select("well_number", "timestamp", "prediction"),
        "boosted_importance": _leading_feature(_graded_boosted),
        "boosted_report": lambda s, d: _report(_boosted_held_out(s, d)[0]),
        "boosted_auc": lambda s, d: _auc(*_boosted_held_out(s, d)),
        "feature_importance": lambda s, d: _leading_feature(_forest)(s, d).drop("importance"),
        "model_report": lambda s, d: _report(_forest_held_out(s, d)[0]),
        "model_auc": lambda s, d: _auc(*_forest_held_out(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    text_oracles = {} if llm_queries is None else llm_queries.ORACLES
    return text_oracles | ORACLES
