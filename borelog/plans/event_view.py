"""The test tables read as well data: events as sensor rows, conversations as agent traces, pages as a file listing."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from borelog.schema import SPANS_TYPE
from borelog.sources.footers import file_system

# How event types stand for states; ``view`` stands for an unlabelled row.
EVENT_STATES = {"click": 0, "error": 8, "purchase": 3, "signup": 101}


def episodes_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one row of an episode file.

    ``value`` decides where a row comes from (small ones are hand-drawn, large ones simulated); what a sensor misses
    depends on the event type or on the value.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    value, kind = F.col("value"), F.col("event_type")
    state = F.lit(None).cast("int")
    for event_type, code in EVENT_STATES.items():
        state = F.when(kind == event_type, code).otherwise(state)
    real_file = F.concat(
        F.lit("/episodes/WELL-"), F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit("_"),
        F.date_format("ts", "yyyyMM"), F.expr("CAST((day(ts) - 1) DIV 10 AS STRING)"), F.lit(".parquet"),
    )
    source_file = (
        F.when(value < 3, "/episodes/DRAWN_00001.parquet")
        .when(value >= 150, "/episodes/SIMULATED_00001.parquet")
        .otherwise(real_file)
    )
    return events.select(
        F.col("ts").alias("timestamp"),
        F.when(kind != "error", value).alias("P-PDG"),
        F.when(kind != "purchase", value + 10).alias("P-MON-CKP"),
        F.lit(None).cast("double").alias("P-JUS-CKP"),
        F.when(value >= 20, value * 2).alias("P-TPT"),
        F.when(kind != "click", value / 4).alias("T-TPT"),
        F.when(value <= 60, value * 8).alias("QGL"),
        F.when(kind != "signup", value - 1).alias("T-JUS-CKP"),
        state.alias("state"),
        source_file.alias("source_file"),
    )


RAW_WAYS = tuple((unit, state) for unit in ("ns", "us", "ms") for state in ("int64", "int32", "double"))


def write_raw_files(episodes: DataFrame, root: str) -> None:
    """Episodes as raw files, one per task, that differ in the unit of their times and in the type of ``state``."""
    columns = [c for c in episodes.columns if c != "source_file"]

    def write(batches):
        number = TaskContext.get().partitionId()
        unit, state = RAW_WAYS[number % len(RAW_WAYS)]
        rows = [pa.Table.from_batches([batch]) for batch in batches]
        if not rows:
            return
        table = pa.concat_tables(rows)
        times = table["timestamp"].cast(pa.timestamp("us")).cast(pa.timestamp(unit), safe=False)
        table = table.set_column(table.schema.get_field_index("timestamp"), "timestamp", times)
        table = table.set_column(table.schema.get_field_index("state"), "state", table["state"].cast(state))
        store, folder = file_system(f"{root}/{number % 3}")
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/WELL-{number:05d}.parquet") as file:  # a task that runs again writes it again
            pq.write_table(table, file, version="2.6")
        yield pa.record_batch({"n": pa.array([len(table)], pa.int64())})

    # One task writes a file: as many rows as fit its memory.
    episodes.select(*columns).repartition(2 * len(RAW_WAYS), "timestamp").mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def traces_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as the one-span trace of a run (its conversation).

    Each line of an assistant's text stands for a tool call; a span takes 10 ms per character.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    start = F.col("turn") * F.lit(60_000_000_000)
    calls = F.when(
        F.col("role") == "assistant",
        F.transform(F.split("text", "\n"), lambda line: F.struct(F.lit("line").alias("name"), line.alias("arguments"))),
    )
    message = F.struct(F.col("role"), F.col("text").alias("content"), calls.alias("tool_calls"))
    span = F.struct(
        start.alias("start_time_ns"),
        (start + F.length("text").cast("bigint") * F.lit(10_000_000)).alias("end_time_ns"),
        F.struct(F.array(message).alias("messages")).alias("outputs"),
    )
    return turns.select(
        F.col("conv_id").cast("string").alias("run_id"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.lpad(F.col("turn").cast("string"), 6, "0")).alias("trace_id"),
        F.array(span).cast(SPANS_TYPE).alias("spans"),
    )


def listing_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a file in the directory of its host, and every host as a top-level directory."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.regexp_extract("url", "://([^/]+)", 1).alias("host"), F.length("html").alias("size")
    )
    suffix = F.when(F.col("url").endswith(".html"), ".html").otherwise(".parquet")
    name = F.concat(F.lit("page-"), F.lpad(F.col("page_id").cast("string"), 9, "0"), suffix)
    files = pages.select(
        name.alias("name"),
        F.concat_ws("/", F.col("host"), name).alias("path"),
        F.col("url").alias("download_url"),
        F.col("size").cast("bigint").alias("size"),
        F.col("host").alias("subdir"),
        F.lit("file").alias("type"),
    )
    nothing = F.lit(None).cast("string")
    hosts = pages.select("host").distinct().select(
        F.col("host").alias("name"), F.col("host").alias("path"), nothing.alias("download_url"),
        F.lit(0).cast("bigint").alias("size"), nothing.alias("subdir"),
        F.when(F.col("host").startswith("www."), "file").otherwise("dir").alias("type"),
    )
    return files.unionByName(hosts)


def ledger_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages fetched over plain HTTP, as files already ingested."""
    return listing_from_pages(spark, sf_dir).where(F.col("download_url").startswith("http://"))
