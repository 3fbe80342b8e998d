"""Scores of agent traces held as nested rows (run_id, trace_id, spans)."""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Verdicts and rationale texts.
YES = "yes"
NO = "no"
TOOLS_CALLED = "Tools were called"
NO_TOOLS_CALLED = "No tools were called"
IN_TIME = "LLM response time %.2fs is within the {limit}s limit."
LATE = "LLM response time %.2fs exceeds the {limit}s limit."
MAX_SECONDS = 5.0


def evaluation_requests(questions: DataFrame, text: str = "question") -> DataFrame:
    """One request per question: ``inputs.messages`` holds it as a single user message."""
    message = F.struct(F.lit("user").alias("role"), F.col(text).alias("content"))
    return questions.withColumn("inputs", F.struct(F.array(message).alias("messages")))


def traces_of_run(traces: DataFrame, run_id) -> DataFrame:
    return traces.where(F.col("run_id") == run_id)


def first_trace(traces: DataFrame) -> DataFrame:
    """The first trace in a run's search order, which lists the newest start first; ties go by trace id."""
    start = F.get("spans", F.lit(0))["start_time_ns"]
    newest = Window.partitionBy("run_id").orderBy(F.desc_nulls_last(start), "trace_id")
    return traces.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def tool_calls(messages: Column) -> Column:
    """Number of tool calls in an array of messages; missing arrays count as empty."""
    per_message = F.transform(messages, lambda m: F.coalesce(F.array_size(m["tool_calls"]), F.lit(0)))
    return F.coalesce(F.aggregate(per_message, F.lit(0), lambda total, n: total + n), F.lit(0))


def tools_called(traces: DataFrame) -> DataFrame:
    """Verdict on whether the messages of the first span call any tool."""
    calls = tool_calls(F.get("spans", F.lit(0))["outputs"]["messages"])
    return traces.withColumn("num_tool_calls", calls).withColumns(_tool_verdict(F.col("num_tool_calls")))


def tools_called_by_message(messages: DataFrame, trace: str, tool_calls_col: str) -> DataFrame:
    """The same verdict from one row per message: counts are added up per trace, arrays are never gathered."""
    calls = F.coalesce(F.array_size(tool_calls_col), F.lit(0))
    per_trace = messages.groupBy(trace).agg(F.sum(calls).alias("num_tool_calls"))
    return per_trace.withColumns(_tool_verdict(F.col("num_tool_calls")))


def _tool_verdict(calls: Column) -> dict[str, Column]:
    called = calls > 0
    return {
        "value": F.when(called, YES).otherwise(NO),
        "rationale": F.when(called, TOOLS_CALLED).otherwise(NO_TOOLS_CALLED),
    }


def response_time_good(traces: DataFrame, max_seconds: float = MAX_SECONDS) -> DataFrame:
    """Verdict on whether the first span took at most ``max_seconds``."""
    span = F.get("spans", F.lit(0))
    seconds = F.col("response_time")
    in_time = seconds <= max_seconds
    timed = traces.withColumn("response_time", (span["end_time_ns"] - span["start_time_ns"]) / 1e9)
    text = F.when(in_time, F.format_string(IN_TIME.format(limit=max_seconds), seconds)).otherwise(
        F.format_string(LATE.format(limit=max_seconds), seconds)
    )
    return timed.withColumns({"value": F.when(in_time, YES).otherwise(NO), "rationale": text})
