import pytest

from borelog.operators.traces import (
    evaluation_requests, first_trace, response_time_good, tools_called, tools_called_by_message, traces_of_run,
)
from borelog.schema import SPANS_TYPE

SECOND = 1_000_000_000


def message(calls):
    return ("assistant", "text", None if calls is None else [("latest_n_obs", "{}")] * calls)


def span(start, end, *calls):
    return (start, end, (None if calls == (None,) else [message(c) for c in calls],))


@pytest.fixture(scope="module")
def traces(spark):
    rows = [
        ("r1", "no-calls", [span(0, 5 * SECOND, 0, None)]),
        ("r1", "two-messages", [span(SECOND, 6 * SECOND + 1, 1, 2), span(0, 1, 9)]),
        ("r2", "second-span-only", [span(0, SECOND, 0), span(0, SECOND, 4)]),
        ("r2", "no-messages", [span(2 * SECOND, 9 * SECOND, None)]),
    ]
    return spark.createDataFrame(rows, f"run_id string, trace_id string, spans {SPANS_TYPE}")


def test_tools_called_looks_at_the_first_span(traces):
    found = {r.trace_id: (r.num_tool_calls, r.value, r.rationale) for r in tools_called(traces).collect()}
    assert found["two-messages"] == (3, "yes", "Tools were called")
    for name in ("no-calls", "second-span-only", "no-messages"):
        assert found[name] == (0, "no", "No tools were called")


def test_tools_called_from_message_rows(spark):
    rows = [("a", [1, 2]), ("a", None), ("b", []), ("c", None)]
    found = tools_called_by_message(spark.createDataFrame(rows, "t string, calls array<int>"), "t", "calls").collect()
    assert {r.t: (r.num_tool_calls, r.value) for r in found} == {"a": (2, "yes"), "b": (0, "no"), "c": (0, "no")}


def test_response_time_limit_is_inclusive(traces):
    found = {r.trace_id: r for r in response_time_good(traces).collect()}
    assert found["no-calls"].value == "yes"
    assert found["no-calls"].rationale == "LLM response time 5.00s is within the 5.0s limit."
    assert found["two-messages"].value == "no"
    assert found["no-messages"].rationale == "LLM response time 7.00s exceeds the 5.0s limit."
    assert {r.value for r in response_time_good(traces, 10.0).collect()} == {"yes"}


def test_runs(traces):
    assert traces_of_run(traces, "r1").count() == 2
    assert {r.trace_id for r in first_trace(traces).collect()} == {"two-messages", "no-messages"}


def test_requests(spark):
    rows = spark.createDataFrame([("What is the current state of Well 19?",)], "question string")
    request = evaluation_requests(rows).first().inputs
    assert [m.asDict() for m in request.messages] == [{"role": "user", "content": "What is the current state of Well 19?"}]
