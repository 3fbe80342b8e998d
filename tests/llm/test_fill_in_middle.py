import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from borelog.llm.fill_in_middle import FillInMiddle, cut, fill_in_middle, restored


def brute(doc_id, text, spec=FillInMiddle()):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{spec.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(lines)
    a, b = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(mark in text for mark in spec.marks) or h[2] % 100 >= spec.transformed:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < spec.suffix_first:
        form, output = "spm", spec.suffix + suffix + spec.prefix + prefix + spec.middle + middle
    else:
        form, output = "psm", spec.prefix + prefix + spec.suffix + suffix + spec.middle + middle
    return doc_id, n, form, len(prefix), len(middle), output, text


def ours(docs, spec=FillInMiddle()):
    rows = fill_in_middle(docs, spec).withColumn("restored", restored(spec)).collect()
    return sorted(map(tuple, rows), key=repr)


TEXTS = [
    None, "", "one", "one\n", "\n", "\n\n\n", "a\nb\nc", "é\n😀😀\n\r\nß", "<P>", "x<S>\ny", "mid <M", "<", "a\n<\nP>\n", "\x00\n\x00", "tab\tand\x0b\n" * 50,
    "longer line of text\n" * 40_000, "no line end " * 30_000, "\n" * 70_000,
]


def test_documents_against_brute_force(spark, frame):
    rows = [(i, text) for i, text in enumerate(TEXTS * 8)] + [(None, "a\nb"), (None, None), (3, "one\n"), (3, "one\n")]
    assert ours(frame(rows)) == sorted((brute(*row) for row in rows), key=repr)
    assert ours(frame([])) == []


def test_shares_and_marks(frame):
    spec = FillInMiddle("[[pre]]", "[[suf]]", "[[mid]]", transformed=40, suffix_first=0, seed="x")
    rows = [(i, f"{i}\nb\n<P>c" if i % 9 else "has [[mid]]") for i in range(300)]
    found = ours(frame(rows), spec)
    assert found == sorted((brute(*row, spec) for row in rows), key=repr)
    assert {r[2] for r in found} == {"plain", "psm"}


def test_marks_that_overlap_are_refused():
    with pytest.raises(ValueError):
        FillInMiddle("<a", "a<", "m")
    with pytest.raises(ValueError):
        FillInMiddle("aa", "b", "c")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("a\n\x8aé😀\x0b", max_size=40), min_size=1, max_size=12), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cut_of_a_batch(texts, one, two):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    found = cut(np.frombuffer(b"".join(data), np.uint8), offsets, np.array([[one, two]] * len(texts)))
    for text, raw, start, n, left, right, prefix_chars, middle_chars in zip(texts, data, offsets, *found):
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted(x % (len(lines) + 1) for x in (one, two))
        assert n == len(lines)
        assert raw[: left - start].decode() == "".join(lines[:a])
        assert raw[left - start : right - start].decode() == "".join(lines[a:b])
        assert (prefix_chars, middle_chars) == (len("".join(lines[:a])), len("".join(lines[a:b])))
