import sys

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from borelog.llm.bpe import Memo, PrefixBPE, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
OURS, THEIRS = PrefixBPE(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH)


def expected(text):
    ids = THEIRS.encode(text or "", add_special_tokens=False).ids
    return ids, THEIRS.decode(ids, skip_special_tokens=False)


def ours(text):
    ids = OURS.encode(text)
    return np.frombuffer(ids, "<u4").tolist(), OURS.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aabbeinthrsoé'-.12 ", max_size=60)))
def test_random_texts(text):
    assert ours(text) == expected(text)


def test_every_code_point():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}b {chr(c)} " for c in points[i : i + 64])
        assert ours(text) == expected(text), hex(points[i])


def test_documents(frame):
    long = "averylongword" * 20_000
    rows = [(1, "Hello <|endoftext|> world"), (2, None), (3, ""), (None, "İstanbul ΑΣ\x1cx"), (1, "Hello <|endoftext|> world"), (4, long), (5, "a b\n" * 50_000)]
    found = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in encode_documents(frame(rows), PATH).collect()]
    assert sorted(found, key=repr) == sorted([(i, *expected(t)) for i, t in rows], key=repr)
    assert encode_documents(frame([]), PATH).collect() == []


def test_memory_of_unspaced_texts():
    """Texts without a space, each of its own, leave little behind; the memo's bound is one of bytes."""
    made = []
    memo = Memo(lambda key: made.append(key) or key.encode(), max_bytes=100_000)
    for i in range(5000):
        assert memo(f"word{i}") == f"word{i}".encode()
    sizes = [sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in part.items()) for part in (memo.young, memo.old)]
    assert max(sizes) <= 100_000 and len(memo.young) + len(memo.old) < 2000
    memo("x" * 2000)
    assert "x" * 2000 not in memo.young
    before = len(made)
    memo("word4999")
    assert len(made) == before
    own = PrefixBPE(open(PATH, encoding="utf-8").read())
    for i in range(60):
        text = "".join(chr(0x4E00 + (i * 7919 + j * 31) % 20_000) for j in range(20_000))
        own.encode(text)
    assert sum(len(k) for memo in (own.word, own.chunk) for part in (memo.young, memo.old) for k in part) < 100_000
