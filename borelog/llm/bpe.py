"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of a word has, for each of its prefixes, exactly one last token. An automaton of the vocabulary (a trie with
suffix links) lists the tokens that end at a prefix; the one that may stand beside the last token of what precedes it is
that prefix's last token. Following the last tokens back from the end of the word gives its ids. Two tokens may stand
side by side if no merge across their border comes before the merges that made them.
"""

import functools
import hashlib
import json
import re
import sys

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

# The word pattern and the word end of the vocabulary. Pieces beyond ASCII are composed, lowered and cut by
# the tokenizers library, so that both follow the same version of Unicode.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
WORD_END = "</w>"
# Separators that str.split() takes for white space and the vocabulary's normaliser does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
UNSPACED = re.compile(r"(?:[^\s]|[\x1c-\x1f])+")
# Bytes of a memo's generation, of an entry that it keeps and of what the dictionary adds to one; pairs of tokens kept.
MEMO_BYTES, KEPT_BYTES, ENTRY_BYTES, PAIRS = 32 << 20, 1024, 100, 200_000


@functools.cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else the next one from 256 on."""
    seen = [b for b in range(256) if chr(b) != "\xad" and (33 <= b <= 126 or b >= 161)]
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)]


class Memo:
    """A memo of bounded memory in two generations: the older one is forgotten when the younger is full.

    ``max_bytes`` bounds a generation by the size of its keys and values. What takes over KEPT_BYTES is not kept: long
    pieces of unspaced text hardly ever come twice.
    """

    def __init__(self, make, max_bytes: int = MEMO_BYTES):
        self.make, self.max_bytes, self.young, self.old, self.used = make, max_bytes, {}, {}, 0

    def __call__(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            size = sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
            if size > KEPT_BYTES:
                return value
            if self.used + size > self.max_bytes:
                self.old, self.young, self.used = self.young, {}, 0
            self.young[key] = value
            self.used += size
        return value


class PrefixBPE:
    """Encoder and decoder of a word-end BPE vocabulary, given as the text of its JSON file.

    Needs merges of which each makes a new token from tokens made before it, and a token for every byte, inside a word and
    at its end; other vocabularies are refused.
    """

    def __init__(self, vocabulary: str):
        config = json.loads(vocabulary)
        ids = config["model"]["vocab"]
        # One character per symbol: a byte at a word's end gets a character of its own.
        ends = {c + WORD_END: chr(0xE000 + i) for i, c in enumerate(byte_symbols())}
        self.inner, self.final = byte_symbols(), list(ends.values())
        shrink = lambda t: t[: -len(WORD_END) - 1] + ends[t[-len(WORD_END) - 1 :]] if t.endswith(WORD_END) and len(t) > len(WORD_END) else t
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.tokens = np.full(max([*ids.values(), *self.special.values()]) + 1, "", object)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        by_symbols = {shrink(t): i for t, i in ids.items() if t not in self.special}
        self.rank, self.parts = {}, {}
        for k, merge in enumerate(config["model"]["merges"]):
            left, right = (by_symbols[shrink(t)] for t in (merge if isinstance(merge, list) else merge.split(" ")))
            made = by_symbols[shrink("".join(merge) if isinstance(merge, list) else merge.replace(" ", ""))]
            ready = all(len(s) == 1 or by_symbols[s] in self.parts for s in (shrink(self.tokens[left]), shrink(self.tokens[right])))
            if made in self.parts or not ready:
                raise ValueError(f"merge {k} does not make a new token from earlier ones")
            self.rank[left, right], self.parts[made] = k, (left, right, k)
        if any(s not in by_symbols for s in [*self.inner, *self.final]):
            raise ValueError("some byte has no token")
        self.right, self.left = {}, {}
        for made in [*(by_symbols[s] for s in [*self.inner, *self.final]), *self.parts]:
            l, r, k = self.parts.get(made, (None, None, -1))
            self.right[made] = [*self.right.get(r, []), (k, made)]
            self.left[made] = [*self.left.get(l, []), (k, made)]
        self.automaton = ahocorasick.Automaton()
        for symbols, i in by_symbols.items():
            if i not in self.parts and len(symbols) > 1:
                continue
            if i not in self.parts or self.first_merge(*self.parts[i][:2]) == self.parts[i][:2]:
                self.automaton.add_word(symbols, (len(symbols), i))
        self.automaton.make_automaton()
        self.beside = {}
        self.lower = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.cut = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
        self.word = Memo(self._word)
        self.chunk = Memo(self._chunk)
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def first_merge(self, one: int, two: int):
        """The first merge across the border of two tokens while both are made from their symbols; None if there is none.

        Merges go by rank, equal ones from the left, so the left token's own merge comes before one of equal rank across
        the border, and that before the right token's own.
        """
        a, b, i, j = self.right[one], self.left[two], 0, 0
        while True:
            next_a = a[i + 1][0] if i + 1 < len(a) else 1 << 60
            next_b = b[j + 1][0] if j + 1 < len(b) else 1 << 60
            k = self.rank.get((a[i][1], b[j][1]))
            if k is not None and k < next_a and k <= next_b:
                return a[i][1], b[j][1]
            if next_a == next_b == 1 << 60:
                return None
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _word(self, word: str) -> bytes:
        """Ids of one word, as little-endian unsigned 32-bit integers."""
        data = word.encode()
        symbols = "".join([self.inner[x] for x in data[:-1]]) + self.final[data[-1]]
        last, back, beside, found = [None] * len(symbols), [0] * len(symbols), self.beside, -1
        if len(beside) > PAIRS:
            beside.clear()
        for end, (length, token) in self.automaton.iter(symbols):
            if end == found:
                continue  # this prefix has its last token
            before = end - length
            if before >= 0:
                pair = last[before], token
                fits = beside.get(pair)
                if fits is None:
                    fits = beside[pair] = self.first_merge(*pair) is None
                if not fits:
                    continue
            last[end], back[end], found = token, before, end
        ids, end = [], len(symbols) - 1
        while end >= 0:
            ids.append(last[end])
            end = back[end]
        return np.array(ids[::-1], "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a piece of text without white space: composed, lower-cased by character, cut into words."""
        if chunk.isascii():
            return b"".join([self.word(w) for w in ASCII_WORDS.findall(chunk.lower())])
        return b"".join([self.word(w) for w, _ in self.cut.pre_tokenize_str(self.lower.normalize_str(chunk))])

    def _plain(self, text: str) -> bytes:
        unusual = any(c in text for c in SEPARATORS)
        return b"".join(map(self.chunk, UNSPACED.findall(text) if unusual else text.split()))

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers; the strings of special tokens become those tokens."""
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        ids, at = [], 0
        for mark in self.marks.finditer(text):
            ids += [self._plain(text[at : mark.start()]), np.array([self.special[mark[0]]], "<u4").tobytes()]
            at = mark.end()
        return b"".join([*ids, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The tokens of ids, joined by spaces: this vocabulary has no decoder of its own."""
        return " ".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


_ready = {}


def _encoder(vocabulary: str) -> PrefixBPE:
    """This worker's encoder of a vocabulary; only the latest is kept."""
    key = hashlib.sha256(vocabulary.encode()).digest()
    if key not in _ready:
        _ready.clear()
        _ready[key] = PrefixBPE(vocabulary)
    return _ready[key]


def encode_documents(docs: DataFrame, vocabulary_path: str, pieces: int = 256) -> DataFrame:
    """Encode and decode whole texts: doc_id, ids (binary, little-endian unsigned 32-bit), decoded.

    The driver reads the vocabulary, about 2 MB, and broadcasts it. Rows go through one by one, in the order and
    partitions they come in, without a shuffle. A NULL text is an empty one and has no ids; a NULL doc_id and repeated
    rows are kept; an empty table gives an empty result; other columns are ignored. ``pieces`` bounds the rows that are
    handed on at once.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches):
        bpe = _encoder(vocabulary.value)
        for batch in batches:
            for start in range(0, len(batch), pieces):
                part = batch.iloc[start : start + pieces]
                ids = [bpe.encode(t) for t in part.text]
                yield pd.DataFrame({"doc_id": part.doc_id.array, "ids": ids, "decoded": [bpe.decode(i) for i in ids]})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(encode, "doc_id long, ids binary, decoded string")
