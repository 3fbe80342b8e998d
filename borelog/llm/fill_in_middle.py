"""Fill-in-the-middle transformation of whole texts, cut at lines.

The UTF-8 bytes of many texts are looked at as 64-bit words. Arithmetic on a word marks its bytes that end a line, a bit
count says how many there are, running counts find the word that holds a wanted line end, and dropping its lowest marks
one by one finds the byte. The same counts over the bytes that start a character turn places into code points.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ONES, LOW, HIGH = (np.uint64(int(f"{byte:02x}" * 8, 16)) for byte in (0x01, 0x7F, 0x80))
ONE = np.uint64(1)
PIECE_BYTES = 8 << 20


@dataclass(frozen=True)
class FillInMiddle:
    """Marks of the parts, shares in hundredths of transformed texts and of those with the suffix first, and the seed."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 100
    suffix_first: int = 50
    seed: str = "7"

    def __post_init__(self):
        for a in self.marks:
            for b in self.marks:
                if any(a.endswith(b[:i]) for i in range(1, len(b) + (a is not b))):
                    raise ValueError(f"marks {a} and {b} may overlap")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Ranks:
    """Marked bytes of a buffer: how many lie before a place, and where the n-th one is."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.upto = marks, np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def before(self, places: np.ndarray) -> np.ndarray:
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        inside = np.bitwise_count(self.marks[word] & ((ONE << (byte << np.uint64(3))) - ONE))
        return np.where(word > 0, self.upto[word - 1], 0) + inside

    def place(self, nth: np.ndarray) -> np.ndarray:
        """Place of the marked byte number ``nth``, from 1 on."""
        word = np.searchsorted(self.upto, nth)
        rest, marks = nth - np.where(word > 0, self.upto[word - 1], 0), self.marks[word]
        for _ in range(7):
            marks = np.where(rest > 1, marks & (marks - ONE), marks)
            rest = rest - 1
        lowest = marks & (~marks + ONE)
        return word * 8 + (np.bitwise_count(lowest - ONE) >> 3)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, padded with zeros, with one word more than they fill."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8").astype(np.uint64, copy=False)


def line_ends(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is a line feed, exactly: no carry leaves its byte."""
    other = words ^ (ONES * np.uint64(10))
    return ~(((other & LOW) + LOW) | other | LOW)


def character_starts(words: np.ndarray) -> np.ndarray:
    """High bit of every byte but those that go on a UTF-8 character."""
    return ~(words & ~(words << ONE)) & HIGH


def cut(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray):
    """Lines, byte places of both cuts, and characters before and between them, of texts ``data[offsets[i] : offsets[i + 1]]``."""
    begin, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    words = words_of(data)
    lines, characters = Ranks(line_ends(words)), Ranks(character_starts(words))
    first, upto = lines.before(begin), lines.before(end)
    open_line = (end > begin) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else np.zeros(len(begin), bool)
    n = upto - first + open_line
    cuts = []
    for units in np.sort(draws % (n + 1)[:, None], axis=1).T:
        place = np.where(units == 0, begin, end)
        inner = (units > 0) & (units <= upto - first)
        place[inner] = lines.place((first + units)[inner]) + 1
        cuts.append(place)
    starts = [characters.before(place) for place in (begin, *cuts)]
    return n, *cuts, starts[1] - starts[0], starts[2] - starts[1]


def _pieces(batch: pa.RecordBatch):
    """Slices of a batch that hold up to PIECE_BYTES of text, or a single longer one."""
    ends, start = np.cumsum(batch["bytes"].to_numpy()), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _write(piece: pa.RecordBatch, spec: FillInMiddle) -> pa.RecordBatch:
    texts = piece["text"].cast(pa.binary())
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    draws = np.stack([piece["draw1"].to_numpy(), piece["draw2"].to_numpy()], axis=1)
    n, left, right, prefix_chars, middle_chars = cut(data, offsets, draws)
    form, raw = piece["form"].to_pylist(), data.tobytes()
    p, s, m = (mark.encode() for mark in spec.marks)
    outputs = []
    for kind, begin, a, b, end in zip(form, offsets[:-1], left, right, offsets[1:]):
        prefix, middle, suffix = raw[begin:a], raw[a:b], raw[b:end]
        if kind == "plain":
            outputs.append(raw[begin:end])
        elif kind == "psm":
            outputs.append(b"".join([p, prefix, s, suffix, m, middle]))
        else:
            outputs.append(b"".join([s, suffix, p, prefix, m, middle]))
    plain = np.array([kind == "plain" for kind in form], bool)
    columns = [
        piece["doc_id"], pa.array(n, pa.int64()), piece["form"], pa.array(prefix_chars, pa.int64(), mask=plain),
        pa.array(middle_chars, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, spec: FillInMiddle = FillInMiddle()) -> DataFrame:
    """Cut each text in three at line borders drawn by its doc_id, and put the middle last.

    Returns a row per row of ``docs``: doc_id, n (lines), form (``plain``, ``psm`` or ``spm``), prefix_chars and
    middle_chars (code points, NULL if plain) and output. A text that is NULL, empty or holds a mark stays plain; the
    output of a NULL text is empty. Repeated rows give the same output each; a NULL doc_id draws like an empty one; an
    empty table gives an empty result; other columns are ignored. Rows are not shuffled, and long texts go one by one.
    """
    digest = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = lambda i: F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")
    marked = F.lit(False)
    for mark in spec.marks:
        marked = marked | F.contains("text", F.lit(mark))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    form = (
        F.when((F.length("text") == 0) | marked | (draw(2) % 100 >= spec.transformed), "plain")
        .when(draw(3) % 100 < spec.suffix_first, "spm")
        .otherwise("psm")
    )
    rows = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", form.alias("form"), F.octet_length("text").cast("long").alias("bytes"),
        draw(0).alias("draw1"), draw(1).alias("draw2"),
    )

    def transform(batches):
        for batch in batches:
            for piece in _pieces(batch):
                yield _write(piece, spec)

    return rows.mapInArrow(
        transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(spec: FillInMiddle = FillInMiddle(), form: str = "form", output: str = "output") -> Column:
    """The text that an output was made of, from the output and its form alone.

    No mark occurs in a transformed text and none overlaps another, so each stands where it was put and nowhere else.
    """
    parts = F.split(F.col(output), "|".join(re.escape(mark) for mark in spec.marks), -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    moved = F.when(F.col(form) == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(moved)
