"""Fill-in-middle transformation over a piece table.

A document is a list of descriptors (buffer, start, end) over two immutable buffers: its own text and the
sentinels. Cutting splits descriptors, an arrangement permutes them and puts sentinels between, the inverse
permutation restores the text. Nothing is copied on the way: hashes and outputs stream the descriptors.
Places are bytes of UTF-8; units (runs of ASCII letters, or any other code point) and code points are counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_batches, pieces, raw_bytes

TEXT, MARKS = 0, 1
SENTINELS = b"<P><S><M>"
PREFIX, MIDDLE, SUFFIX = 0, 1, 2


class Piece(NamedTuple):
    buffer: int
    start: int
    end: int


P, S, M = (Piece(MARKS, i, i + 3) for i in (0, 3, 6))
#: What stands in each form, one after the other: sentinels, and parts of the text by number.
FORMS = {"psm": [P, PREFIX, S, SUFFIX, M, MIDDLE], "spm": [S, SUFFIX, P, PREFIX, M, MIDDLE]}
#: Bytes of a text that are looked at together for its units.
STRETCH = 1 << 16


def cut(table: list[Piece], places: Iterable[int]) -> list[list[Piece]]:
    """The descriptors up to each place, counted in the text they spell, and what is left."""
    parts, rest, at = [], list(table), 0
    for place in places:
        part = []
        while rest and at + rest[0].end - rest[0].start <= place:
            part.append(rest.pop(0))
            at += part[-1].end - part[-1].start
        if at < place:
            buffer, start, end = rest[0]
            part.append(Piece(buffer, start, start + place - at))
            rest[0], at = Piece(buffer, start + place - at, end), place
        parts.append(part)
    return [*parts, rest]


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of the form, with its sentinels."""
    return [x for item in FORMS[form] for x in ([item] if isinstance(item, Piece) else parts[item])]


def found_parts(output: bytes, form: str) -> list[list[Piece]]:
    """The parts of an output in the order they stand in it, without the sentinels between them.

    A text that holds a sentinel is never arranged, so the first of each kind is the one that was put there.
    """
    marks = [SENTINELS[x.start : x.end] for x in FORMS[form] if isinstance(x, Piece)]
    places, at = [], 0
    for mark in marks:
        at = output.index(mark, at)
        places += [at, at + len(mark)]
        at += len(mark)
    return cut([Piece(TEXT, 0, len(output))], places)[2::2]


def restored(output: bytes, form: str) -> list[Piece]:
    """Descriptors over the output that spell the text again."""
    if form == "plain":
        return [Piece(TEXT, 0, len(output))]
    stands = [x for x in FORMS[form] if not isinstance(x, Piece)]
    found = found_parts(output, form)
    return [x for part in np.argsort(stands) for x in found[part]]


def stream(table: list[Piece], text: bytes) -> Iterator[memoryview]:
    buffers = {TEXT: memoryview(text), MARKS: memoryview(SENTINELS)}
    for buffer, start, end in table:
        yield buffers[buffer][start:end]


def digest(table: list[Piece], text: bytes) -> str:
    found = hashlib.sha256()
    for part in stream(table, text):
        found.update(part)
    return found.hexdigest()


class Units:
    """Where the units of a text start: how many, and the byte at which one of them does."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        letter = ((data | 32) - np.uint8(97)) < 26
        self.inside = (data & 0xC0) == 0x80  # of a code point, after its first byte
        self.starts = ~self.inside
        self.starts[1:] &= ~(letter[1:] & letter[:-1])
        stretches = range(0, len(data), STRETCH)
        self.before = np.cumsum([0, *(np.count_nonzero(self.starts[i : i + STRETCH]) for i in stretches)])
        self.count = int(self.before[-1])

    def place(self, unit: int) -> int:
        if unit >= self.count:
            return len(self.starts)
        stretch = int(np.searchsorted(self.before, unit, "right")) - 1
        here = np.flatnonzero(self.starts[stretch * STRETCH : (stretch + 1) * STRETCH])
        return stretch * STRETCH + int(here[unit - self.before[stretch]])

    def code_points(self, start: int, end: int) -> int:
        return end - start - np.count_nonzero(self.inside[start:end])


class Transformed(NamedTuple):
    """What became of a text: its number of units, form, code points of prefix and middle, descriptors."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: list[Piece]


def transformed(doc_id: int | None, text: bytes, salt: str = "1", plain_from: int = 90, spm_below: int = 20) -> Transformed:
    """The text's form and descriptors, drawn from a hash of `salt` and doc_id alone.

    Of 100 documents, those from `plain_from` on stay plain; of the others `spm_below` in 100 are spm.
    """
    drawn = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = Units(text)
    whole = [Piece(TEXT, 0, len(text))]
    if not text or any(SENTINELS[x.start : x.end] in text for x in (P, S, M)) or h3 % 100 >= plain_from:
        return Transformed(units.count, "plain", None, None, whole)
    form = "spm" if h4 % 100 < spm_below else "psm"
    a, b = (units.place(x) for x in sorted((h1 % (units.count + 1), h2 % (units.count + 1))))
    return Transformed(units.count, form, units.code_points(0, a), units.code_points(a, b), arrange(cut(whole, [a, b]), form))


KINDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_NAMES = [x.split(" ")[0] for x in KINDS.split(", ")]


def _rows(batch: pa.RecordBatch, settings: dict) -> list[tuple[bytes, Transformed]]:
    texts = [x or b"" for x in raw_bytes(batch.column("text"))]
    return [(text, transformed(doc_id, text, **settings)) for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts)]


def _columns(batch: pa.RecordBatch, rows: list[tuple[bytes, Transformed]]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return [batch.column("doc_id"), *(pa.array([row[i] for _, row in rows], kind) for i, kind in enumerate(kinds))]


def _transform(batches: Iterator[pa.RecordBatch], settings: dict) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        rows = _rows(batch, settings)
        outputs = pa.array([b"".join(stream(x.table, text)) for text, x in rows], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([*_columns(batch, rows), outputs], [*_NAMES, "output"])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "output"):
        outputs = [x or b"" for x in raw_bytes(batch.column("output"))]
        forms = batch.column("form").to_pylist()
        texts = [b"".join(stream(restored(x, form), x)) for x, form in zip(outputs, forms)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def _round_trip(batches: Iterator[pa.RecordBatch], settings: dict) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        rows = _rows(batch, settings)
        hashes = [digest(x.table, text) for text, x in rows]
        back = []
        for text, x in rows:
            output = b"".join(stream(x.table, text))
            back.append(digest(restored(output, x.form), output))
        yield pa.RecordBatch.from_arrays(
            [*_columns(batch, rows), pa.array(hashes, pa.string()), pa.array(back, pa.string())],
            [*_NAMES, "output_sha256", "restored_sha256"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def transform(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row of `docs` (doc_id, text).

    Settings are those of `transformed`. n counts the units of the text. A null text is empty; empty texts and
    texts that hold a sentinel stay plain, with null prefix_chars and middle_chars. A missing doc_id draws like
    an empty one; rows of one doc_id draw alike, repeated rows stay. Other columns are not looked at.
    """
    return map_batches(_texts(docs), partial(_transform, settings=settings), f"{KINDS}, output string")


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) per row of `outputs` (doc_id, form, output): the texts that `transform` was given, null
    ones as empty. An output without its form's sentinels is an error."""
    rows = outputs.select(F.col("doc_id").cast("long"), F.col("form").cast("string"), F.col("output").cast("string"))
    return map_batches(rows, _restore, "doc_id long, text string")


def round_trip(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): the hashes of what
    `transform` and then `restore` give, in one pass that sends no texts back."""
    return map_batches(_texts(docs), partial(_round_trip, settings=settings), f"{KINDS}, output_sha256 string, restored_sha256 string")
