"""Repeated passages by FM-indexes.

A window is `WINDOW` consecutive words. To find the windows that an earlier document has as well, the
corpus is cut into shards that share no window: the run of words that selects a window is the one of
smallest hash among the runs of ANCHOR words in it (its anchor), and a shard holds the segments, that
is maximal runs of windows with the same anchor, of a range of anchors. Anchors that only one document
has are dropped before any segment is formed. A shard's segments are concatenated and indexed by a
compressed FM-index (Burrows-Wheeler transform in a wavelet matrix), and streamed against it by backward
search: for every window the index tells how far it matches and which documents the matches are in.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadpulse.llm.common import map_batches, pieces, raw_bytes

WINDOW, ANCHOR = 13, 4
#: Words of one index; a shard's anchors are indexed together up to this many.
INDEX_WORDS = 1 << 19
#: Words of a segment at most, where its anchor occurs once.
LONGEST = 2 * WINDOW - ANCHOR
KEPT_WORDS = 300_000
#: Stands for a missing doc_id, after all others.
LAST = (1 << 63) - 1


class WordHashes(dict):
    """64-bit hashes of words, kept for up to KEPT_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def anchors(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """The anchor of every window of a document, as a hash."""
    if len(words) < window:
        return np.zeros(0, np.int64)
    value = words[: len(words) - anchor + 1].copy()
    for i in range(1, anchor):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - anchor + 1 + i]
    value ^= value >> np.uint64(33)
    value *= np.uint64(0xFF51AFD7ED558CCD)
    value ^= value >> np.uint64(33)
    runs, span = window - anchor + 1, 1  # smallest of `runs` neighbours, by doubling
    while span * 2 <= runs:
        value, span = np.minimum(value[:-span], value[span:]), span * 2
    rest = runs - span
    return (np.minimum(value[:-rest], value[rest:]) if rest else value).view(np.int64)


def segments(selected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of the runs of equal anchors."""
    if not len(selected):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, selected[1:] != selected[:-1]))
    return starts, np.diff(np.append(starts, len(selected)))


class WaveletMatrix:
    """A sequence of numbers that tells how often one occurs before a place, a bit vector per bit."""

    def __init__(self, sequence: np.ndarray):
        self.levels = max(1, int(sequence.max(initial=0)).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (sequence >> level & 1).astype(bool)
            packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bits, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view("<u8")
            self.words.append(words)
            self.counts.append(np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))[:-1])
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbol's occurrences before `at` end, in the order of the last level."""
        for level in range(self.levels):
            ones = self._ones(level, at)
            at = np.where(symbol >> (self.levels - 1 - level) & 1, self.zeros[level] + ones, at - ones)
        return at


class FMIndex:
    """Over a sequence of numbers from 1 up; 0 ends a segment and never matches."""

    def __init__(self, text: np.ndarray, length: int):
        """`length`: matches of up to so many symbols are told apart."""
        size, rank, span = len(text), text.astype(np.int64), 1
        while span < length:  # by 1, 2, 4, ... symbols; places past the end come first
            after = np.append(rank[span:] + 1, np.zeros(min(span, size), np.int64))
            _, rank = np.unique(rank * (size + int(text.max(initial=0)) + 2) + after, return_inverse=True)
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.transform = WaveletMatrix(text[self.suffixes - 1])
        starts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.size, self.starts = size, starts
        # the wavelet matrix places a symbol's first occurrence at `base`; ranks count from there
        symbols = np.arange(len(starts) - 1)
        self.base = self.transform.place(symbols, np.zeros(len(symbols), np.int64))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with `symbol` and go on with those in [low, high)."""
        shift = self.starts[symbol] - self.base[symbol]
        return shift + self.transform.place(symbol, low), shift + self.transform.place(symbol, high)


def earliest(texts: list[np.ndarray], first_docs: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For every window of each segment (64-bit words), the smallest document any segment with that
    window is first in. Backward search follows a window while it has more than one match."""
    lengths = np.array([len(x) for x in texts])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    _, numbers = np.unique(np.concatenate(texts), return_inverse=True)
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    inside = np.arange(len(numbers)) + np.repeat(np.arange(len(texts)), lengths)
    text[inside] = numbers + 1
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    index = FMIndex(text, window)
    counts = lengths - window + 1
    at = np.arange(int(counts.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
    out = first_docs[owner[at]]
    going = np.arange(len(at))
    symbol = text[at + window - 1]
    low, high = index.starts[symbol], index.starts[symbol + 1]
    for step in range(window - 2, -1, -1):
        more = high - low > 1  # a single match is the window itself
        going, low, high = going[more], low[more], high[more]
        low, high = index.extend(text[at[going] + step], low, high)
    more = high - low > 1
    going, low, high = going[more], low[more], high[more]
    if len(going):
        docs = np.append(first_docs[owner[index.suffixes]], LAST)
        bounds = np.unique(low)
        ends = np.zeros(index.size + 1, np.int64)
        ends[low] = high
        pairs = np.stack([bounds, ends[bounds]], axis=1).ravel()  # ranges of whole windows never overlap
        out[going] = np.minimum.reduceat(docs, pairs)[::2][np.searchsorted(bounds, low)]
    return np.split(out, np.cumsum(counts)[:-1])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, anchor) for the distinct anchors of each document, once for LONGEST words of their segments."""
    hashes = WordHashes()
    for batch in pieces(batches, "text"):
        rows, found = [], []
        for row, text in zip(batch.column("row").to_pylist(), raw_bytes(batch.column("text"))):
            selected = anchors(hashes.of((text or b"").split()))
            starts, counts = segments(selected)
            some, back = np.unique(selected[starts], return_inverse=True)
            size = np.bincount(back, counts + WINDOW - 1, len(some)).astype(np.int64)
            found.append(np.repeat(some, -(-size // LONGEST)))
            rows.append(np.full(len(found[-1]), row, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate(found))], ["row", "anchor"])


def _shared_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """(row, doc, first window, windows, anchor, words) of the segments with a shared anchor; window by
    window, with a hash of the window in place of the anchor, where the anchor has too many."""
    hashes = WordHashes()
    for batch in pieces(batches, "text"):
        columns = (batch.column("row").to_pylist(), batch.column("doc").to_pylist(), batch.column("anchors"), raw_bytes(batch.column("text")))
        for row, doc, shared, text in zip(*columns):
            words = hashes.of((text or b"").split())
            selected = anchors(words)
            starts, counts = segments(selected)
            known, heads = np.sort(shared.values.to_numpy()), selected[starts]
            plain, crowded = (known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x for x in (heads, ~heads))
            wanted = plain | crowded
            for first, count, anchor, single in zip(starts[wanted].tolist(), counts[wanted].tolist(), heads[wanted].tolist(), crowded[wanted].tolist()):
                if single:
                    for at in range(first, first + count):
                        window = words[at : at + WINDOW].tobytes()
                        yield row, doc, at, 1, xxhash.xxh64_intdigest(window) - (1 << 63), window
                else:
                    yield row, doc, first, count, anchor, words[first : first + count + WINDOW - 1].tobytes()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, words, first_doc, last_doc) of segments, combined as far as a task's memory goes."""
    schema = pa.schema([("anchor", pa.int64()), ("words", pa.binary()), ("first_doc", pa.int64()), ("last_doc", pa.int64())])

    def rows() -> Iterator[tuple]:
        held: dict[bytes, list[int]] = {}
        for _, doc, _, _, anchor, words in _shared_segments(batches):
            known = held.get(words)
            if known:
                known[1], known[2] = min(known[1], doc), max(known[2], doc)
                continue
            held[words] = [anchor, doc, doc]
            if len(held) > 50_000:
                yield from ((x, words, a, b) for words, (x, a, b) in held.items())
                held.clear()
        yield from ((x, words, a, b) for words, (x, a, b) in held.items())

    return _batches(rows(), schema)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, row, doc, first): where a segment stands; content is the hash of its words."""
    schema = pa.schema([("content", pa.binary()), ("row", pa.int64()), ("doc", pa.int64()), ("first", pa.int32())])
    return _batches(((xxhash.xxh3_128_digest(words), row, doc, first) for row, doc, first, _, _, words in _shared_segments(batches)), schema)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, earliest) of the segments of which some window may be in an earlier document: for each
    window the smallest document that has it. Rows come in order of anchor."""
    schema = pa.schema([("content", pa.binary()), ("earliest", pa.list_(pa.int64()))])

    def solve(group: dict[bytes, list[int]]) -> Iterator[tuple]:
        keys, bounds = list(group), list(group.values())
        found = earliest([np.frombuffer(x, np.uint64) for x in keys], np.array([x for x, _ in bounds]))
        for words, (first, last), docs in zip(keys, bounds, found):
            if last > first or (docs < first).any():
                yield xxhash.xxh3_128_digest(words), docs.tolist()

    def rows() -> Iterator[tuple]:
        group: dict[bytes, list[int]] = {}
        size, before = 0, None
        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("anchor", "words", "first_doc", "last_doc"))
            for anchor, words, first, last in zip(*columns):
                if anchor != before and size > INDEX_WORDS * 8:
                    yield from solve(group)
                    group, size = {}, 0
                before, known = anchor, group.get(words)
                if known:
                    known[0], known[1] = min(known[0], first), max(known[1], last)
                else:
                    group[words] = [first, last]
                    size += len(words)
        if group:
            yield from solve(group)

    return _batches(rows(), schema)


def _remove(batches: Iterator[pa.RecordBatch], untouched: bool) -> Iterator[pa.RecordBatch]:
    """The kept words of each text; if `untouched`, a text that loses nothing stays as it is."""
    for batch in pieces(batches, "text"):
        total, gone, kept = [], [], []
        columns = (raw_bytes(batch.column("text")), batch.column("first_copy").to_pylist(), batch.column("windows"))
        for text, first_copy, windows in zip(*columns):
            words = (text or b"").split()
            covered = np.zeros(len(words) + 1, np.int64)
            if not first_copy and len(words) >= WINDOW:
                covered[0] += 1
            elif windows.is_valid:
                starts = np.unique(windows.values.to_numpy())
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + WINDOW, -1)
            keep = (np.cumsum(covered)[:-1] == 0).tolist() if covered.any() else None
            left = words if keep is None else [x for x, stays in zip(words, keep) if stays]
            total.append(len(words)), gone.append(len(words) - len(left))
            same = untouched and keep is None
            kept.append((text and text.decode()) if same else b" ".join(left).decode())
        found = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("rest"), *found], ["rest", "n_words", "n_removed", "kept"])


def quoted(name: str) -> str:
    """A column's name as an identifier, also with dots or back-quotes in it."""
    return "`" + name.replace("`", "``") + "`"


def _searched(docs: DataFrame, rest: list[str], untouched: bool) -> DataFrame:
    """(rest, n_words, n_removed, kept) per row of `docs`; `rest` holds the columns so named."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    packed = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.struct(*map(quoted, rest)).alias("rest"))
    digest = F.md5(F.coalesce("text", F.lit("")))
    texts = packed.select(doc.alias("doc"), F.xxhash64(doc, digest).alias("row"), digest.alias("digest"), "text", "rest")
    copies = texts.groupBy("digest").agg(F.min("doc").alias("doc")).select(F.xxhash64("doc", "digest").alias("row"), F.lit(True).alias("first_copy"))
    whole = texts.select("row", "doc", "text", "rest")
    firsts = whole.join(copies.hint("shuffle_hash"), "row")

    # every branch takes all columns of `whole`, so that one exchange of the texts serves all
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchored = map_batches(firsts, _anchors, "row long NOT NULL, anchor long NOT NULL").repartition(spread, "anchor")
    crowded = F.count("*") * LONGEST > INDEX_WORDS
    several = anchored.groupBy("anchor").agg(F.min("row").alias("a"), F.max("row").alias("b"), crowded.alias("crowd")).filter("a != b").select("anchor", "crowd")
    marked = F.when(F.col("crowd"), F.bitwise_not("anchor")).otherwise(F.col("anchor"))
    shared = anchored.join(several, "anchor").groupBy("row").agg(F.collect_set(marked).alias("anchors"))
    sharing = firsts.join(shared.hint("shuffle_hash"), "row")

    contents = map_batches(sharing, _contents, "anchor long NOT NULL, words binary NOT NULL, first_doc long NOT NULL, last_doc long NOT NULL")
    sharded = contents.repartition("anchor").sortWithinPartitions("anchor")
    found = map_batches(sharded, _search, "content binary NOT NULL, earliest array<long> NOT NULL")
    places = map_batches(sharing, _occurrences, "content binary NOT NULL, row long NOT NULL, doc long NOT NULL, first int NOT NULL")
    hit = F.transform("earliest", lambda x, i: F.when(x < F.col("doc"), F.col("first") + i))
    hits = places.join(found, "content").select("row", F.filter(hit, lambda x: x.isNotNull()).alias("hits")).filter(F.size("hits") > 0)
    windows = hits.groupBy("row").agg(F.flatten(F.collect_list("hits")).alias("windows"))
    known = whole.join(copies.hint("shuffle_hash"), "row", "left").join(windows.hint("shuffle_hash"), "row", "left")
    kinds = StructType([known.schema["rest"], *StructType.fromDDL("n_words long, n_removed long, kept string")])
    return map_batches(known, partial(_remove, untouched=untouched), kinds)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of `docs` (doc_id, text).

    Words stand between ASCII white space. A word is removed if it is covered by a window whose words
    also start, in that order, in a document with a smaller doc_id; `kept` joins the others by one space.
    A missing doc_id comes after all others, and equal doc_ids remove nothing from one another. Null
    texts are empty; repeated rows get equal results; other columns are not looked at.

    Words are compared by 64-bit hashes, and rows told apart by a 64-bit hash of doc_id and text. A text
    that an earlier document has word for word loses everything its length allows at once; only first
    copies are searched. All joins of texts share one exchange.
    """
    found = _searched(docs, ["doc_id"], untouched=False)
    return found.select(F.col("rest.doc_id").cast("long").alias("doc_id"), "n_words", "n_removed", "kept")


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs`, all its columns: a document that loses words has the kept ones, joined by one space, as its
    text; one that loses all of them goes; all others stay as they are, also those without a word."""
    found = _searched(docs, [x for x in docs.columns if x != "text"], untouched=True)
    left = found.filter("n_removed = 0 OR n_removed < n_words")
    return left.select(*(F.col("kept").alias(x) if x == "text" else F.col(f"rest.{quoted(x)}").alias(x) for x in docs.columns))
