"""Byte-level BPE in batched numpy merge rounds, and back.

The distinct pre-tokens of a batch stand as symbols in one flat array. In each round the pairs of
neighbouring symbols are looked up by binary search in the sorted keys of all merges, every word's
pairs of lowest rank are merged, and words without a known pair leave. The rounds are as many as the
longest word needs; their work shrinks with the words that are left. Words of more than LONG bytes go one
by one: their places are kept by rank, and a round visits only those of the lowest rank and their neighbours.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_batches, pieces, share, shared

#: Fixed value: the public pattern of byte-level BPE vocabularies that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.iinfo(np.int64).max
#: Bytes of a word beyond which it is merged by itself.
LONG = 256
#: Distinct pre-tokens a task keeps encoded before it starts afresh.
KEPT_WORDS = 400_000


class Vocabulary(NamedTuple):
    """Sorted keys of the merges with their ranks and results, ids of single bytes, bytes by id."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    of_byte: np.ndarray
    tokens: list[bytes]
    special: dict[str, int]
    newer: str


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def _newer_letters() -> str:
    """Letters and digits of `regex` that this Python's tables do not have yet, as a character class.
    Libraries differ in them by the Unicode version they were built with."""
    points = "".join(chr(x) for x in range(0x80, 0x110000) if not 0xD800 <= x < 0xE000)
    found = [ord(x) for x in regex.findall(r"[\p{L}\p{N}]", points) if unicodedata.category(x) == "Cn"]
    breaks = [i for i in range(len(found) + 1) if i in (0, len(found)) or found[i] != found[i - 1] + 1]
    return "".join(f"{chr(found[a])}-{chr(found[b - 1])}" for a, b in zip(breaks, breaks[1:]) if b > a)


def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizers JSON file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    vocab, added = stored["model"]["vocab"], {x["content"]: x["id"] for x in stored["added_tokens"]}
    letters = _byte_letters()
    of_letter = {letter: byte for byte, letter in enumerate(letters)}
    tokens = [b""] * (1 + max(max(vocab.values()), *added.values(), 0))
    for token, number in vocab.items():
        tokens[number] = bytes(of_letter[x] for x in token)
    for token, number in added.items():
        tokens[number] = token.encode()
    pairs = [x.split(" ") if isinstance(x, str) else x for x in stored["model"]["merges"]]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    of_byte = np.array([vocab[x] for x in letters], np.int64)
    return Vocabulary(keys[order], order.astype(np.int64), merged[order], of_byte, tokens, added, _newer_letters())


def _find(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair of symbols stands among the merges, and its rank: NONE if it is no merge."""
    key = left << 32 | right
    at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
    return at, np.where(vocabulary.keys[at] == key, vocabulary.ranks[at], NONE)


def merge_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """The token ids of one word, in a time that grows with its length and merges, not with their product."""
    symbols = vocabulary.of_byte[np.frombuffer(word, np.uint8)]
    if len(symbols) < 2 or not len(vocabulary.keys):
        return symbols
    following, previous = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    pair, rank = np.zeros(len(symbols), np.int64), np.full(len(symbols), NONE)
    ranks: list[int] = []
    places_of: dict[int, list[np.ndarray]] = {}
    changed = np.arange(len(symbols) - 1)
    while True:
        pair[changed], rank[changed] = _find(symbols[changed], symbols[following[changed]], vocabulary)
        changed = changed[rank[changed] != NONE]
        changed = changed[np.argsort(rank[changed], kind="stable")]
        starts = np.flatnonzero(np.diff(rank[changed], prepend=-1))
        for number, places in zip(rank[changed[starts]].tolist(), np.split(changed, starts[1:])):
            if number not in places_of:
                heapq.heappush(ranks, number)
            places_of.setdefault(number, []).append(places)
        if not ranks:
            break
        lowest = heapq.heappop(ranks)
        first = np.unique(np.concatenate(places_of.pop(lowest)))
        first = first[rank[first] == lowest]  # others have been merged, or their neighbours have
        first = first[_every_other(np.append(True, first[1:] != following[first[:-1]])[: len(first)])]
        second = following[first]
        symbols[first] = vocabulary.merged[pair[first]]
        symbols[second], rank[first], rank[second] = -1, NONE, NONE
        following[first] = following[second]
        ahead = first[following[first] < len(symbols)]
        previous[following[ahead]] = ahead
        behind = previous[first]
        changed = np.unique(np.concatenate([ahead, behind[behind >= 0]]))
    return symbols[symbols >= 0]


def _every_other(run: np.ndarray) -> np.ndarray:
    """The first, third and so on of each run, whose starts are given."""
    step = np.arange(len(run))
    return (step - np.maximum.accumulate(np.where(run, step, 0))) % 2 == 0


def merge(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All words' token ids in one array, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    long = np.flatnonzero(sizes > LONG)
    done = [(np.full(len(ids), i), ids) for i in long.tolist() for ids in [merge_long(words[i], vocabulary)]]
    short = np.flatnonzero(sizes <= LONG)
    symbols = vocabulary.of_byte[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
    word = np.repeat(short, sizes[short])
    while len(symbols):
        at, rank = _find(symbols, np.append(symbols[1:], -1), vocabulary)
        rank[np.append(word[1:] != word[:-1], True)] = NONE
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
        ended = lowest == NONE
        done.append((word[ended], symbols[ended]))
        first = np.flatnonzero(~ended & (rank == lowest))
        if len(first):  # in a run such as aaaa every other pair
            first = first[_every_other(np.append(True, first[1:] != first[:-1] + 1))]
            symbols[first] = vocabulary.merged[at[first]]
        going = ~ended
        going[first + 1] = False
        symbols, word = symbols[going], word[going]
    owner = np.concatenate([x for x, _ in done]) if done else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    ids = np.concatenate([x for _, x in done])[order] if done else owner
    return ids.astype("<u4"), np.bincount(owner, minlength=len(words))


def _in_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


class Encoder:
    """Encodes texts, keeping the distinct pre-tokens it has met, up to KEPT_WORDS."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.newer = regex.compile(f"[{vocabulary.newer}]") if vocabulary.newer else None
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special)))
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.array(list(self.vocabulary.special.values()), "<u4")
        self.sizes = np.ones(len(self.ids), np.int64)
        self.index.update({f"\0{x}": i for i, x in enumerate(self.vocabulary.special)})

    def _split(self, text: str) -> list[str]:
        if self.newer and not _in_latin(text) and self.newer.search(text):
            from tokenizers.pre_tokenizers import ByteLevel  # the reference splitter, with its own Unicode tables

            return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def _words(self, text: str) -> list[str]:
        """Pre-tokens; a special token is marked by a leading NUL, which no pre-token of letters has."""
        if not any(x in text for x in self.vocabulary.special):
            return self._split(text)
        words, start = [], 0
        for found in self.special.finditer(text):
            words += self._split(text[start : found.start()]) + [f"\0{found[0]}"]
            start = found.end()
        return words + self._split(text[start:])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.index) > KEPT_WORDS:
            self._forget()
        split = [self._words(x or "") for x in texts]
        new = list(set().union(*split).difference(self.index))
        if new:
            ids, sizes = merge([x.encode("utf-8", "surrogatepass") for x in new], self.vocabulary)
            self.index.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        ends = np.cumsum(self.sizes)
        out = []
        for words in split:
            at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            sizes = self.sizes[at]
            shift = np.repeat(ends[at] - np.cumsum(sizes), sizes)
            out.append(self.ids[shift + np.arange(len(shift))])
        return out


def decode_ids(ids: bytes, tokens: list[bytes]) -> str:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _encode(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(shared(vocabulary))
    for batch in pieces(batches, "text", 1 << 20):
        ids = [x.tobytes() for x in encoder.encode(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    tokens = shared(vocabulary)
    for batch in pieces(batches, "ids", 4 << 20):
        texts = [decode_ids(x or b"", tokens) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) per row of `docs` (doc_id, text): the ids one after the other as little-endian
    unsigned 32-bit integers. Null texts are empty; rows repeat as they come; nothing is added or cut,
    and special tokens' strings in a text are those tokens. Other columns are not looked at."""
    vocabulary = share(docs.sparkSession, load(path))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, partial(_encode, vocabulary=vocabulary), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) per row of `encoded` (doc_id, ids). Null ids are none; bytes that are no
    UTF-8 become U+FFFD; an id beyond the vocabulary is an error."""
    vocabulary = share(encoded.sparkSession, load(path).tokens)
    rows = encoded.select("doc_id", "ids")
    return map_batches(rows, partial(_decode, vocabulary=vocabulary), "doc_id long, ids binary, text string")


def _round_trip(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    known = shared(vocabulary)
    encoder = Encoder(known)
    for batch in pieces(batches, "text", 1 << 20):
        ids = [x.tobytes() for x in encoder.encode(batch.column("text").to_pylist())]
        texts = [decode_ids(x, known.tokens) for x in ids]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`decode(encode(docs))` in one pass of Python: (doc_id, ids, text)."""
    vocabulary = share(docs.sparkSession, load(path))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, partial(_round_trip, vocabulary=vocabulary), "doc_id long, ids binary, text string")
