"""Token counts by rank-synchronous merging of arrays.

The distinct pre-tokens of a batch stand as one ragged array: the symbols of all sequences one after the
other, and where each sequence starts. Every symbol carries the rank of the pair it begins. In a round each
sequence merges its own pairs of lowest rank, all sequences at once; only ranks beside a merge are looked up
again, and sequences without a known pair leave, their surviving symbols counted. Sequences longer than LONG
would make that many rounds over all their symbols; they go by chains instead, where a round visits
only the places of its rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.bpe import PATTERN, Vocabulary, load
from roadpulse.llm.common import map_batches, pieces, share, shared

NO_PAIR = np.iinfo(np.int32).max
#: Bytes of a pre-token from which on it is merged by chains.
LONG = 256
#: Pre-tokens that are held before they are counted, and distinct ones, and their letters, a task remembers.
HELD, REMEMBERED, LETTERS = 1 << 18, 400_000, 32 << 20


def ranks(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The rank of each pair of symbols, NO_PAIR where none is known."""
    if not len(vocabulary.keys):
        return np.full(len(left), NO_PAIR, np.int32)
    key = left.astype(np.int64) << 32 | right
    at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
    return np.where(vocabulary.keys[at] == key, vocabulary.ranks[at], NO_PAIR).astype(np.int32)


def results(vocabulary: Vocabulary) -> np.ndarray:
    """The symbol that each rank's pair becomes."""
    by_rank = np.zeros(len(vocabulary.ranks), np.int32)
    by_rank[vocabulary.ranks] = vocabulary.merged
    return by_rank


def every_other(follows: np.ndarray) -> np.ndarray:
    """In runs where each place follows the one before, the first, third and so on."""
    step = np.arange(len(follows))
    return (step - np.maximum.accumulate(np.where(follows, 0, step))) % 2 == 0


def surviving(words: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """How many symbols of each word no merge is left for."""
    counts = np.zeros(len(words), np.int64)
    by_rank = results(vocabulary)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for number in np.flatnonzero(sizes > LONG):
        counts[number] = _by_chains(words[number], vocabulary, by_rank)
    which = np.flatnonzero((sizes > 0) & (sizes <= LONG))
    symbols = vocabulary.of_byte[np.frombuffer(b"".join(words[i] for i in which), np.uint8)].astype(np.int32)
    lengths = sizes[which]
    starts = np.cumsum(lengths) - lengths
    rank = np.full(len(symbols), NO_PAIR, np.int32)
    if len(symbols):
        rank[:-1] = ranks(symbols[:-1], symbols[1:], vocabulary)
        rank[starts + lengths - 1] = NO_PAIR
    while len(symbols):
        lowest = np.minimum.reduceat(rank, starts)
        going = lowest < NO_PAIR
        counts[which[~going]] = lengths[~going]
        hit = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (rank < NO_PAIR))
        hit = hit[every_other(np.append(False, hit[1:] == hit[:-1] + 1)[: len(hit)])]
        symbols[hit] = by_rank[rank[hit]]
        # A merged symbol begins the pair its right half began; that pair and the one before it are new.
        rank[hit] = rank[hit + 1]
        stays = np.repeat(going, lengths)
        stays[hit + 1] = False
        fresh = np.zeros(len(symbols), bool)
        fresh[hit] = True
        lost = np.add.reduceat(~stays, starts) if len(starts) else lengths
        symbols, rank, fresh = symbols[stays], rank[stays], fresh[stays]
        which, lengths = which[going], (lengths - lost)[going]
        starts = np.cumsum(lengths) - lengths
        last = np.zeros(len(symbols) + 1, bool)
        last[starts + lengths - 1] = True
        look = fresh.copy()
        look[:-1] |= fresh[1:]
        look = np.flatnonzero(look & ~last[:-1])
        rank[look] = ranks(symbols[look], symbols[look + 1], vocabulary)
    return counts


def _by_chains(word: bytes, vocabulary: Vocabulary, by_rank: np.ndarray) -> int:
    """The surviving symbols of one long word: its symbols are linked, places wait by their pair's rank."""
    symbols = vocabulary.of_byte[np.frombuffer(word, np.uint8)].astype(np.int32)
    size = len(symbols)
    after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    rank = np.full(size, NO_PAIR, np.int32)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def look(places: np.ndarray) -> None:
        rank[places] = ranks(symbols[places], symbols[after[places]], vocabulary)
        places = places[rank[places] < NO_PAIR]
        places = places[np.argsort(rank[places], kind="stable")]
        found, first = np.unique(rank[places], return_index=True)
        for number, here in zip(found.tolist(), np.split(places, first[1:])):
            if number not in waiting:
                waiting[number] = []
                heapq.heappush(heap, number)
            waiting[number].append(here)

    look(np.arange(size - 1, dtype=np.int32))
    gone = 0
    while heap:
        lowest = heapq.heappop(heap)
        places = np.unique(np.concatenate(waiting.pop(lowest)))
        places = places[rank[places] == lowest]
        if not len(places):
            continue
        places = places[every_other(np.append(False, places[1:] == after[places[:-1]]))]
        halves = after[places]
        symbols[places], rank[halves], rank[places] = by_rank[lowest], NO_PAIR, NO_PAIR
        after[places] = after[halves]
        next_ = after[places]
        inside = next_ < size
        before[next_[inside]] = places[inside]
        gone += len(places)
        earlier = before[places]
        touched = np.unique(np.concatenate([places[inside], earlier[earlier >= 0]]))
        look(touched)
    return size - gone


class Counter:
    """Counts the tokens of texts, remembering the distinct pre-tokens it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.newer = regex.compile(f"[{vocabulary.newer}]") if vocabulary.newer else None
        by_length = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.known: dict[str, int] = {}
        self.letters = 0

    def _stretches(self, text: str) -> Iterator[tuple[int, str]]:
        """The text between special tokens, with the number of these in front."""
        start = 0
        for found in self.special.finditer(text) if self.special else ():
            yield 1, text[start : found.start()]
            start = found.end()
        yield 0, text[start:]

    def _words(self, text: str) -> Iterator[list[str]]:
        if self.newer and not text.isascii() and self.newer.search(text):
            from tokenizers.pre_tokenizers import ByteLevel  # its Unicode tables do not know these letters

            yield [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        elif len(text) < HELD:
            yield self.pattern.findall(text)
        else:
            found = self.pattern.finditer(text)
            while words := [x[0] for x in islice(found, HELD)]:
                yield words

    def _add(self, held: list[tuple[int, list[str]]], counts: np.ndarray) -> None:
        if len(self.known) > REMEMBERED or self.letters > LETTERS:
            self.known, self.letters = {}, 0
        new = list(set().union(*(words for _, words in held)).difference(self.known))
        self.known.update(zip(new, surviving([x.encode("utf-8", "surrogatepass") for x in new], self.vocabulary).tolist()))
        self.letters += sum(map(len, new))
        for number, words in held:
            counts[number] += sum(map(self.known.__getitem__, words))

    def count(self, texts: list[str]) -> np.ndarray:
        counts, held, size = np.zeros(len(texts), np.int64), [], 0
        for number, text in enumerate(texts):
            for specials, stretch in self._stretches(text):
                counts[number] += specials
                for words in self._words(stretch):
                    held.append((number, words))
                    size += len(words)
                    if size >= HELD:
                        self._add(held, counts)
                        held, size = [], 0
        self._add(held, counts)
        return counts


def _count(batches: Iterator[pa.RecordBatch], vocabulary, limit: int) -> Iterator[pa.RecordBatch]:
    counter = Counter(shared(vocabulary))
    for batch in pieces(batches, "text", 1 << 20):
        text = batch.column("text")
        tokens = counter.count([x or "" for x in text.to_pylist()])
        sizes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
        columns = [batch.column("doc_id"), sizes, pa.array(tokens), pa.array(tokens > limit)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of `docs` (doc_id, text), for the byte-level BPE
    vocabulary of a tokenizers JSON file.

    n_bytes are those of UTF-8, over_limit says whether a text has more than `limit` tokens. Null texts are
    empty, with no tokens; strings of special tokens inside a text are one token each, nothing is added or
    cut. Rows repeat as they come, doc_id may be null. A text is held whole, its pre-tokens are not; a
    pre-token takes some 30 bytes a byte while it is merged. Other columns are not looked at.
    """
    vocabulary = share(docs.sparkSession, load(path))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(rows, partial(_count, vocabulary=vocabulary, limit=limit), kinds)
