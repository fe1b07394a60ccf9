"""Language identification by interpolated Kneser-Ney character models.

One model per language predicts the letters of a word one after the other, and its end, from the
letters before; a text goes to the language of lowest cross-entropy per character. The counts come
from all documents that may be learned from, combined in each task before they are shuffled. All grams
of all orders stay in tables of Spark. Texts are packed in chunks, chunks put into groups of a size in
letters whatever the partitions they came in; the distinct grams of a group are joined to the models once,
and stand in its task as sorted hashes, each with its log-probability in every language.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import BATCH_ROWS, cut, held_out, map_batches, pieces

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ORDER = 5
START, END = "\x02", "\x03"
#: Distinct words a task counts at a time.
KEPT_WORDS = 200_000
UNKNOWN = "und"
LETTER, MARK = 1, 2
#: Letters and marks by runs of code points, as WORDS knows them: first, end, LETTER or MARK.
RUNS = [(*x.span(), x.lastindex) for x in regex.finditer(r"(\p{L}+)|(\p{M}+)", "".join(map(chr, range(sys.maxunicode + 1))))]
#: Characters from which on a text is cut by a table of all code points.
LONG = 300


def kinds() -> np.ndarray:
    """LETTER, MARK or 0 for each code point."""
    found = np.zeros(sys.maxunicode + 1, np.uint8)
    for start, end, kind in RUNS:
        found[start:end] = kind
    return found


def words_of(text: str, table: np.ndarray) -> list[str]:
    """WORDS of the text in small letters; `table` are the kinds of code points."""
    text = text.lower()
    if len(text) < LONG:
        return WORDS.findall(text)
    points = _points([text], 1).ravel()
    kind = table[points]
    marks = kind == MARK
    if marks.any():  # they are as the last character before them that is none
        kind = kind[np.maximum.accumulate(np.where(marks, 0, np.arange(len(kind))))]
    return str(np.where(kind == LETTER, points, np.uint32(0x20)), "utf-32-le").split()


def _windows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of the words, padded at the start and closed at the end, one word after the other;
    where each gram starts in them; how many grams each word has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    letters = _points(["".join(START * (ORDER - 1) + x + END for x in words)], 1).ravel()
    return letters, np.arange(sizes.sum()) + np.repeat((ORDER - 1) * np.arange(len(words)), sizes), sizes


def grams(words: dict[str, int]) -> dict[str, int]:
    """How often each run of ORDER characters occurs in the words, padded at the start, closed at the end."""
    if not words:
        return {}
    letters, starts, sizes = _windows(list(words))
    met = np.zeros(sys.maxunicode + 1, bool)
    met[letters] = True
    places, base = (np.cumsum(met) - 1)[letters], int(met.sum())
    names, most = places[starts], base
    for column in range(1, ORDER):  # a number a gram, without hashing: none stands for two
        if most * base >= 1 << 63:
            names = np.unique(names, return_inverse=True)[1]
            most = len(names)
        names, most = names * base + places[starts + column], most * base
    _, first, back = np.unique(names, return_index=True, return_inverse=True)
    times = np.zeros(len(first), np.int64)
    np.add.at(times, back, np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes))
    return dict(zip(_texts(letters[starts[first, None] + np.arange(ORDER)]), times.tolist()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    table = kinds()

    def flush() -> pa.RecordBatch:
        found = [(lang, *x) for lang, counter in words.items() for x in grams(counter).items()]
        words.clear()
        columns = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["lang", "gram", "times"])

    for batch in pieces(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text, table))
        if sum(map(len, words.values())) > KEPT_WORDS:
            yield flush()
    yield flush()


def _hashes(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of the last 1, 2, ... columns of a matrix of code points."""
    value, out = np.full(len(points), 0x9E3779B97F4A7C15, np.uint64), []
    for column in range(points.shape[1] - 1, -1, -1):
        value = (value ^ (points[:, column].astype(np.uint64) + np.uint64(1))) * np.uint64(0xFF51AFD7ED558CCD)
        value ^= value >> np.uint64(29)
        out.append(value)
    return out


def _points(texts: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, width)


def _texts(points: np.ndarray) -> list[str]:
    """The rows of a matrix of code points."""
    text, width = points.tobytes().decode("utf-32-le", "surrogatepass"), points.shape[1]
    return [text[i : i + width] for i in range(0, len(text), width)]


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


class Trained(NamedTuple):
    """The models of all languages, in Spark: weights[k] (lang, gram, weight) and contexts[k] (context, total,
    kinds: maps by language) of order k + 1, and the discounts of each order by language. Only what has a
    row a language and order is held by the driver: the discounts, and total and kinds of order 1."""

    langs: list[str]
    weights: list[DataFrame]
    contexts: list[DataFrame]
    discounts: list[list[float]]
    start: list[tuple[float, float]]
    floor: float


def _by_lang(column: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct("lang", F.col(column).cast("double")))).alias(column)


def train(docs: DataFrame) -> Trained | dict:
    """Models of all values of lang in `docs` (doc_id, text, lang), from all whole texts with a language
    that are not held out; {} if there are none. Counts are summed by Spark and every gram is kept:
    the models are tables that grow with the grams of the texts."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = map_batches(rows, _count, "lang string, gram string, times long").groupBy("lang", "gram").agg(F.sum("times").alias("weight"))
    weights = [cut(counted)]
    for order in range(ORDER - 1, 0, -1):
        shorter = weights[0].groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count("*").alias("weight"))
        weights.insert(0, cut(shorter))
    ones, twos = (F.sum((F.col("weight") == x).cast("long")) for x in (1, 2))
    sums = [{x.lang: x for x in table.groupBy("lang").agg(ones.alias("ones"), twos.alias("twos"), F.sum("weight").alias("total"), F.count("*").alias("kinds")).collect()} for table in weights]
    langs = sorted(sums[0])
    if not langs:
        return {}
    discounts = [[_discount(x[lang].ones, x[lang].twos) for lang in langs] for x in sums]
    contexts = []
    for order, table in enumerate(weights, 1):
        by_lang = table.groupBy("lang", F.substring("gram", 1, order - 1).alias("context")).agg(F.sum("weight").alias("total"), F.count("*").alias("kinds"))
        contexts.append(by_lang.groupBy("context").agg(_by_lang("total"), _by_lang("kinds")))
    letters = weights[0].select("gram").distinct().count() + 1  # and START, which no gram ends in
    start = [(float(sums[0][x].total), float(sums[0][x].kinds)) for x in langs]
    return Trained(langs, weights, contexts, discounts, start, 1.0 / (letters + 1))


def probabilities(models: Trained, wanted: DataFrame) -> DataFrame:
    """(gram, log_p) of the distinct grams of `wanted`: log-probabilities of the last character by
    language, as in `langs`. Order by order from the shortest, each distinct ending once: its own weight,
    that of its context, and the probability of the ending that is shorter by one."""
    known = None
    for order in range(1, ORDER + 1):
        ends = wanted.select(F.substring("gram", ORDER + 1 - order, order).alias("gram")).distinct()
        weight = models.weights[order - 1].groupBy("gram").agg(_by_lang("weight"))
        rows = ends.join(weight, "gram", "left")
        if order == 1:  # one context, the same for all
            names = F.array(*(F.struct(F.lit(x).alias("lang"), F.lit(d).alias("cut"), F.lit(total).alias("total"), F.lit(kinds).alias("kinds")) for x, d, (total, kinds) in zip(models.langs, models.discounts[0], models.start)))
            total, kinds, shorter = (lambda x: x["total"]), (lambda x: x["kinds"]), (lambda i: F.lit(models.floor))
        else:
            rows = rows.withColumn("context", F.substring("gram", 1, order - 1)).withColumn("rest", F.substring("gram", 2, order - 1))
            rows = rows.join(models.contexts[order - 1], "context", "left").join(known.select(F.col("gram").alias("rest"), F.col("p").alias("shorter")), "rest")
            names = F.array(*(F.struct(F.lit(x).alias("lang"), F.lit(d).alias("cut")) for x, d in zip(models.langs, models.discounts[order - 1])))
            total, kinds, shorter = (lambda x: F.col("total")[x["lang"]]), (lambda x: F.col("kinds")[x["lang"]]), (lambda i: F.col("shorter")[i])

        def p(x: Column, i: Column) -> Column:  # called by transform at once
            own = F.greatest(F.coalesce(F.col("weight")[x["lang"]], F.lit(0.0)) - x["cut"], F.lit(0.0))
            return F.coalesce((own + x["cut"] * kinds(x) * shorter(i)) / total(x), shorter(i))  # no total: context never met

        known = rows.select("gram", F.transform(names, p).alias("p"))
    return known.select("gram", F.transform("p", lambda x: F.log(x)).alias("log_p"))


PACKED = "chunk long, kind int, letters long, ids array<bigint>, blob binary"
#: Kinds of rows, in the order in which a chunk is scored.
GRAM, WORDS_OF, DOCS_OF = 0, 1, 2
#: Letters of distinct words up to which a chunk is filled, and tokens up to which documents share a row.
CHUNK_LETTERS, ROW_TOKENS = 3_000_000, 200_000
#: Letters that small chunks are gathered to on average, and that no team exceeds.
TEAM_LETTERS, MOST_LETTERS = 1_500_000, 12_000_000


class Places(dict):
    """Numbers words by first use."""

    letters = 0

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.letters += len(word) + 1
        return place


def _squeezed(numbers: np.ndarray) -> bytes:
    """Small whole numbers, the first bytes of all before their second bytes."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unsqueezed(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _pack(batches: Iterator[pa.RecordBatch], most_letters: int) -> Iterator[pa.RecordBatch]:
    """Documents in chunks. A row holds some documents of the chunk: how many words each has, the words'
    places in the chunk in rising order as steps, and how often they occur; one row holds the words."""
    chunk = TaskContext.get().partitionId() << 32
    index, ids, tokens, table = Places(), [], [], kinds()

    def row(kind: int, ids: list[int | None] | None, blob: bytes) -> pa.RecordBatch:
        numbers = [pa.array([chunk], pa.int64()), pa.array([kind], pa.int32()), pa.array([index.letters], pa.int64())]
        columns = [*numbers, pa.array([ids], pa.list_(pa.int64())), pa.array([blob], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "kind", "letters", "ids", "blob"])

    def documents() -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
        pairs, times = np.unique(doc << 32 | np.concatenate(tokens), return_counts=True)
        doc, at = pairs >> 32, pairs & 0xFFFFFFFF
        step = np.diff(at, prepend=0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        step[first] = at[first]
        found = row(DOCS_OF, ids, _squeezed(np.concatenate([np.bincount(doc, minlength=len(tokens)), step, times])))
        ids.clear(), tokens.clear()
        return found

    used = held = 0
    for batch in pieces(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text or "", table)
            ids.append(doc_id), tokens.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
            used, held = used + 1, held + len(words)
            full = index.letters > most_letters
            if full or held > ROW_TOKENS or len(ids) >= BATCH_ROWS:
                yield documents()
                held = 0
            if full:
                yield row(WORDS_OF, None, zlib.compress("\n".join(index).encode(), 1))
                index, used, chunk = Places(), 0, chunk + 1
    if ids:
        yield documents()
    if used:
        yield row(WORDS_OF, None, zlib.compress("\n".join(index).encode(), 1))


def neighbours(packed: DataFrame) -> int:
    """How many partitions in a row share their chunks, so that teams have TEAM_LETTERS letters on average,
    and MOST_LETTERS at most: one where partitions fill chunks of their own."""
    sizes = packed.filter(F.col("kind") == WORDS_OF).agg(F.avg("letters").alias("mean"), F.max("letters").alias("most")).first()
    if not sizes.most:
        return 1
    return max(1, min(int(TEAM_LETTERS / sizes.mean), int(MOST_LETTERS / sizes.most)))


def _spelled(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct grams of a chunk's words as hashes and as code points, the gram of each window of the
    words one after the other, and how many windows each word has."""
    words = zlib.decompress(blob).decode().split("\n") if blob else []
    words = words if words != [""] else []
    letters, starts, sizes = _windows(words)
    points = letters[starts[:, None] + np.arange(ORDER)]
    names, first, back = np.unique(_hashes(points)[-1], return_index=True, return_inverse=True)
    return names, points[first], back, sizes


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of chunks, those of a team side by side: each team's distinct grams by rising hash, with their places."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def found(team: int) -> Iterator[pa.RecordBatch]:
        names, points = (np.concatenate(x) for x in zip(*held))
        points = points[np.unique(names, return_index=True)[1]]
        for start in range(0, len(points), 50_000):
            part = points[start : start + 50_000]
            columns = [pa.array([team] * len(part), pa.int64()), pa.array(range(start, start + len(part)), pa.int32()), pa.array(_texts(part), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["team", "at", "gram"])

    team = None
    for batch in batches:
        for team_, blob in zip(batch.column("team").to_pylist(), batch.column("blob").to_pylist()):
            if team_ != team and held:
                yield from found(team)
                held.clear()
            team = team_
            held.append(_spelled(blob)[:2])
    if held:
        yield from found(team)


class Limits(NamedTuple):
    """How far the cross-entropy of a text may lie over the mean surprise of a language's training text."""

    langs: list[str]
    mean: list[float]
    deviation: list[float]


def judge(total: np.ndarray, size: int, limits: Limits, reject: float = 2.0, temper: float = 8.0) -> tuple[str, float, float | None, bool]:
    """(language, score, cross-entropy in nats a character, rejected) of a text by its log-likelihoods.

    The score is the posterior of the language under equal priors, of the likelihood tempered
    because neighbouring characters are not independent. A text is rejected if its cross-entropy
    lies over the language's own by more than `reject` deviations, and as many standard errors; its score
    then falls by the factor e for each nat it lies over that.
    """
    if not size:
        return UNKNOWN, 0.0, None, True
    best = int(np.argmax(total))
    posterior, entropy = 1.0 / np.exp((total - total[best]) / temper).sum(), -total[best] / size
    limit = limits.mean[best] + reject * limits.deviation[best] * (1 + size**-0.5)
    score = posterior * np.exp(min(0.0, limit - entropy))
    return limits.langs[best], float(score), float(entropy), bool(entropy > limit)


class Team:
    """What is known of a team: its grams' hashes, sorted, with log-probabilities, and the scores of its words."""

    def __init__(self, width: int):
        self.width, self.at, self.log_p, self.words = width, [], [], {}

    def scored(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By chunk the log-likelihoods and sizes of its words; the grams are given up for them."""
        if self.at is None:
            return self.words
        names = np.unique(np.concatenate([x[0] for x in self.words.values()]))
        table = np.zeros((len(names), self.width))
        if len(names):
            table[np.concatenate(self.at)] = np.concatenate(self.log_p)
        for chunk, (own, _, back, sizes) in self.words.items():
            scores, log_p = np.zeros((len(sizes), self.width)), table[np.searchsorted(names, own)]
            if len(sizes):
                for lang in range(self.width):
                    scores[:, lang] = np.add.reduceat(log_p[back, lang], np.cumsum(sizes) - sizes)
            self.words[chunk] = scores, sizes
        self.at = self.log_p = None
        return self.words


def _score(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Rows sorted by team and kind: the grams of a team with log-probabilities, the words of its chunks,
    their documents."""
    width, team, known = len(limits.langs), None, None
    for batch in batches:
        found = []
        teams, chunks, kinds = (batch.column(x).to_numpy() for x in ("team", "chunk", "kind"))
        edges = np.flatnonzero((np.diff(teams) != 0) | (np.diff(chunks) != 0) | (np.diff(kinds) != 0)) + 1
        for start, end in zip([0, *edges], [*edges, len(kinds)]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if teams[start] != team:
                team, known = teams[start], Team(width)
            if kinds[start] == GRAM:
                known.at.append(part.column("at").to_numpy())
                known.log_p.append(part.column("log_p").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            elif kinds[start] == WORDS_OF:
                names, _, back, sizes = _spelled(part.column("blob")[0].as_py())
                known.words[chunks[start]] = names, None, back, sizes
            else:
                scores, sizes = known.scored()[chunks[start]]
                for ids, blob in zip(part.column("ids").to_pylist(), part.column("blob").to_pylist()):
                    numbers = _unsqueezed(blob).astype(np.int64)
                    ends, rest = np.cumsum(numbers[: len(ids)]), numbers[len(ids) :].reshape(2, -1)
                    for doc_id, start_, end_ in zip(ids, [0, *ends], ends):
                        words, times = np.cumsum(rest[0, start_:end_]), rest[1, start_:end_]
                        found.append((doc_id, *judge(times @ scores[words], int(times @ sizes[words]), limits)))
        kinds = (pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
        columns = [pa.array(x, kind) for x, kind in zip(list(zip(*found)) or [()] * 5, kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])


def identify(docs: DataFrame, models: Trained | dict) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) per row of `docs` (doc_id, text).

    lang_pred is the language of lowest cross-entropy (the first by name among equals), whether
    rejected or not; `und` with score 0 for texts that are null or have no letter, and for all texts
    if there are no models. Repeated rows repeat; other columns are not looked at.

    Texts are packed in chunks, and chunks gathered in teams. The distinct grams of all teams are joined to
    the models' tables, and their log-probabilities sent back to the teams; so no task holds a model, and
    what is sent does not depend on the partitions that the texts came in."""
    schema = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not models:
        none = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
        return rows.select("doc_id", *none)
    packed = cut(map_batches(rows, partial(_pack, most_letters=CHUNK_LETTERS), PACKED))
    street, number = neighbours(packed), F.col("chunk").bitwiseAND(F.lit((1 << 32) - 1))
    # Of partitions in a row the first chunks are one team, their second chunks another.
    team = F.shiftleft(F.floor(F.shiftright("chunk", 32) / street), 32) + number
    packed = packed.withColumn("team", team).drop("letters")
    words = packed.filter(F.col("kind") == WORDS_OF).select("team", "blob")
    if street > 1:
        words = words.repartition("team").sortWithinPartitions("team")
    grams_ = map_batches(words, _grams_of, "team long, at int, gram string")
    learned = models.weights[-1]
    log_p = cut(probabilities(models, cut(grams_.select("gram").union(learned.select("gram")).distinct())))
    place = F.create_map(*(y for i, x in enumerate(models.langs) for y in (F.lit(x), F.lit(i))))
    surprise = learned.join(log_p, "gram").select("lang", "weight", (-F.col("log_p")[place[F.col("lang")]]).alias("s"))
    weighed = [F.sum(F.col("weight") * F.col("s") ** i) / F.sum("weight") for i in (1, 2)]
    found = {x.lang: x for x in surprise.groupBy("lang").agg(weighed[0].alias("mean"), weighed[1].alias("square")).collect()}
    mean = [found[x].mean for x in models.langs]
    limits = Limits(models.langs, mean, [max(0.0, found[x].square - y * y) ** 0.5 for x, y in zip(models.langs, mean)])
    scored = grams_.join(log_p, "gram").select("team", F.lit(GRAM).alias("kind"), "at", "log_p", F.lit(0).cast("long").alias("chunk"))
    dealt = scored.unionByName(packed, allowMissingColumns=True).repartition("team").sortWithinPartitions("team", "kind", "chunk")
    return map_batches(dealt, partial(_score, limits=limits), schema)
