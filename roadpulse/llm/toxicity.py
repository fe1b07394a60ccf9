"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's log-odds are a bias and the sum of its distinct words' weights;
the document's probability is the noisy-or of its sentences: toxic unless every sentence is clean. The
weights are learned from document labels alone, and the sentences they mark are the offending ones.
A word counts by itself and by its first letters, so that inflected forms share what is learned.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadpulse.llm.common import cut, held_out, map_batches, pieces, share, shared

#: Letters are words; these marks end a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n。！？]")
ENDS = frozenset(".!?\n。！？")
PREFIXES = (4, 5, 6)
#: Labelled documents of each label that a model is fitted on at most: those first in hash order.
SAMPLE = 4000
#: A feature's words must occur this often in the sample, counted once a document.
LEAST_DOCUMENTS = 3
KEPT_WORDS = 300_000


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence that has any, lower-cased, each once in order."""
    out: list[dict[str, None]] = [{}]
    for token in TOKEN.findall(text.lower()):
        if token not in ENDS:
            out[-1][token] = None
        elif out[-1]:
            out.append({})
    return list(map(list, out if out[-1] else out[:-1]))


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray, rounds: int = 200, rate: float = 0.1, sparsity: float = 2e-5) -> dict[str, float]:
    """Weights by feature, the bias under "", by proximal gradient steps (Adam scaling) on the weighted
    noisy-or likelihood; `sparsity` is the L1 penalty that leaves most features without weight."""
    index: dict[str, int] = {}
    word, sentence, document = array("i"), array("i"), array("i")
    for number, text in enumerate(texts):
        for words in sentences(text):
            word.extend(index.setdefault(x, len(index)) for x in words)
            sentence.extend([len(document)] * len(words))
            document.append(number)
    word, sentence, document = (np.array(x, np.int32) for x in (word, sentence, document))
    names: dict[str, int] = {}
    pairs = [(w, names.setdefault(x, len(names))) for text, w in index.items() for x in features(text)]
    of_word, feature = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
    if not len(word):
        return {"": -50.0}
    # words and their documents, once each; then the documents of each feature
    seen = np.unique(document[sentence].astype(np.int64) * len(index) + word)
    docs_of_word = np.bincount(seen % len(index), minlength=len(index))
    often = np.bincount(feature, docs_of_word[of_word], len(names)) >= LEAST_DOCUMENTS
    used = often[feature]
    of_word, feature = of_word[used], feature[used]

    weight, bias = np.zeros(len(names)), -9.0
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    total = max(weights.sum(), 1e-9)
    for step in range(1, rounds + 1):
        score = np.bincount(of_word, weight[feature], len(index))
        z = bias + np.bincount(sentence, score[word], len(document))
        p, clean = 1 / (1 + np.exp(-np.maximum(z, -500))), np.bincount(document, np.logaddexp(0, z), len(texts))
        q = np.clip(np.exp(-clean), 0, 1 - 1e-9)
        pull = weights / total * np.where(labels == 1, -q / (1 - q), 1.0)
        slope = pull[document] * p
        by_word = np.bincount(word, slope[sentence], len(index))
        gradient = np.append(np.bincount(feature, by_word[of_word], len(names)), slope.sum())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        scale = np.sqrt(square / (1 - 0.99**step)) + 1e-8
        move = rate * mean / (1 - 0.9**step) / scale
        bias -= move[-1]
        weight -= move[:-1]
        shrink = np.minimum(rate * sparsity / scale[:-1], 0.5)
        weight = np.sign(weight) * np.maximum(np.abs(weight) - shrink, 0)
    return {"": float(bias)} | {x: float(weight[i]) for x, i in names.items() if weight[i]}


class Scorer(dict):
    """The weight of a word, kept for up to KEPT_WORDS words."""

    def __init__(self, model: dict[str, float]):
        self.model, self.bias = model, model.get("", -4.0)

    def __missing__(self, word: str) -> float:
        if len(self) > KEPT_WORDS:
            self.clear()
        score = self[word] = sum(self.model.get(x, 0.0) for x in features(word))
        return score

    def document(self, text: str) -> float:
        """The noisy-or of the sentences; 0 without a sentence."""
        clean = 0.0
        found = [sum(map(self.__getitem__, words)) + self.bias for words in sentences(text)]
        if found:
            clean = float(np.logaddexp(0, np.array(found)).sum())
        return -float(np.expm1(-clean))

    def offending(self, text: str, least: float = 0.5) -> list[dict]:
        """Where the sentences of probability `least` or more stand (code points), with the probability;
        if there are none, the most probable sentence."""
        found, start, z, last = [], 0, self.bias, 0
        words: set[str] = set()
        for token in [*TOKEN.finditer(text), None]:
            if token is None or token[0] in ENDS:
                if words:
                    found.append({"start": start, "end": token.end() if token else last, "score": float(1 / (1 + np.exp(-max(z, -500.0))))})
                z, words = self.bias, set()
            else:
                start, last, word = start if words else token.start(), token.end(), token[0].lower()
                z += 0.0 if word in words else self[word]
                words.add(word)
        return [x for x in found if x["score"] >= least] or sorted(found, key=lambda x: -x["score"])[:1]


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(label, weight, text): at most `most` labelled documents of each label, first in order of a hash
    of their id, with the weight that restores the labels' shares. Rows held out are never among them.

    A document's label is the largest it is given (labels: doc_id, toxic); null labels are none.
    """
    given = labels.filter("toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = given.filter(~held_out(F.col("doc_id"))).join(there.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = cut(ids)
    draw = F.xxhash64("doc_id")
    picked = [ids.filter(F.col("label") == x).orderBy(draw, "doc_id").limit(most) for x in (0, 1)]
    shares = ids.groupBy("label").agg(F.greatest(F.lit(1.0), F.count("*") / F.lit(most)).alias("weight"))
    chosen = picked[0].union(picked[1]).join(F.broadcast(shares), "label")  # 2 * most rows
    return there.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("label", "weight", "text")


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.to_pylist()]
    rows.sort(key=lambda x: (x["label"], x["text"] or ""))
    if rows:
        model = fit([x["text"] or "" for x in rows], np.array([x["label"] for x in rows]), np.array([x["weight"] for x in rows], float))
        yield pa.RecordBatch.from_pydict({"feature": list(model), "weight": list(model.values())})


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict[str, float]:
    """The model, fitted by one task on the bounded sample; empty if there is nothing to learn from."""
    rows = map_batches(sample(docs, labels, most).repartition(1), _fit, "feature string, weight double").collect()
    return {x["feature"]: x["weight"] for x in rows}


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(shared(model))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for batch in pieces(batches, "text"):
        texts = [x or "" for x in batch.column("text").to_pylist()]
        scores = [scorer.document(x) for x in texts]
        spans = [scorer.offending(x) if p >= 0.5 else [] for x, p in zip(texts, scores)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)], [*batch.schema.names, "score", "offending"])


SCORED = "score double, offending array<struct<start: int, end: int, score: double>>"


def score(docs: DataFrame, model: dict[str, float]) -> DataFrame:
    """(doc_id, score, offending) per row of `docs` (doc_id, text): the probability that the document is
    toxic and, where it is 0.5 or more, the sentences that make it so. Null and empty texts have score 0, as
    has everything under an empty model. Repeated rows repeat; other columns are not looked at."""
    sent = share(docs.sparkSession, model or {"": -50.0})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = map_batches(rows, partial(_score, model=sent), f"doc_id long, text string, {SCORED}")
    return scored.select("doc_id", "score", "offending")


def keep_clean(docs: DataFrame, model: dict[str, float], most: float = 0.5) -> DataFrame:
    """`docs`, all its columns, without the documents that score `most` or more."""
    sent = share(docs.sparkSession, model or {"": -50.0})
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    scored = map_batches(rows, partial(_score, model=sent), StructType([*rows.schema, *StructType.fromDDL(SCORED)]))
    return scored.filter(F.col("score") < most).select("row.*")
