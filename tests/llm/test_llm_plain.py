"""Digests and toxicity scores against computations written another way, step by step."""

from __future__ import annotations

import math
import re

import pytest

from roadpulse.llm import digest, toxicity

SMALL = "/root/testdata/sf0.001"


def plain_digest(text: str) -> tuple[int, list[int]]:
    """The length code, and of each bucket how many quartiles of all buckets' counts it lies over."""
    data, counts = text.encode(), [0] * 512
    for i in range(len(data) - 2):
        triplet = data[i] + 256 * data[i + 1] + 65536 * data[i + 2]
        counts[(triplet * 0x9E3779B1) % 2**32 // 2**23] += 1
    ranked = sorted(counts)
    quartiles = [ranked[127], ranked[255], ranked[383]]
    return min(255, round(math.log(len(data) + 1, 1.1))), [sum(x > q for q in quartiles) for x in counts]


def plain_likeness(one: str, other: str) -> float:
    (a, x), (b, y) = plain_digest(one), plain_digest(other)
    apart = sum(abs(p - q) for p, q in zip(x, y)) + abs(a - b) / 4
    return max(0.0, 1 - apart / 640)


def taken_apart(fingerprint: str) -> tuple[int, list[int]]:
    numbers = list(bytes.fromhex(fingerprint))
    return numbers[0], [x // 4**k % 4 for x in numbers[1:] for k in (3, 2, 1, 0)]


def test_digests_equal_a_plain_computation(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").filter("doc_id IS NOT NULL")
    texts = {x.doc_id: x.text or "" for x in docs.collect()}
    order = sorted(texts)
    found = {x.doc_id: x for x in digest.compare_with_next(docs).collect()}
    assert sorted(found) == order
    for at, doc_id in enumerate(order[:60]):
        text, following = texts[doc_id], texts[order[(at + 1) % len(order)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert taken_apart(found[doc_id].fingerprint) == plain_digest(text)
        assert taken_apart(found[doc_id].edited_fingerprint) == plain_digest(edited)
        assert found[doc_id].near_edited == pytest.approx(plain_likeness(text, edited))
        assert found[doc_id].near_next == pytest.approx(plain_likeness(text, following))


def plain_score(text: str, model: dict[str, float]) -> float:
    """One less the probability that every sentence is clean."""
    clean = 1.0
    for sentence in re.split(r"[.!?\n。！？]", text.lower()):
        words = set(re.findall(r"[^\W\d_]+", sentence))
        if words:
            z = model[""] + sum(model.get(x, 0.0) + sum(model.get(f"{x[:n]}*", 0.0) for n in (4, 5, 6) if len(x) >= n) for x in words)
            clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_scores_equal_a_plain_noisy_or(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    fitted = toxicity.train(docs, labels)
    model = {"": -2.0, "idiot": 1.5, "idio*": 0.5, "moron": 2.25, "good": -1.0, "idiots*": 9.0}
    by_hand = "Good night, idiot! You MORON and moron. 12? idiotic\nall is well"
    assert toxicity.Scorer(model).document(by_hand) == pytest.approx(plain_score(by_hand, model), abs=1e-12)
    assert toxicity.Scorer(model).document("") == 0 == plain_score("", model)
    texts = {x.doc_id: x.text or "" for x in docs.select("doc_id", "text").collect()}
    marked = dict(labels.select("doc_id", "toxic").collect())
    found = {x.doc_id: x.score for x in toxicity.score(docs, fitted).select("doc_id", "score").collect()}
    scorer = toxicity.Scorer(fitted)
    assert len(found) == len(texts)
    for doc_id, text in texts.items():
        assert found[doc_id] == pytest.approx(scorer.document(text), abs=1e-12)
        if fitted and len(text) < 20_000:
            assert found[doc_id] == pytest.approx(plain_score(text, fitted), abs=1e-9)
    assert any(found[x] >= 0.5 for x, toxic in marked.items() if toxic == 1 and x in found)
