"""Document fingerprints: the quartile bucket digest.

Every run of three bytes is hashed to one of 512 buckets. A bucket is encoded by the quartile of all
buckets' counts that its own count falls into (two bits), before that the logarithm of the length (one
byte). Digests are compared bucket by bucket, with a bounded score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import IDENTITY, cut, doc_id, identity, map_batches, pieces

BITS = 9
#: Mean difference of two independent codes from 0 to 3: at this score digests are unrelated.
UNRELATED = 1.25
#: Steps of length (each a tenth more) that count like one bucket's difference.
LENGTH_STEPS = 4


def fingerprint(data: bytes) -> str:
    """The digest as hex: one byte for the length, then the codes of four buckets a byte."""
    counts = np.zeros(1 << BITS, np.int64)
    for start in range(0, max(len(data) - 2, 0), 1 << 20):
        a = np.frombuffer(data[start : start + (1 << 20) + 2], np.uint8).astype(np.uint32)
        triplets = (a[:-2] | a[1:-1] << 8 | a[2:] << 16) * np.uint32(0x9E3779B1)
        counts += np.bincount(triplets >> np.uint32(32 - BITS), minlength=1 << BITS)
    cuts = [len(counts) * k // 4 - 1 for k in (1, 2, 3)]
    bounds = np.partition(counts, cuts)[cuts]
    codes = (counts[:, None] > bounds).sum(axis=1).reshape(-1, 4)
    length = min(255, round(math.log(len(data) + 1, 1.1)))
    return bytes([length, *(codes @ [64, 16, 4, 1]).tolist()]).hex()


def _codes(digest: str) -> tuple[int, np.ndarray]:
    data = np.frombuffer(bytes.fromhex(digest), np.uint8)
    return int(data[0]), (data[1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 where they differ as much as unrelated texts or more."""
    (a, codes_a), (b, codes_b) = _codes(one), _codes(other)
    apart = np.abs(codes_a.astype(np.int8) - codes_b.astype(np.int8)).sum() + abs(a - b) / LENGTH_STEPS
    return max(0.0, 1.0 - float(apart) / (UNRELATED * (1 << BITS)))


def edited(text: str, following: str) -> str:
    """The text whose last quarter of code points gives way to as many of the next, or all it has."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def following(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """`rows` (IDENTITY, n_chars), distinct, each with the identity of the next in order (next_*).

    Order: rows with a doc_id first, by doc_id, then hash of the text; the first row follows the last.
    The rows are range-sorted and written; a partition's last row is followed by the first row of the
    next partition that has any, one small row each.
    """
    count = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["nameless", "id", "text_hash"]
    placed = cut(rows.distinct().repartitionByRange(count, *order)).withColumn("at", F.spark_partition_id())
    here = F.struct(*order)
    inside = placed.withColumn("next", F.lead(here).over(Window.partitionBy("at").orderBy(*order)))
    firsts = placed.groupBy("at").agg(F.min(here).alias("first"))  # at most `count` rows
    ordered = Window.orderBy("at")
    wrapped = firsts.select("at", F.coalesce(F.lead("first").over(ordered), F.min("first").over(Window.partitionBy())).alias("first"))
    joined = inside.join(F.broadcast(wrapped), "at").withColumn("next", F.coalesce("next", "first"))
    return joined.select(*IDENTITY, "n_chars", *(F.col(f"next.{x}").alias(f"next_{x}") for x in IDENTITY))


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's digest and the start of its text, for the document before it."""
    for batch in pieces(batches, "text"):
        to = [batch.column(x) for x in IDENTITY]
        texts, wanted = batch.column("text").to_pylist(), batch.column("wanted").to_pylist()
        starts = pa.array([x[:n] for x, n in zip(texts, wanted)], pa.string())
        prints = pa.array([bytes.fromhex(fingerprint(x.encode())) for x in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*to, starts, prints], [*IDENTITY, "start", "next_fingerprint"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        texts, starts = batch.column("text").to_pylist(), batch.column("start").to_pylist()
        changed = [edited(x, y).encode() for x, y in zip(texts, starts)]
        own, other = [fingerprint(x.encode()) for x in texts], [fingerprint(x) for x in changed]
        after = [x.hex() for x in batch.column("next_fingerprint").to_pylist()]
        columns = [
            pa.array([len(x) for x in texts], pa.int64()),
            pa.array([sha256(x).hexdigest() for x in changed], pa.string()),
            pa.array(own, pa.string()),
            pa.array(other, pa.string()),
            pa.array(map(likeness, own, other), pa.float64()),
            pa.array(map(likeness, own, after), pa.float64()),
        ]
        names = [*IDENTITY, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in IDENTITY), *columns], names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row
    of `docs` (doc_id, text).

    The next document is the next distinct (doc_id, text); the only one follows itself. Null texts are
    empty, rows without a doc_id come last, repeated rows get equal results. Texts move once, by
    identity; the next document sends its digest and as much of its text as is wanted. Other columns
    are not looked at.
    """
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.select(*identity(texts), "text")
    after = following(texts.select(*IDENTITY, F.length("text").cast("long").alias("n_chars")))
    next_is = [F.col(f"next_{x}").alias(x) for x in IDENTITY]
    to = [F.col(x).alias(f"to_{x}") for x in IDENTITY]
    wants = after.select(*to, F.floor(F.col("n_chars") / 4).alias("wanted"), *next_is)
    asked = texts.join(wants, IDENTITY).select(*(F.col(f"to_{x}").alias(x) for x in IDENTITY), "text", "wanted")
    kinds = "id long, nameless boolean, text_hash long"
    sent = map_batches(asked, _send, f"{kinds}, start string, next_fingerprint binary").dropDuplicates(IDENTITY)
    result = f"{kinds}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    compared = map_batches(texts.join(sent, IDENTITY), _compare, result)
    return compared.select(doc_id(), *compared.columns[len(IDENTITY) :])
