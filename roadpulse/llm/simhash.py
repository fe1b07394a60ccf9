"""Near-duplicates by SimHash, candidates from pigeonring filtering.

The 64 bits of a fingerprint are a ring of `max_bits + 1` segments. If two fingerprints differ in
at most `max_bits` bits, some segment starts a chain round the ring whose first l segments differ
in at most l * max_bits / (max_bits + 1) bits, for every l: none in the first segment, at most one
in the first two, and so on. So the first segment is equal and one half of the second as well;
those bits are the join key, and the budgets of the longer chains are checked before the full
distance counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import repeat
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import IDENTITY, components, cut, identity, map_batches, pieces, raw_bytes

BITS = 64
#: Fingerprints with the same key that are compared pair by pair; larger buckets go by shared neighbours.
PAIRWISE = 64


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text, as a signed 64-bit number; 0 if it has no word.

    A to Z are lower-cased; every run of `shingle` words counts, each time it occurs; a text of
    fewer words is one shingle. A bit is set if it is set in over half of the hashes.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), seed)).astype(np.int64))
    ones, total = np.zeros(BITS, np.int64), len(words) - shingle + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    for start in range(0, total, 1 << 14):
        some = np.fromiter(hashes, "<u8", min(1 << 14, total - start))
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        prints = [fingerprint(x, shingle, seed) for x in raw_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row; null and empty texts have fingerprint 0."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, partial(_fingerprints, shingle=shingle, seed=seed), "doc_id long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments of the ring."""
    count = max_bits + 1
    widths = [BITS // count + (i < BITS % count) for i in range(count)]
    return [(sum(widths[:i]), width) for i, width in enumerate(widths)]


def _mask(*spans: tuple[int, int]) -> int:
    value = sum(((1 << width) - 1) << first for first, width in spans)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _keys(fp: Column, max_bits: int) -> Column:
    """The join keys: the start of a chain, the half of its second segment, and the bits of both."""
    ring, out = _segments(max_bits), []
    for i, span in enumerate(ring):
        first, width = ring[(i + 1) % len(ring)]
        for half, part in enumerate(((first, width // 2), (first + width // 2, width - width // 2))):
            bits = fp.bitwiseAND(F.lit(_mask(span, part)))
            out.append(F.struct(F.lit(2 * i + half).alias("slot"), bits.alias("bits")))
    return F.array(*out)


def _in_budget(slot: Column, differing: Column, max_bits: int) -> Column:
    """Whether the chain that starts at the slot's segment keeps every budget."""
    ring, kept = _segments(max_bits), F.lit(False)
    for i in range(len(ring)):
        chain = [ring[(i + k) % len(ring)] for k in range(len(ring))]
        within = [
            F.bit_count(differing.bitwiseAND(F.lit(_mask(*chain[:k])))) <= k * max_bits // len(ring)
            for k in range(1, len(ring) + 1)
        ]
        kept = kept | (slot.isin(2 * i, 2 * i + 1) & reduce(and_, within))
    return kept & (F.bit_count(differing) <= max_bits)


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(src, dst): edges between different fingerprints `fp` with the same components as all pairs
    that differ in at most `max_bits` bits, and only such pairs.

    Buckets of up to PAIRWISE fingerprints are joined pair by pair. In larger ones two fingerprints
    at most two bits apart have a number in common that is at most one bit from both: all that
    share such a number (at most 65) are linked to the smallest of them. That is linear in the
    bucket, whatever its size, and spread over the cluster. Beyond two bits large buckets are
    joined pair by pair too.
    """
    if max_bits == 0:
        return prints.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).limit(0)
    keyed = prints.select("fp").distinct().select("fp", F.explode(_keys(F.col("fp"), max_bits)).alias("k")).select("fp", "k.*")
    sizes = keyed.groupBy("slot", "bits").agg(F.count("*").alias("size")).filter("size > 1")
    shared = cut(keyed.join(sizes, ["slot", "bits"]))
    large = F.col("size") > (PAIRWISE if max_bits <= 2 else 1 << 62)
    small = shared.filter(~large)
    a = small.select("slot", "bits", F.col("fp").alias("src"))
    b = small.select("slot", "bits", F.col("fp").alias("dst"))
    near = _in_budget(F.col("a.slot"), F.col("src").bitwiseXOR(F.col("dst")), max_bits)
    same = (F.col("a.slot") == F.col("b.slot")) & (F.col("a.bits") == F.col("b.bits"))
    pairs = a.alias("a").join(b.alias("b"), same & (F.col("src") < F.col("dst")) & near)
    return pairs.select("src", "dst").union(_shared_neighbours(shared.filter(large).select("fp").distinct(), max_bits))


def _shared_neighbours(prints: DataFrame, max_bits: int) -> DataFrame:
    flips = F.array(F.lit(0), *(F.lit(_mask((i, 1))) for i in range(BITS)))
    around = prints.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("near"))
    if max_bits == 1:
        there = prints.select(F.col("fp").alias("near"))
        return around.filter("near < fp").join(there, "near", "left_semi").select(F.col("fp").alias("src"), F.col("near").alias("dst"))
    groups = around.groupBy("near").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    edges = groups.select(F.array_min("fps").alias("dst"), F.explode("fps").alias("src"))
    return edges.filter("src != dst").select("src", "dst").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs` (doc_id, text).

    component_id is the smallest doc_id among all documents reachable over links of at most
    `max_bits` differing bits. Texts without a word have fingerprint 0 and link like any other.
    Repeated rows stay repeated rows; rows without a doc_id link others but never name a component
    (a component of such rows alone has component_id null). Other columns are not looked at.
    """
    prints = cut(fingerprints(docs, shingle, seed))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    found = components(links(classes, max_bits)).withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = classes.join(found, "fp", "left").select("fp", "lowest", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """`docs`, all its columns, with one row of each group of near-duplicates: the one with the
    smallest doc_id, and of those the first by hash of its text. Rows without doc_id come last."""
    rows = docs.select(*identity(docs), F.col("text").cast("string"))
    prints = cut(map_batches(rows, partial(_identified, shingle=shingle, seed=seed), "id long, nameless boolean, text_hash long, fp long"))
    found = components(links(prints, max_bits)).withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = prints.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min(F.struct("nameless", "id", "text_hash")).alias("first")).select("first.*")
    packed = docs.select(*identity(docs), F.struct("*").alias("row"))
    kept = packed.join(first, IDENTITY, "left_semi")
    return kept.dropDuplicates(IDENTITY).select("row.*")


def _identified(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        prints = [fingerprint(x, shingle, seed) for x in raw_bytes(batch.column("text"))]
        known = [batch.column(x) for x in IDENTITY]
        yield pa.RecordBatch.from_arrays([*known, pa.array(prints, pa.int64())], [*IDENTITY, "fp"])
