"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c or more are at a squared distance of 2 - 2c or less. Vectors are rotated, so
that their length spreads evenly, and split into blocks of BLOCK dimensions; of two linked vectors, at
least one block must keep within its proportional share of that distance. Each block is joined by range:
the vectors are cut into slabs by the block's first coordinate, as wide as twice the radius, and a vector
also visits the slab below if it is in reach of it. Slabs with many vectors are cut into tiles by hash, so
that a task compares a bounded number with a bounded number. What passes in some block is verified with
exact cosines. A pair belongs to the first block it passes in: it is counted there and nowhere else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import components, cut, map_batches

BLOCK = 16
#: Vectors of a slab that are compared in one task, and numbers in them: longer vectors are fewer.
TILE, TILE_NUMBERS = 32768, 1 << 22
#: Pairs whose block distances are computed at a time.
STRIP = 1 << 19
SLACK = 1e-5


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.RandomState(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _blocks(size: int) -> list[tuple[int, int]]:
    count = max(1, size // BLOCK)
    edges = [size * i // count for i in range(count + 1)]
    return list(zip(edges, edges[1:]))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _slabs(vectors: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block: its number, the slab of every vector, and whether it is in reach of the slab below."""
    turned = _units(vectors) @ rotation(vectors.shape[1])
    distance = max(0.0, 2 - 2 * least)
    for number, (a, b) in enumerate(_blocks(vectors.shape[1])):
        radius = np.sqrt(distance * (b - a) / vectors.shape[1]) + SLACK
        place = turned[:, a] / (2 * radius)
        slab = np.floor(place)
        yield number, slab.astype(np.int64), place - slab <= 0.5


def _matrix(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each length: their places, and a matrix in double precision."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)]


def _homes(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, vectors in _matrix(batch.column("vector")):
            for number, slab, _ in _slabs(vectors, least):
                values, counts = np.unique(slab, return_counts=True)
                columns = [np.full(len(values), vectors.shape[1]), np.full(len(values), number), values, counts]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["size", "block", "slab", "n"])


def _visits(batches: Iterator[pa.RecordBatch], least: float, tiles: dict[tuple[int, int, int], int]) -> Iterator[pa.RecordBatch]:
    """One row for each comparison a vector takes part in: the slab's tiles (a, b), and its side."""
    names = ["size", "block", "slab", "tile_a", "tile_b", "side", "node", "copies", "vector"]
    for batch in batches:
        nodes, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        for rows, vectors in _matrix(batch.column("vector")):
            size, node = vectors.shape[1], nodes[rows]
            draw = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            narrow = vectors.astype(np.float32)
            data = np.array([x.tobytes() for x in (narrow if (narrow == vectors).all() else vectors)], object)
            for number, slabs, reaches in _slabs(vectors, least):
                for slab in np.unique(slabs):
                    here = np.flatnonzero(slabs == slab)
                    own, below, above = (tiles.get((size, number, int(slab) + x), 0) for x in (0, -1, 1))
                    tile = draw[here] % own
                    visits = []
                    for other in range(own):  # among its own: tiles a <= b, a vector on side 0 of b, 1 of a
                        low, high = np.minimum(tile, other), np.maximum(tile, other)
                        visits.append((here, slab, low, high, np.where(tile <= other, 0, 1)))
                    for other in range(above):  # as host of guests from above: their tiles are numbered after its own
                        visits.append((here, slab, tile, np.full(len(here), own + other), np.zeros(len(here), np.int64)))
                    guests = reaches[here]
                    for other in range(below):
                        visits.append((here[guests], slab - 1, np.full(guests.sum(), other), below + tile[guests], np.ones(guests.sum(), np.int64)))
                    for which, at, a, b, side in visits:
                        if len(which):
                            count = len(which)
                            numbers = [np.full(count, size), np.full(count, number), np.full(count, at), a, b, side, node[which], copies[rows][which]]
                            yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in numbers), pa.array(data[which], pa.binary())], names)


def forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For each of `count` nodes the smallest one it is connected to by the links a-b."""
    label = np.arange(count)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def linked(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, number: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of `vectors`, one of `left` and one of `right`) that belong to the block and have a
    cosine of `least` or more. If left and right are the same rows, each pair comes once.

    Both sides go by the block's second coordinate, so a strip of one meets only what is in reach."""
    units = _units(vectors)
    turned, blocks = units @ rotation(vectors.shape[1]), _blocks(vectors.shape[1])
    share = max(0.0, 2 - 2 * least) / vectors.shape[1]
    a, b = blocks[number]
    part = turned[:, a:b].astype(np.float32)
    half = (part * part).sum(axis=1, keepdims=True) / 2
    one, other = np.hstack([part, -half, -np.ones_like(half)]), np.hstack([part, np.ones_like(half), half])
    same = left is right
    reach, radius = np.float32(-share * (b - a) / 2 - SLACK), np.sqrt(share * (b - a)) + SLACK
    by = turned[:, min(a + 1, b - 1)]
    left = left[np.argsort(by[left], kind="stable")]
    right = left if same else right[np.argsort(by[right], kind="stable")]
    columns, order, step = other[right].T.copy(), by[right], max(1, STRIP // max(1, len(right)))
    for start in range(0, len(left), step):
        strip = left[start : start + step]
        low = start if same else np.searchsorted(order, by[strip[0]] - radius)
        high = np.searchsorted(order, by[strip[-1]] + radius)
        if low >= high:
            continue
        near = one[strip] @ columns[:, low:high] >= reach
        i, j = np.divmod(np.flatnonzero(near), high - low)
        i, j = i + start, j + low
        if same:
            i, j = i[i < j], j[i < j]
        i, j = left[i], right[j]
        for begin in range(0, len(i), 1 << 18):
            x, y = i[begin : begin + (1 << 18)], j[begin : begin + (1 << 18)]
            for k, (c, d) in enumerate(blocks[: number + 1]):
                within = ((turned[x, c:d] - turned[y, c:d]) ** 2).sum(axis=1) <= share * (d - c) + 1e-9
                keep = within if k == number else ~within
                x, y = x[keep], y[keep]
            keep = (units[x] * units[y]).sum(axis=1) >= least
            yield x[keep], y[keep]


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(node, links, other) of one comparison: links to count, and edges that connect the linked."""
    table = pa.Table.from_batches(batches)
    size, number = table.column("size")[0].as_py(), table.column("block")[0].as_py()
    kinds = {4 * size: np.float32, 8 * size: np.float64}  # single precision where nothing is lost by it
    vectors = np.stack([np.frombuffer(x, kinds[len(x)]) for x in table.column("vector").to_pylist()]).astype(np.float64)
    nodes, copies, sides = (table.column(x).to_numpy() for x in ("node", "copies", "side"))
    same = table.column("tile_a")[0].as_py() == table.column("tile_b")[0].as_py()
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for x, y in linked(vectors, left, left if same else right, number, least):
        links += np.bincount(x, copies[y], len(nodes)).astype(np.int64) + np.bincount(y, copies[x], len(nodes)).astype(np.int64)
        label = label[forest(label[x], label[y], len(nodes))]
    some = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[label[some]])], ["node", "links", "other"])


def near_duplicates(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors` (vec_id, embedding).

    Two vectors of the same size are linked if their cosine, in double precision, is `least` or more
    (`least` over 0). n_links counts the other vectors linked to a row, component_id is the smallest
    vec_id reachable over links, itself included, kept says whether the row is the one of that id.
    Vectors that are null, empty, zero, or hold nulls or numbers that are not finite link with nothing.
    Equal vectors are compared as one and counted as many; a row without vec_id links others, but names
    no component and is not kept. Other columns are not looked at.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    one, two = F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("one", F.when(F.col("sound"), one)).withColumn("two", F.when(F.col("sound"), two))
    different = rows.filter("sound").groupBy("one", "two").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
    reps = cut(different.withColumn("node", F.monotonically_increasing_id()))  # numbered once, then read

    plain = reps.select("node", "copies", "vector")
    counted = map_batches(plain, partial(_homes, least=least), "size long, block long, slab long, n long")
    sizes = counted.groupBy("size", "block", "slab").agg(F.sum("n").alias("n")).collect()  # slabs, not vectors
    tiles = {(x["size"], x["block"], x["slab"]): -(-x["n"] // max(1, min(TILE, TILE_NUMBERS // x["size"]))) for x in sizes}
    kinds = "size long, block long, slab long, tile_a long, tile_b long, side long, node long, copies long, vector binary"
    visits = map_batches(plain, partial(_visits, least=least, tiles=tiles), kinds)
    groups = visits.groupBy("size", "block", "slab", "tile_a", "tile_b")
    found = cut(groups.applyInArrow(_compare_with(least), "node long, links long, other long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("src"), F.col("other").alias("dst")))
    known = reps.join(links, "node", "left").join(roots, "node", "left")
    known = known.select("one", "two", "copies", "lowest", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("root"))
    names = known.groupBy("root").agg(F.min("lowest").alias("component"))
    known = known.join(names, "root").select("one", "two", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component")
    out = rows.select("vec_id", "one", "two").join(known, ["one", "two"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _compare_with(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, least)

    return compare
