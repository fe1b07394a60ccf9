"""Hard negatives by a cover tree over norm-augmented candidates.

One more coordinate, sqrt(M^2 - |x|^2) for the greatest norm M, brings all candidates to the same norm, so that
the inner product with an anchor falls as the distance grows, and a ball around a candidate bounds the inner
products in it from both sides. The top of the tree is fitted on a bounded sample: PIVOTS candidates at most,
chosen by a hash, and the covering radii of the cells around them over all rows. Below, each cell has trees of
at most TILE rows, whose levels halve the covering radius. Anchors visit the cells that can hold anything for
them; in a tree they descend best-first, leave out the nodes outside of their windows of scores, and score the
leaves in whole numbers. What the trees find is put together per anchor in Spark.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import cut, map_batches, share, shared

#: Candidates of the sample that the top of the tree is fitted on, and groups of labels.
PIVOTS, BUCKETS = 256, 16
#: Candidates in a tree (fewer where vectors are long: NUMBERS in all), and anchors that search it together.
TILE, NUMBERS, ANCHORS = 8192, 1 << 21, 4096
#: Candidates of a node that is not divided, children of a node, and anchors that descend at a time.
LEAF, CHILDREN, ABREAST = 256, 64, 512
#: Squared length of a row's whole numbers from which on scores might not be whole in double precision.
LONGEST = 2.0**52
#: Share of the scale of the distances by which bounds are widened against rounding.
SLACK = 1e-9


class Tree(NamedTuple):
    """Nodes level by level, children of a node side by side: centre (a row), covering radius, first child,
    number of children, and the rows below, a stretch of the rows' order."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    norm: float
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray
    start: np.ndarray
    end: np.ndarray


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    """The vectors with the coordinate that brings them to the squared length `norm`."""
    vectors = vectors.astype(np.float64)
    return np.hstack([vectors, np.sqrt(np.maximum(0.0, norm - (vectors * vectors).sum(axis=1, keepdims=True)))])


def covering(points: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres more than `radius` apart, `centre` first, each with the members it is nearest to.

    The next centre is the member farthest from those chosen, until all are covered within `radius`. Where that
    would take more than CHILDREN, or leave them less than half a leaf each, as for vectors without structure,
    the radii stay greater; they are measured, never presumed.
    """
    most = min(CHILDREN, -(-2 * len(members) // LEAF))
    centres, owner = [centre], np.zeros(len(members), np.int64)
    apart = ((points[members] - points[centre]) ** 2).sum(axis=1)
    while len(centres) < most and (far := int(np.argmax(apart)), apart[far] > radius * radius)[1]:
        other = ((points[members] - points[members[far]]) ** 2).sum(axis=1)
        owner[other < apart] = len(centres)
        apart = np.minimum(apart, other)
        centres.append(int(members[far]))
    return [(x, members[owner == i]) for i, x in enumerate(centres)]


def build(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, norm: float) -> Tree:
    """The cover tree of some candidates: every level covers its nodes' rows within half the radius."""
    points, order = augmented(vectors, norm), np.argsort(ids, kind="stable")
    rows, queue, nodes = [], [(int(order[0]), order)], []
    while queue:
        following = []
        for centre, members in queue:
            radius = float(np.sqrt(((points[members] - points[centre]) ** 2).sum(axis=1)).max())
            parts: list[tuple[int, np.ndarray]] = []
            if len(members) > LEAF:
                parts = covering(points, members, centre, radius / 2)
                if len(parts) == 1:  # copies of one vector
                    parts = [(centre, members[i : i + LEAF]) for i in range(0, len(members), LEAF)]
            nodes.append((centre, radius, len(parts), 0 if parts else len(members)))
            if not parts:
                rows.append(members)
            following += parts
        queue = following
    count = np.array([x[2] for x in nodes])
    first = 1 + np.cumsum(count) - count
    held = np.array([x[3] for x in nodes])
    end = np.cumsum(held)
    place = np.concatenate(rows)
    at = np.empty(len(place), np.int64)
    at[place] = np.arange(len(place))
    centre, radius = at[[x[0] for x in nodes]], np.array([x[1] for x in nodes])
    return Tree(vectors[place], ids[place], labels[place], norm, centre, radius, first, count, end - held, end)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which stretch, and which place, for all places of the stretches one after the other."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def bounds(inner: np.ndarray, squared: np.ndarray, norm: float, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product with anything within `radius` of a centre, given the centre's, the
    anchor's squared length and that of all augmented candidates."""
    scale = squared + norm
    apart, slack = np.sqrt(np.maximum(0.0, scale - 2 * inner)), SLACK * scale + 1e-6
    return (scale - (apart + radius) ** 2) / 2 - slack, (scale - np.maximum(0.0, apart - radius) ** 2) / 2 + slack


class Windows(NamedTuple):
    """Per anchor the scores wanted, from lowest to highest, window by window; none where low > high."""

    low: np.ndarray
    high: np.ndarray


def search(tree: Tree, vectors: np.ndarray, allowed: Callable, windows: Windows, k: int) -> list[np.ndarray]:
    """[anchor, window, score, row]: each window's first k rows of the tree by score, then id, among the
    rows `allowed` (arrays of anchors and rows)."""
    found = [_descend(tree, vectors, allowed, windows, k, i) for i in range(0, len(vectors), ABREAST)]
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4


def _descend(tree: Tree, every: np.ndarray, allowed: Callable, windows: Windows, k: int, offset: int) -> list[np.ndarray]:
    vectors = every[offset : offset + ABREAST].astype(np.float64)
    low, high = (x[offset : offset + ABREAST].astype(np.float64) for x in windows)
    need, width = np.where(low <= high, low, np.inf), low.shape[1]  # scores that still count
    squared = (vectors * vectors).sum(axis=1)
    greatest = np.full((len(vectors), len(tree.centre)), -np.inf)
    greatest[:, 0] = np.inf
    slot, score, row = (np.zeros(0, np.int64) for _ in range(3))
    while True:
        node = greatest.argmax(axis=1)
        best = greatest[np.arange(len(vectors)), node]
        done = best < need.min(axis=1)
        greatest[done] = -np.inf
        going = np.flatnonzero(~done & (best > -np.inf))
        if not len(going):
            return [slot // width + offset, slot % width, score, row]
        node = node[going]
        greatest[going, node] = -np.inf

        leaf = tree.children[node] == 0
        if leaf.any():
            who, rows, scores = _scored(tree, vectors, going[leaf], node[leaf], need.min(axis=1), high.max(axis=1))
            wanted = (scores[:, None] >= need[who]) & (scores[:, None] <= high[who]) & allowed(who + offset, rows)[:, None]
            pair, window = np.nonzero(wanted)
            slot = np.append(slot, who[pair] * width + window)
            score, row = np.append(score, scores[pair]), np.append(row, rows[pair])
            order = np.lexsort((tree.ids[row], -score, slot))
            slot, score, row = slot[order], score[order], row[order]
            rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
            last = rank == k - 1
            need.ravel()[slot[last]] = score[last]
            slot, score, row = slot[rank < k], score[rank < k], row[rank < k]

        owner, child = _spread(tree.child[node[~leaf]], tree.children[node[~leaf]])
        if len(child):
            who = going[~leaf][owner]
            inner = np.einsum("ij,ij->i", vectors[who], tree.vectors[tree.centre[child]])
            least, most = bounds(inner, squared[who], tree.norm, tree.radius[child])
            inside = ((most[:, None] >= need[who]) & (least[:, None] <= high[who])).any(axis=1)
            greatest[who[inside], child[inside]] = most[inside]


def _scored(tree: Tree, vectors: np.ndarray, going: np.ndarray, leaf: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """[anchor, row, score] of the rows of each anchor's leaf with a score between its low and high; anchors
    that are at the same leaf are scored together."""
    found = [(np.zeros(0, np.int64),) * 3]
    order = np.argsort(leaf, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(leaf[order]) != 0))
    for one, who in zip(leaf[order[starts]], np.split(going[order], starts[1:])):
        start = tree.start[one]
        scores = vectors[who] @ tree.vectors[start : tree.end[one]].T
        i, j = np.nonzero((scores >= low[who, None]) & (scores <= high[who, None]))
        found.append((who[i], start + j, scores[i, j].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*found)]


class Cells(NamedTuple):
    """The top of the tree for one size of vectors: pivots, and the cells around them."""

    norm: float
    pivots: np.ndarray
    bucket: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    tiles: np.ndarray


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(values) else np.zeros((len(column), 0), np.int64)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def _nearest(batches: Iterator[pa.RecordBatch], tops) -> Iterator[pa.RecordBatch]:
    """Every row with its pivot and the distance to it."""
    known = shared(tops)
    for whole in batches:
        for size, batch in _by_size(whole):
            norm, pivots = known[size]
            points, to = augmented(_matrix(batch.column("vector")), norm), augmented(pivots, norm)
            pivot = (points @ to.T).argmax(axis=1)
            apart = np.sqrt(((points - to[pivot]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot), pa.array(apart)], [*batch.schema.names, "pivot", "apart"]
            )


def _trees(batches: Iterator[pa.RecordBatch], norms: dict[int, float]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches).combine_chunks()
    keys = [table.column(x)[0].as_py() for x in SHARD]
    vectors = _matrix(table.column("vector").chunk(0)).astype(np.int32)
    tree = build(vectors, table.column("vec_id").to_numpy(), table.column("label").to_numpy(), norms[keys[0]])
    data = pickle.dumps(tuple(tree), protocol=5)
    yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in keys), pa.array([data], pa.binary())], [*SHARD, "tree"])


SHARD = ["size", "bucket", "pivot", "tile"]
_SHARD = ", ".join(f"{x} long" for x in SHARD)
_ANCHOR = "anchor long, vec_id long, label long, vector array<int>, low array<double>, high array<double>"
_ANCHOR_NAMES = ["anchor", "vec_id", "label", "vector", "low", "high"]


def _visits(batches: Iterator[pa.RecordBatch], cells, same: bool, blocks: int) -> Iterator[pa.RecordBatch]:
    """A row for each tree an anchor has to search: of its own bucket if `same`, of all otherwise."""
    known = shared(cells)
    names = [*SHARD, "block", *_ANCHOR_NAMES]
    for whole in batches:
        for size, batch in _by_size(whole):
            top = known[size]
            vectors = _matrix(batch.column("vector")).astype(np.float64)
            low, high = (_matrix(batch.column(x)).astype(np.float64) for x in ("low", "high"))
            squared = (vectors * vectors).sum(axis=1)
            buckets = batch.column("bucket").to_numpy()
            block = batch.column("anchor").to_numpy() % blocks
            for i in range(len(batch)):
                inner = top.pivots[top.pivot] @ vectors[i]
                least, most = bounds(inner, squared[i], top.norm, top.radius)
                meets = ((most[:, None] >= low[i]) & (least[:, None] <= high[i]) & (low[i] <= high[i])).any(axis=1)
                if same:
                    meets &= top.bucket == buckets[i]
                cell, tile = _spread(np.zeros(meets.sum(), np.int64), top.tiles[meets])
                count = len(cell)
                if count:
                    at = np.flatnonzero(meets)[cell]
                    one = batch.slice(i, 1).select(_ANCHOR_NAMES).take(pa.array(np.zeros(count, np.int64)))
                    shard = [np.full(count, size), top.bucket[at], top.pivot[at], tile, np.full(count, block[i])]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, shard), *one.columns], names)


def _searched(_, trees: pa.Table, anchors: pa.Table, same: bool, k: int) -> pa.Table:
    """What one block of anchors finds in one tree."""
    names = ["anchor", "window", "score", "vec_id", "label"]
    if not len(trees) or not len(anchors):
        return pa.table([pa.array([], pa.int64())] * 5, names=names)
    tree = Tree(*pickle.loads(trees.column("tree")[0].as_py()))
    tree = tree._replace(vectors=tree.vectors.astype(np.float64))  # products of rows stay whole, see LONGEST
    anchors = anchors.combine_chunks()
    vectors, low, high = (_matrix(anchors.column(x).chunk(0)) for x in ("vector", "low", "high"))
    ids, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()

    def allowed(who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if same:
            return (labels[who] == tree.labels[rows]) & (ids[who] != tree.ids[rows])
        return labels[who] != tree.labels[rows]

    who, window, score, row = search(tree, vectors, allowed, Windows(low, high), k)
    columns = [anchors.column("anchor").to_numpy()[who], window, score, tree.ids[row], tree.labels[row]]
    return pa.table([pa.array(x.astype(np.int64)) for x in columns], names=names)


def _search_all(trees: DataFrame, anchors: DataFrame, cells, same: bool, k: int, blocks: int) -> DataFrame:
    """(anchor, window, score, vec_id, label): the first k of each window over all trees, with `rank`."""
    visits = map_batches(anchors, partial(_visits, cells=cells, same=same, blocks=blocks), f"{_SHARD}, block long, {_ANCHOR}")
    keys = [*SHARD, "block"]
    wanted = visits.select(*(F.col(x).alias(x) for x in keys)).distinct()
    held = trees.join(wanted, SHARD).select(*(F.col(x).alias(x) for x in keys), "tree")
    kinds = "anchor long, window long, score long, vec_id long, label long"

    def searched(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _searched(key, left, right, same, k)

    found = held.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(searched, kinds)
    first = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "vec_id", "label")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def prepared(vectors: DataFrame, moved: Callable[[Column, Column], Column]) -> DataFrame:
    """(vec_id, label, vector, size): the rows that take part, whole numbers instead of components."""
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = vectors.select(id_.alias("vec_id"), moved(id_, label).alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & sound)
    length = F.aggregate("x", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * 256.0).cast("double"), 2))
    rows = rows.filter(F.forall("x", lambda x: F.abs(x) < 2.0**22)).filter(length < LONGEST)
    whole = F.transform("x", lambda x: F.floor(x * 256.0).cast("int"))
    return rows.select("vec_id", "label", whole.alias("vector"), F.size("x").cast("long").alias("size")).distinct()


def seventh_moved(id_: Column, label: Column) -> Column:
    """The label of a row as it is mined: of every seventh vec_id the next of ten."""
    return F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)


def mine(
    vectors: DataFrame,
    anchors: Callable[[Column], Column] = lambda id_: id_ % 100 == 0,
    moved: Callable[[Column, Column], Column] = seventh_moved,
    positives: int = 5,
    negatives: int = 10,
    share_of: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of `vectors`
    (vec_id, embedding, label) that `anchors` chooses, against all rows.

    A row's components count as floor(256 * x), scores are inner products in whole numbers; higher scores come
    first, ties by smaller vec_id. An anchor's positives are its first `positives` rows of the same label and
    another vec_id. Per positive come the first `negatives` rows of other labels whose score is between the
    shares `share_of`, in percent, of the positive's score. `moved` gives a row's label from vec_id and label.

    Rows with a null vec_id, label, vector or component, or one that is not finite, take no part, nor do rows
    with a component of 2^22 or more or a squared length of 2^52 or more in whole numbers, whose scores might
    not be exact. Vectors are compared with those of the same size. Exact repeats of a row (vec_id, label, whole
    numbers) count once; rows that share a vec_id otherwise are rows of their own. Anchors without positives, or
    positives without negatives, give no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = cut(prepared(vectors, moved).withColumn("bucket", F.pmod(F.hash("label"), F.lit(BUCKETS)).cast("long")))
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + F.pow(x.cast("double"), 2))
    found = rows.groupBy("size").agg(F.max(squared).alias("norm"), F.count("*").alias("n")).collect()  # one a size
    norms = {x["size"]: x["norm"] + 1.0 for x in found}
    pivots = _pivots(rows, {x["size"]: x["n"] for x in found})

    kinds = "vec_id long, label long, vector array<int>, size long, bucket long, pivot long, apart double"
    tops = share(spark, {x: (norms[x], pivots[x]) for x in pivots})
    placed = map_batches(rows, partial(_nearest, tops=tops), kinds)
    cell = ["size", "bucket", "pivot"]
    spans = placed.groupBy(*cell).agg(F.max("apart").alias("radius"), F.count("*").alias("n")).collect()  # cells, not rows
    spans = [(x["size"], x["bucket"], x["pivot"], x["radius"] * (1 + SLACK) + 1e-6, -(-x["n"] // _tile(x["size"]))) for x in spans]
    tiles = spark.createDataFrame([(*x[:3], x[4]) for x in spans], "size long, bucket long, pivot long, tiles long")
    tile = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.col("tiles")).alias("tile")
    tiled = placed.join(F.broadcast(tiles), cell).select("vec_id", "label", "vector", *cell, tile)
    trees = cut(tiled.groupBy(*SHARD).applyInArrow(_trees_of(norms), f"{_SHARD}, tree binary"))

    known = {}
    for size in pivots:
        here = [x for x in spans if x[0] == size]
        columns = [np.array([x[i] for x in here]) for i in (1, 2, 3, 4)]
        known[size] = Cells(norms[size], pivots[size], *columns)
    cells = share(spark, known)

    chosen = cut(rows.filter(anchors(F.col("vec_id"))).withColumn("anchor", F.monotonically_increasing_id()))
    blocks = max(1, -(-chosen.count() // ANCHORS))
    ends = F.array(F.lit(float("-inf"))).alias("low"), F.array(F.lit(float("inf"))).alias("high")
    near = cut(_search_all(trees, chosen.select("*", *ends), cells, True, positives, blocks))
    # The least and greatest whole numbers within the shares; a negative score leaves none.
    least, most = -_hundredth(F.col("score") * -share_of[0]), _hundredth(F.col("score") * share_of[1])
    asked = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", least.alias("low"), most.alias("high")))).alias("w"))
    ends = _of_positives("low", "inf", positives), _of_positives("high", "-inf", positives)
    seekers = chosen.join(asked, "anchor").select("anchor", "vec_id", "label", "vector", "size", "bucket", *ends)
    far = _search_all(trees, seekers, cells, False, negatives, blocks)

    one = near.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    two = far.select("anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.select("anchor", F.col("vec_id").alias("anchor_id"))
    out = two.join(one, ["anchor", "window"]).join(named, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _pivots(rows: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """A pivot for as many rows of a size as its groups of labels have in a tree each, PIVOTS at most: the
    first by hash of a sample eight times as large."""
    wanted = {size: max(1, min(PIVOTS, n // (_tile(size) * BUCKETS))) for size, n in counts.items()}
    every = [(size, max(1, counts[size] // (8 * wanted[size]))) for size in wanted]
    drawn = F.xxhash64("vec_id", "label", "vector").alias("drawn")
    sampled = rows.join(F.broadcast(rows.sparkSession.createDataFrame(every, "size long, one_in long")), "size")
    sample: dict[int, list] = {size: [] for size in wanted}
    for x in sampled.select("size", "vector", "one_in", drawn).filter(F.pmod("drawn", "one_in") == 0).collect():
        sample[x["size"]].append((x["drawn"], x["vector"]))
    found = {}
    for size, near in sample.items():
        first = [x for _, x in sorted(near)[: wanted[size]]] or [[0] * size]
        found[size] = np.array(first, np.float64).reshape(len(first), size)
    return found


def _tile(size: int) -> int:
    return max(1, min(TILE, NUMBERS // max(1, size)))


def _hundredth(number: Column) -> Column:
    """A hundredth of a long, rounded down, in double precision."""
    return ((number - F.pmod(number, F.lit(100))) / 100).cast("double")


def _of_positives(end: str, without: str, positives: int) -> Column:
    """One end of the window of each positive in order of rank; where there is none, one that shuts it."""
    return F.array(*(F.coalesce(F.get("w", F.lit(i))[end], F.lit(float(without))) for i in range(positives))).alias(end)


def _trees_of(norms: dict[int, float]):
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _trees(batches, norms)

    return trees
