"""Mixing sources to target weights by weighted fair queueing, in built-in Spark functions only.

Documents are sent in packets. Every packet gets a virtual finish time: the words its source has sent
up to its end, divided by the source's target. Sources interleave in the order of these times, and the
mix is cut once, where all sources together have sent the total budget; no source is cut by itself.
Any prefix of the mix holds the sources in proportion, so equal ranges of virtual time are about equal
shares of it; they are the ranges of the global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import WORD, cut

WEIGHTS = (5.0, 2.0, 1.0)
#: A packet holds at most this part of its source's target (one word at least), which bounds how far
#: from its target a source may be where the mix is cut.
PACKETS = 256
#: Ranges of one unit of virtual time, and parts of such a range, as powers of two.
RANGES, PARTS = 10, 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """(source, source_size, target, rank) per source of `sizes` (source, size).

    The weights repeat over the sources in code-point order, null last. All words are shared by
    weight; a target stops at `most` times its source's size and what is over is shared again by
    weight, until none is above. The end state has a level L such that every target is the smaller
    of weight * L and the cap; it is found in one pass over the sources sorted by cap / weight.
    """
    sums = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    chosen = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sums.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", chosen)
    level = F.col("source_size") * most / F.col("weight")
    by_level = Window.orderBy(level, "rank")
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = ranked.select(
        "*",
        level.alias("own_level"),
        F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
        F.sum("source_size").over(whole).alias("total"),
    )
    # the level that would share the rest among this source and those after it: it falls from the
    # first source it fits on, and the level at that one is L
    shared = filled.withColumn("shared", (F.col("total") - F.col("capped")) / F.col("open"))
    reached = shared.withColumn("level", F.max(F.when(F.col("shared") <= F.col("own_level"), F.col("shared"))).over(whole))
    target = F.least(F.col("weight") * F.coalesce("level", "own_level"), F.col("source_size") * most)
    return reached.select("source", "source_size", target.alias("target"), "rank")


KEYS = ["doc_id", "source", "text_md5"]


def _same(a: str, b: str, columns: list[str]) -> Column:
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return same


def _identity(docs: DataFrame) -> list[Column]:
    text = docs["text"].cast("string")
    return [docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), F.md5(text).alias("text_md5")]


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_md5, copy, size, source_size, target, taken) per row of `docs` (doc_id, text, source).

    A source sends its documents in an order drawn by hash of doc_id, text and `seed`, `most` times
    over. All packets are sorted by virtual finish time, equal times by source, and cut at the budget:
    the sum of all targets, each rounded down. A source's taken words come as near to its target as
    its packets are long. The sums work on ranges (of the draw, of virtual time), so no source and
    no group is one task's work. Null texts have size 0 and are never taken; a null source is a
    source of its own; repeated rows are rows of their own, told apart by `copy`; other columns are
    not looked at.
    """
    sized = docs.select(*_identity(docs), word_count(docs["text"].cast("string")).alias("size"))
    counted = sized.groupBy(*KEYS).agg(F.max("size").alias("size"), F.count("*").alias("n"))
    rows = cut(counted.select(*KEYS, "size", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")))
    aims = cut(targets(rows, weights, float(most)))
    budget = aims.agg(F.sum(F.floor("target"))).first()[0] or 0

    # where a document starts in its source's order: the words of earlier slots of the draw, and of earlier ones in its own
    drawn = rows.withColumn("draw", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "text_md5", F.col("copy").cast("string"), F.lit(str(seed)))))
    drawn = drawn.withColumn("slot", F.substring("draw", 1, 3))
    slots = drawn.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    earlier = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.select("source", "slot", F.coalesce(F.sum("slot_size").over(earlier), F.lit(0)).alias("slot_start"))
    within = Window.partitionBy("source", "slot").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = drawn.withColumn("upto", F.sum("size").over(within)).alias("r").join(starts.alias("s"), _same("r", "s", ["source", "slot"]))
    placed = placed.select("r.*", (F.col("slot_start") + F.col("upto") - F.col("size")).alias("start")).drop("draw", "slot", "upto")
    known = placed.alias("r").join(aims.alias("a"), _same("r", "a", ["source"]))
    known = cut(known.select("r.*", "source_size", "target", "rank"))

    taken = _up_to_budget(_packets(known, most), budget).groupBy(*KEYS, "copy").agg(F.sum("taken").alias("taken"))
    out = known.alias("k").join(taken.alias("t"), _same("k", "t", [*KEYS, "copy"]), "left")
    return out.select("k.doc_id", "k.source", "k.text_md5", "k.copy", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _packets(known: DataFrame, most: int) -> DataFrame:
    """(KEYS, copy, rank, words, finish) per packet of every sending.

    Up to virtual time 2 only: by then every source has sent its target rounded down, or all it has,
    so the budget is used up before and nothing later can be taken.
    """
    packet = F.greatest(F.lit(1).cast("long"), F.floor(F.col("target") / PACKETS))
    passes = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    sent = known.filter("size > 0").select("*", passes.alias("pass"), packet.alias("packet"))
    sent = sent.withColumn("begin", F.col("start") + F.col("pass") * F.col("source_size")).filter("begin < 2 * target")
    last = F.least(F.col("size") - 1, F.floor(2 * F.col("target") - F.col("begin")))
    cut_up = sent.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last, "packet")).alias("at"))
    cut_up = cut_up.withColumn("words", F.least("packet", F.col("size") - F.col("at")))
    finish = (F.col("begin") + F.col("at") + F.col("words")) / F.col("target")
    return cut_up.select(*KEYS, "copy", "rank", "words", finish.alias("finish"))


def _up_to_budget(packets: DataFrame, budget: int) -> DataFrame:
    """The packets in order of virtual finish time, cut where their running sum reaches the budget.

    Sums by range tell the range in which that happens, and sums by its parts the part. What lies
    before is taken whole; only the packets of that part, a millionth of the mix or so, need their order.
    """
    packets = packets.withColumn("part", F.floor(F.col("finish") * (1 << RANGES + PARTS)))
    left, within = budget, packets
    for bits in (PARTS, 0):  # by ranges, then by the parts of one: some 2,000 rows at most
        sums = within.groupBy(F.shiftright("part", bits).alias("range")).agg(F.sum("words").alias("words"))
        upto = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
        edge = sums.withColumn("upto", upto).filter(F.col("upto") >= left).orderBy("range").first()
        if edge is None:  # no packet at all
            return packets.withColumn("taken", F.col("words"))
        left -= edge["upto"] - edge["words"]
        within = within.filter(F.shiftright("part", bits) == edge["range"])
    before = packets.filter(F.col("part") < edge["range"]).select(*KEYS, "copy", F.col("words").alias("taken"))
    order = Window.partitionBy("part").orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least(F.col("words"), F.lit(left) - F.coalesce(F.sum("words").over(order), F.lit(0)))
    return before.unionByName(within.select(*KEYS, "copy", taken.alias("taken")).filter("taken > 0"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, seed: int = 0) -> DataFrame:
    """`docs`, all its columns, every document as often as the mix sends it. A document is sent
    whole, also one of which the mix takes a part. Of rows equal in doc_id, source and text, the other
    columns of one stand for all. Documents without a word are not sent."""
    taken = mix(docs, weights, most, seed=seed)
    times = taken.filter("taken > 0").withColumn("times", F.ceil(F.col("taken") / F.col("size")))
    times = times.groupBy(*KEYS).agg(F.sum("times").alias("times"))
    keyed = [F.coalesce(x, F.lit(y)).alias(z) for x, y, z in (("doc_id", 0, "id"), ("source", "", "name"), ("text_md5", "", "hash"))]
    known = [F.isnull("doc_id").alias("no_id"), F.isnull("source").alias("no_name")]
    names = ["id", "name", "hash", "no_id", "no_name"]
    packed = docs.select(F.struct("*").alias("row"), *_identity(docs)).select("row", *keyed, *known).dropDuplicates(names)
    sent = packed.join(times.select(*keyed, *known, "times"), names)
    return sent.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")
