"""Helpers shared by the operators: scratch space, bounded batches, components of a graph."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; where none is named, one beside the
    warehouse, which all executors share as well."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"


def cut(df: DataFrame) -> DataFrame:
    """The same rows read from a reliable checkpoint: executors may be lost, lineage ends here."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint()


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that nothing is learned from. A missing id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def share(spark: SparkSession, value: object) -> Broadcast:
    """A value of this package's own classes, of bounded size, for all tasks; see `shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(value: Broadcast) -> object:
    return cloudpickle.loads(value.value)


#: What tells rows apart: doc_id (0 if missing), whether it is missing, and a hash of the text.
IDENTITY = ["id", "nameless", "text_hash"]


def identity(docs: DataFrame) -> list[Column]:
    """IDENTITY of the rows of `docs` (doc_id, text), as columns without nulls, fit for joins."""
    id_ = docs["doc_id"].cast("long")
    return [F.coalesce(id_, F.lit(0)).alias("id"), id_.isNull().alias("nameless"), F.xxhash64(docs["text"]).alias("text_hash")]


def doc_id() -> Column:
    """The doc_id that IDENTITY stands for."""
    return F.when(~F.col("nameless"), F.col("id")).alias("doc_id")


#: Rows of an Arrow batch at most: a text may be long, and a batch is held whole.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """`mapInArrow` in batches of at most BATCH_ROWS rows (a setting of the session); when a task is
    done, the memory its worker keeps goes back to the system."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df.sparkSession.conf.set(setting, min(int(df.sparkSession.conf.get(setting)), BATCH_ROWS))
    return df.mapInArrow(partial(_tidied, function=function), schema)


def _tidied(batches: Iterator[pa.RecordBatch], function: Callable) -> Iterator[pa.RecordBatch]:
    yield from function(batches)
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of at most `limit` bytes in `column` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)


def raw_bytes(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (src, dst): the smallest node it is connected to.

    Large-star and small-star rounds in turn: every node hangs its larger neighbours, then its
    smaller ones, under the smallest node in sight, until the edges no longer change. Each round
    is cut off, so the plan stays as small as one round. Nulls and loops link nothing.
    """
    linked = edges.filter("src != dst")
    now = cut(linked.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = None
    while True:
        both = now.union(now.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        now = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = now.groupBy("u").agg(F.min("v").alias("m"))
        hung = now.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(lowest.select("u", F.col("m").alias("v")).union(hung).distinct())
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sums == before:
            break
        before = sums
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
