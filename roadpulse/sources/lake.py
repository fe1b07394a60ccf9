"""The event lake: ``date=.../zone=...`` directories of JSON lines or Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.codec import JSON_SPACE, is_one_object, whole
from roadpulse.operators.ingest import typed
from roadpulse.schema import EVENT, EVENT_COLUMNS, EXTRA, LAKE_PARTITIONS, WHOLE, WIRE_EVENT
from roadpulse.sources.commits import only_done

FORMATS = {"json": WIRE_EVENT, "parquet": EVENT}


class LakeMissing(RuntimeError):
    """The lake directory does not exist yet."""


class LakeOfAnotherWriter(RuntimeError):
    """Writing here would hide files: those that are there, or those to be written."""


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def followed_by_a_stream(spark: SparkSession, root: str) -> bool:
    """Whether a stream writes this lake. Reads then see the files in its log only."""
    return exists(spark, f"{root}/_spark_metadata")


def require_no_stream_log(spark: SparkSession, root: str) -> None:
    if followed_by_a_stream(spark, root):
        raise LakeOfAnotherWriter(f"{root} is read through a stream's log, which would hide the events")


def require_stream_lake(spark: SparkSession, root: str, fmt: str) -> None:
    if followed_by_a_stream(spark, root) or not exists(spark, root):
        return
    if not read_lake(spark, root, fmt).isEmpty():
        raise LakeOfAnotherWriter(
            f"{root} holds files of another writer, which the stream's log would hide; use a new root"
        )


def lake_schema(fmt: str) -> T.StructType:
    """Event columns with the partition columns last, as a directory read returns them.

    Partition columns are part of the schema, so a zone called ``01`` stays text.
    """
    if fmt not in FORMATS:
        raise ValueError(f"lake format {fmt!r}: use one of {sorted(FORMATS)}")
    partitions = LAKE_PARTITIONS.fieldNames()
    body = [field for field in FORMATS[fmt] if field.name not in partitions]
    return T.StructType(body + list(LAKE_PARTITIONS))


def whole_readings(files: DataFrame) -> DataFrame:
    """Counts and speeds as whole numbers, halves rounded up, as ingest does; a number that no
    BIGINT holds is an unknown reading and stops no job."""
    kinds = dict(files.dtypes)
    rounded = {x: whole(F.col(x)) for x in WHOLE if kinds[x] == "double"}
    return files.withColumns(rounded) if rounded else files


def _typed_view(files: DataFrame) -> DataFrame:
    return typed(whole_readings(files)).select(*EVENT_COLUMNS, "date")


def read_extra(spark: SparkSession, root: str, fmt: str = "json") -> DataFrame:
    """The messages that hold more than their event's columns, with ``date`` and ``zone``."""
    partitions = LAKE_PARTITIONS.fieldNames()
    schema = T.StructType([T.StructField(EXTRA, T.StringType()), *LAKE_PARTITIONS])
    found = only_done(spark.read.schema(schema).format(fmt).load(root), root)
    return found.filter(F.col(EXTRA).isNotNull()).select(EXTRA, *partitions)


def read_lake(
    spark: SparkSession,
    root: str,
    fmt: str = "json",
    mode: str = "FAILFAST",
    last: dict[str, int] | None = None,
) -> DataFrame:
    """All events, typed, with the partition ``date``; of ingested batches those that are done, or
    up to the ``last`` ones given (see ``sources.commits.done``), for instance the same as the rejects.

    The directory is read rather than a pattern of files, so filters on ``date``
    and ``zone`` skip whole directories; the schema is given, so no pass over the
    data infers it. A JSON line that does not fit stops the job: the permissive
    mode would turn it into NULLs that falsify the means unnoticed.
    """
    reader = spark.read.schema(lake_schema(fmt))
    if fmt == "json":
        reader = reader.option("mode", mode)
    try:
        return _typed_view(only_done(reader.format(fmt).load(root), root, last))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise LakeMissing(f"no event lake at {root}: nothing was ingested yet") from error
        raise


def read_rejects(
    spark: SparkSession, path: str, lake: str, last: dict[str, int] | None = None
) -> DataFrame:
    """What ingest kept out of a lake: ``value`` and ``reason``, of the same batches as the lake's."""
    reader = spark.read.schema("value STRING, reason STRING")
    return only_done(reader.parquet(path), lake, last).select("value", "reason")


def stream_lake(
    spark: SparkSession,
    root: str,
    fmt: str = "json",
    mode: str = "FAILFAST",
    files_per_batch: int | None = None,
) -> DataFrame:
    """The lake as a stream: each file once, as it is committed."""
    reader = spark.readStream.schema(lake_schema(fmt))
    if fmt == "json":
        reader = reader.option("mode", mode)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _typed_view(reader.format(fmt).load(root))


def read_files(spark: SparkSession, pattern: str, mode: str = "FAILFAST") -> DataFrame:
    """Events of all JSON-lines files that match a pattern, whatever their directories say.

    For files whose body holds every field and whose directories are no proper partitions.
    Nothing can be skipped; prefer ``read_lake``.
    """
    files = spark.read.schema(WIRE_EVENT).option("mode", mode)
    return typed(whole_readings(files.json(pattern)))


def read_documents(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Events from pretty-printed JSON documents, each an array of events.

    A document is one unit of work for a task; for large ones see ``read_document_ranges``.
    """
    documents = spark.read.schema(WIRE_EVENT).option("multiLine", True).option("mode", mode)
    return typed(whole_readings(documents.json(path)))


def _document_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Documents cut behind each closing brace, by as many tasks as their sizes give: ``file``, ``place``
    in it, ``kind`` (start, more, end, empty; NULL for a piece that is none of them) and ``object``."""
    text = spark.read.option("lineSep", "}").text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        F.btrim("value", F.lit(JSON_SPACE)).alias("piece"),
    )
    body = F.ltrim(F.substring("piece", 2, 2147483647), F.lit(JSON_SPACE))
    pieces = pieces.withColumn("object", F.concat(body, F.lit("}")))
    whole_object = body.startswith("{") & is_one_object(F.col("object"))
    kind = (
        F.when(F.col("piece") == "]", "end")
        .when(F.col("piece").startswith("[") & (body == "]"), "empty")
        .when(F.col("piece").startswith("[") & whole_object, "start")
        .when(F.col("piece").startswith(",") & whole_object, "more")
    )
    return pieces.withColumn("kind", kind)


def documents_read_whole(spark: SparkSession, path: str) -> list[str]:
    """The files that cannot be read in ranges: anything but one array of flat objects, none of whose
    texts holds a closing brace.

    An object that ends at the first closing brace behind its start is whole, and the next piece
    starts where it ends. So if the first piece of a file opens the array, the last one closes it,
    and all between are whole objects, then every piece is exactly one event.
    """
    files = _document_pieces(spark, path).groupBy("file").agg(
        F.min_by("kind", "place").alias("first"),
        F.max_by("kind", "place").alias("last"),
        F.count("*").alias("pieces"),
        F.count_if(F.col("kind") == "more").alias("more"),
    )
    array = (F.col("first") == "start") & (F.col("last") == "end") & (F.col("more") == F.col("pieces") - 2)
    empty = (F.col("first") == "empty") & (F.col("pieces") == 1)
    others = files.filter(~F.coalesce(array | empty, F.lit(False))).select("file")
    return [row.file for row in others.collect()]


def read_document_ranges(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """The events of ``read_documents``, a large document read by many tasks.

    A first pass proves which documents may be cut behind each closing brace; events with
    nested fields, braces in texts, single objects and broken documents are read whole, as
    ``read_documents`` does. ``mode`` is FAILFAST or PERMISSIVE.
    """
    others = documents_read_whole(spark, path)
    pieces = _document_pieces(spark, path).filter("kind IN ('start', 'more')")
    if others:
        pieces = pieces.filter(~F.col("file").isin(others))
    parsed = pieces.select(F.inline(F.array(F.from_json("object", WIRE_EVENT, {"mode": mode}))))
    ranges = typed(whole_readings(parsed))
    if not others:
        return ranges
    documents = spark.read.schema(WIRE_EVENT).option("multiLine", True).option("mode", mode).json(path)
    return ranges.unionByName(typed(whole_readings(documents.filter(F.col("_metadata.file_path").isin(others)))))
