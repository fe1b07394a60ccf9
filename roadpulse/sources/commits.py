"""Commit records of ingest: which batches of which stream a lake and its rejects hold.

A batch is staged under ``_staging``, out of sight, in the lake and in the rejects. Then its record is
put into ``_commits`` of the lake: from there on the batch counts, for both. Its files are moved to
their places under names that tell the stream and the batch, and the record is marked as done.
A batch that broke off before its record is staged anew; one that broke off after it is only
moved on. Readers leave out the files of batches that are not done, so they see a batch whole
or not at all, and lake and rejects at the same batch if they read the records once.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.folder import Folder

RECORDS, STAGING = "_commits", "_staging"
COMMITTED, DONE = "committed", "done"
#: Records of batches that are done are kept up to this number for each stream.
KEPT_RECORDS = 1000
#: Files that are moved at once, and letters of a stream's name in the names of its files.
MOVERS, PREFIX = 16, 8
_RECORD = re.compile(rf"^(\d+)\.({COMMITTED}|{DONE})$")


@dataclass(frozen=True)
class Batch:
    """A batch of a stream, with what was counted in it."""

    stream: str
    number: int
    messages: int
    accepted: int
    rejected: int


def _record(number: int, state: str) -> str:
    return f"{number:012d}.{state}"


def _states(folder: Folder, stream: str) -> dict[int, str]:
    """What is known of each batch of a stream; done counts for more than committed."""
    found: dict[int, str] = {}
    for name in folder.names(f"{RECORDS}/{stream}"):
        if match := _RECORD.match(name):
            number, state = int(match[1]), match[2]
            found[number] = DONE if DONE in (state, found.get(number)) else state
    return found


def state(spark: SparkSession, lake: str, stream: str, number: int) -> str | None:
    """Whether a batch is committed or done; batches before one that is are done, whatever is kept of them."""
    found = _states(Folder(spark, lake), stream)
    if any(x > number for x in found):
        return DONE
    return found.get(number)


def staged(root: str, stream: str, number: int) -> str:
    """Where a batch is staged in a lake or in the rejects."""
    return f"{root}/{STAGING}/{stream}/{number}"


def commit(spark: SparkSession, lake: str, batch: Batch) -> None:
    """From now on the batch counts: what was staged of it stays."""
    folder = Folder(spark, lake)
    folder.write(f"{RECORDS}/{batch.stream}/{_record(batch.number, COMMITTED)}", json.dumps(asdict(batch)))


def publish(spark: SparkSession, lake: str, stream: str, number: int, *roots: str) -> None:
    """Moves what is staged of a committed batch to its place; may be repeated after a break."""
    for root in roots:
        folder = Folder(spark, root)
        within = f"{STAGING}/{stream}/{number}"
        parts = [x for x in folder.files(within) if x.rsplit("/", 1)[-1].startswith("part-")]

        def move(part: str, folder=folder, within=within) -> None:
            below, _, name = part.rpartition("/")
            folder.rename(folder.at(f"{within}/{part}"), folder.at(f"{below}/{file_prefix(stream, number)}{name}"))

        with ThreadPoolExecutor(max_workers=MOVERS) as movers:
            list(movers.map(folder.make, {x.rpartition("/")[0] for x in parts}))
            list(movers.map(move, parts))
        folder.delete(within)
    records = Folder(spark, lake)
    here = f"{RECORDS}/{stream}"
    records.move(records.at(f"{here}/{_record(number, COMMITTED)}"), records.at(f"{here}/{_record(number, DONE)}"))
    for old in sorted(_states(records, stream))[:-KEPT_RECORDS]:
        records.delete(f"{here}/{_record(old, DONE)}")


def file_prefix(stream: str, number: int) -> str:
    return f"{stream[:PREFIX]}-{number:012d}-"


def done(spark: SparkSession, lake: str) -> dict[str, int]:
    """The last batch that is done of each stream into a lake; -1 where there is none yet."""
    folder = Folder(spark, lake)
    streams = folder.names(RECORDS)
    return {x: max((n for n, s in _states(folder, x).items() if s == DONE), default=-1) for x in streams}


def is_done(last: dict[str, int]) -> Column:
    """Whether a row's file belongs to no batch that came after these, by the file's name alone."""
    name, later = F.col("_metadata.file_name"), F.lit(False)
    for stream, number in last.items():
        own = name.startswith(f"{stream[:PREFIX]}-")
        later = later | (own & (name >= file_prefix(stream, number + 1)))
    return ~later


def only_done(files: DataFrame, lake: str, last: dict[str, int] | None = None) -> DataFrame:
    """The rows of files read from a lake, or its rejects, without batches that are not done."""
    last = done(files.sparkSession, lake) if last is None else last
    return files.filter(is_done(last)) if last else files


def read_commits(spark: SparkSession, lake: str) -> DataFrame:
    """The counts of the last batches: stream, number, messages, accepted, rejected."""
    kinds = "stream STRING, number BIGINT, messages BIGINT, accepted BIGINT, rejected BIGINT"
    folder = Folder(spark, lake)
    records = [
        folder.read(f"{RECORDS}/{stream}/{_record(number, DONE)}")
        for stream in folder.names(RECORDS)
        for number, found in sorted(_states(folder, stream).items())
        if found == DONE
    ]
    rows = [tuple(json.loads(x).values()) for x in records]
    return spark.createDataFrame(rows, kinds)
