"""Versions of a store: which files of each table belong together.

Tables are written under the label of the version they are made for, ``<table>/version=<label>``, and
nothing that is there is changed. The version itself is one small record, put in its place last: until
then readers see the version before, from then on the new one, all tables at once. Tables that grow are
kept by date: a version names, for each date, the labels whose rows it consists of, so a refresh of some
dates, a batch or a compaction writes these only. What no kept version names is removed.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.sources.folder import Folder

RECORDS = "_versions"
#: Versions that stay readable beside the newest one.
KEPT = 4
#: Folder name of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: Folders whose size is asked for at once.
LISTERS = 16

Parts = dict[str, list[tuple[str, int]]]


class StoreMissing(RuntimeError):
    """Nothing was stored yet."""


class VersionTaken(RuntimeError):
    """Another writer was faster; nothing it wrote was touched."""


@dataclass(frozen=True)
class Version:
    """``tables``: the label of each small table. ``dated``: for each growing table and date the
    labels it consists of, with their bytes. ``stream`` and ``batch``: what a followed store holds."""

    number: int = 0
    label: str = ""
    tables: dict[str, str] = field(default_factory=dict)
    dated: dict[str, Parts] = field(default_factory=dict)
    stream: str | None = None
    batch: int = -1
    batch_label: str = ""


def find(spark: SparkSession, store: str, number: int | None = None) -> Version | None:
    """A version of the store, the newest one unless a number is given."""
    folder = Folder(spark, store)
    numbers = [int(x) for x in folder.names(RECORDS) if x.isdigit()]
    number = max(numbers, default=None) if number is None else number
    if number not in numbers:
        return None
    known = json.loads(folder.read(f"{RECORDS}/{number:012d}"))
    dated = {table: {day: [tuple(x) for x in parts] for day, parts in days.items()} for table, days in known["dated"].items()}
    return Version(**{**known, "dated": dated})


def pinned(spark: SparkSession, store: str, version: Version | int | None = None) -> Version:
    """The version to read: the one given, or the newest at this moment."""
    if isinstance(version, Version):
        return version
    found = find(spark, store, version)
    if found is None:
        raise StoreMissing(f"no version {'' if version is None else f'{version} '}of a store at {store}")
    return found


def day_name() -> Column:
    """The date of a row as its folder's name says it."""
    return F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE))


def read_small(spark: SparkSession, store: str, version: Version, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{store}/{name}/version={version.tables[name]}")


def read_dated(spark: SparkSession, store: str, parts: Parts, name: str, schema: T.StructType) -> DataFrame:
    """The rows of a growing table, with ``date`` last; of a date only the labels that belong to it."""
    labels = sorted({label for found in parts.values() for label, _ in found})
    fields = [x for x in schema if x.name != "date"]
    columns = [*(x.name for x in fields), "date"]
    known = T.StructType([*fields, T.StructField("version", T.StringType()), T.StructField("date", T.DateType())])
    if not labels:
        return spark.createDataFrame([], known).select(*columns)
    path = f"{store}/{name}"
    table = spark.read.schema(known).option("basePath", path).parquet(*(f"{path}/version={x}" for x in labels))
    live = [f"{label}/{day}" for day, found in parts.items() for label, _ in found]
    return table.filter(F.concat_ws("/", "version", day_name()).isin(live)).select(*columns)


class Draft:
    """A version in the making: the tables of ``base`` and what is written here."""

    def __init__(self, spark: SparkSession, store: str, base: Version | None, keep_tables: bool = True):
        self.spark, self.store = spark, store
        base = base or Version()
        number = base.number + 1
        self.label = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        kept = base if keep_tables else Version()
        copied = {name: dict(parts) for name, parts in kept.dated.items()}
        self.version = replace(kept, number=number, label=self.label, tables=dict(kept.tables), dated=copied)

    def write_small(self, table: DataFrame, name: str) -> None:
        """Replaces a small table; a handful of rows makes one file."""
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.store}/{name}/version={self.label}")
        self.version.tables[name] = self.label

    def write_dated(self, table: DataFrame, name: str) -> Parts:
        """Writes rows of a growing table by date; they belong to the version once they are added."""
        within = f"{name}/version={self.label}"
        table.write.mode("overwrite").partitionBy("date").parquet(f"{self.store}/{within}")
        folder = Folder(self.spark, self.store)
        days = [x.removeprefix("date=") for x in folder.names(within) if x.startswith("date=")]
        with ThreadPoolExecutor(max_workers=LISTERS) as listers:
            sizes = list(listers.map(lambda day: folder.size(f"{within}/date={day}"), days))
        return {day: [(self.label, size)] for day, size in zip(days, sizes)}

    def replace_dates(self, name: str, parts: Parts, days: set[str] | None) -> None:
        """The parts take the place of these days, or of all; days without parts are gone."""
        kept = {} if days is None else {x: y for x, y in self.version.dated.get(name, {}).items() if x not in days}
        self.version.dated[name] = {**kept, **parts}

    def add(self, name: str, parts: Parts) -> None:
        held = self.version.dated.setdefault(name, {})
        for day, more in parts.items():
            held[day] = [*held.get(day, []), *more]

    def commit(self, **changes) -> Version:
        """The version in its place, if no other took it; then what no kept version names is removed."""
        self.version = replace(self.version, **changes)
        record = {x: getattr(self.version, x) for x in Version.__dataclass_fields__}
        folder = Folder(self.spark, self.store)
        try:
            folder.write(f"{RECORDS}/{self.version.number:012d}", json.dumps(record))
        except FileExistsError as error:
            raise VersionTaken(f"version {self.version.number} of {self.store} is another writer's") from error
        remove_unnamed(self.spark, self.store)
        return self.version


def _days(version: Version) -> set[tuple[str, str, str]]:
    return {(name, label, day) for name, days in version.dated.items() for day, parts in days.items() for label, _ in parts}


def remove_unnamed(spark: SparkSession, store: str) -> None:
    """Removes what only versions before the KEPT last ones name, and what drafts that broke off left."""
    folder = Folder(spark, store)
    numbers = sorted(int(x) for x in folder.names(RECORDS) if x.isdigit())
    old, stay = ([find(spark, store, x) for x in part] for part in (numbers[: -KEPT - 1], numbers[-KEPT - 1 :]))
    days = set().union(*map(_days, stay))
    for name, label, day in set().union(*map(_days, old)) - days:
        folder.delete(f"{name}/version={label}/date={day}")
    named = {(name, label) for x in stay for name, label in x.tables.items()} | {x[:2] for x in days}
    for name in sorted({name for name, _ in named}):
        for label in (x.removeprefix("version=") for x in folder.names(name) if x.startswith("version=")):
            older = int(label.split("-")[0]) <= numbers[-1]  # what comes after is being written
            if older and (name, label) not in named:
                folder.delete(f"{name}/version={label}")
    for version in old:
        folder.delete(f"{RECORDS}/{version.number:012d}")
