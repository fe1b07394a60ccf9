"""Arguments shared by the programs."""

from __future__ import annotations

import argparse
import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.schema import CONSUMER_GROUP, KPI_NAMES, TOPIC
from roadpulse.sources.database import Database
from roadpulse.sources.lake import FORMATS
from roadpulse.sources.messages import message_files, topic
from roadpulse.streaming.ingest import ONCE


def session(name: str) -> SparkSession:
    return SparkSession.builder.appName(name).getOrCreate()


def parser(description: str) -> argparse.ArgumentParser:
    return argparse.ArgumentParser(description=description)


def add_source(arguments: argparse.ArgumentParser) -> None:
    source = arguments.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers of the topic")
    source.add_argument("--files", help="directory of text files, one message per line")
    arguments.add_argument("--topic", default=TOPIC)
    arguments.add_argument("--group", default=CONSUMER_GROUP)
    arguments.add_argument("--batch-rows", type=int, help="most messages in a batch")
    arguments.add_argument("--min-partitions", type=int, help="fewest tasks reading the topic")
    arguments.add_argument("--checkpoint", required=True)
    arguments.add_argument("--once", action="store_true", help="stop when all is read")
    arguments.add_argument("--every", default="1 minute", help="time between batches")


def messages(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.files:
        return message_files(spark, options.files)
    return topic(
        spark,
        options.servers,
        options.topic,
        options.group,
        batch_rows=options.batch_rows,
        min_partitions=options.min_partitions,
    )


def trigger(options: argparse.Namespace) -> dict:
    return ONCE if options.once else {"processingTime": options.every}


def wait(spark: SparkSession, running: list[StreamingQuery], options: argparse.Namespace) -> None:
    """Until all is read, or for good: one query failing ends the program."""
    if options.once:
        for query in running:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def add_lake(arguments: argparse.ArgumentParser) -> None:
    arguments.add_argument("--lake", required=True, help="root of the event lake")
    arguments.add_argument("--lake-format", choices=sorted(FORMATS), default="json")


def add_reading(arguments: argparse.ArgumentParser, stream: bool = True) -> None:
    arguments.add_argument(
        "--read-mode",
        choices=["FAILFAST", "DROPMALFORMED"],
        default="FAILFAST",
        help="what a broken line of a JSON lake does: stop the program, or be left out",
    )
    if stream:
        arguments.add_argument("--files-per-batch", type=int, help="most files in a batch")


def add_store(arguments: argparse.ArgumentParser) -> None:
    arguments.add_argument("--store", required=True, help="root of the stored tables")


def add_database(arguments: argparse.ArgumentParser, required: bool) -> None:
    arguments.add_argument("--url", required=required, help="JDBC address of the database")
    arguments.add_argument("--user", required=required)
    arguments.add_argument("--driver", default="org.postgresql.Driver")
    arguments.add_argument(
        "--password-variable",
        default="JDBC_PASSWORD",
        help="environment variable that holds the password",
    )
    arguments.add_argument("--tables", nargs="+", choices=KPI_NAMES, default=KPI_NAMES)
    arguments.add_argument("--alert-connections", type=int, default=8)


def database(options: argparse.Namespace) -> Database | None:
    if options.url is None:
        return None
    password = os.environ.get(options.password_variable, "")
    return Database(options.url, options.user or "", password, options.driver)


def a_date(text: str) -> date:
    return date.fromisoformat(text)
