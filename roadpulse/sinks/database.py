"""Publishing tables to the serving database."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.database import Database


def append_database(
    table: DataFrame, database: Database, name: str, connections: int = 1, batch_rows: int = 10_000
) -> None:
    """Adds rows to a database table, over at most ``connections`` sessions."""
    (
        table.write.format("jdbc")
        .options(**database.connection())
        .option("dbtable", name)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .mode("append")
        .save()
    )


def write_database(
    table: DataFrame,
    database: Database,
    name: str,
    connections: int = 1,
    batch_rows: int = 10_000,
) -> None:
    """Replaces the rows of a database table.

    The table is emptied, not dropped, so grants and indexes stay. ``connections``
    bounds the sessions opened at once. With one connection the load is one
    transaction; with more, a task that is repeated after its commit repeats its
    rows, which ``plans.refresh.verify`` finds by comparing the counts.
    """
    (
        table.write.format("jdbc")
        .options(**database.connection())
        .option("dbtable", name)
        .option("truncate", "true")
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .mode("overwrite")
        .save()
    )


#: Table that says which loads the database holds.
LOADS = "loads_done"


class Transaction:
    """Statements on one connection of the driver, committed together or not at all."""

    def __init__(self, connection):
        self._connection = connection

    def _prepared(self, sql: str, values: tuple):
        statement = self._connection.prepareStatement(sql)
        for place, value in enumerate(values, 1):
            statement.setString(place, value)
        return statement

    def number(self, sql: str, *values: str) -> int:
        """The one number that a query gives."""
        rows = self._prepared(sql, values).executeQuery()
        rows.next()
        return rows.getLong(1)

    def run(self, sql: str, *values: str) -> int:
        return self._prepared(sql, values).executeUpdate()


@contextmanager
def transaction(spark: SparkSession, database: Database) -> Iterator[Transaction]:
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    driver = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(database.driver)
    new = driver.getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0))
    settings = jvm.java.util.Properties()
    for name, value in (("user", database.user), ("password", database.password)):
        settings.setProperty(name, value)
    connection = new.newInstance(gateway.new_array(jvm.java.lang.Object, 0)).connect(database.url, settings)
    try:
        connection.setAutoCommit(False)
        yield Transaction(connection)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def staging_table(name: str, key: str) -> str:
    return f"{name}_load_{hashlib.md5(key.encode()).hexdigest()[:12]}"


def load_once(
    table: DataFrame, database: Database, name: str, key: str, connections: int = 1, replace: bool = False
) -> bool:
    """Adds rows to a database table, or replaces its rows, once for each ``key``; False if that was done.

    The rows go over ``connections`` sessions into a table of their own, numbered by task, so that what
    a repeated task wrote twice is found. One transaction then moves them and notes the key: whatever
    breaks off before it leaves nothing, and a load that is repeated after it changes nothing. It
    presumes one writer for a key, and tasks that give the same rows when they are run again, as
    reads of stored files do.
    """
    spark, columns = table.sparkSession, ", ".join(table.columns)
    numbered = table.withColumn("load_row", F.monotonically_increasing_id())
    # Both tables are made by Spark where they are missing, in the types of the database.
    append_database(spark.createDataFrame([], "load_key STRING"), database, LOADS)
    append_database(table.limit(0), database, name)
    count = f"SELECT COUNT(*) FROM {LOADS} WHERE load_key = ?"
    with transaction(spark, database) as check:
        if check.number(count, key):
            return False
    staging = staging_table(name, key)
    write_database(numbered, database, staging, connections)
    with transaction(spark, database) as move:
        if replace:
            move.run(f"DELETE FROM {name}")
        move.run(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM (SELECT DISTINCT load_row, {columns} FROM {staging}) moved")
        move.run(f"INSERT INTO {LOADS} (load_key) VALUES (?)", key)
    with transaction(spark, database) as clean:
        clean.run(f"DROP TABLE {staging}")
    return True
