"""Tables of the serving database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Connection of a JDBC database. The driver's jar must be on the class path."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    options: dict[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            **self.options,
        }


def read_database(spark: SparkSession, database: Database, table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**database.connection(), dbtable=table).load()


def database_count(spark: SparkSession, database: Database, table: str) -> int:
    """Rows of a table, counted by the database; one number crosses the wire."""
    counted = (
        spark.read.format("jdbc")
        .options(**database.connection(), query=f"SELECT COUNT(*) AS row_total FROM {table}")
        .load()
    )
    return int(counted.first()[0])
