"""Database sources and sinks; any JDBC driver on the class path will do."""

from __future__ import annotations

from configparser import ConfigParser
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    url: str
    driver: str
    user: str
    password: str

    def options(self) -> dict[str, str]:
        """Credentials travel as options, never inside the URL."""
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }


def connection_from_file(path: str, database: str, section: str = "DBCRED") -> Connection:
    """Read driver, host, port, user and pass from a properties file."""
    config = ConfigParser(interpolation=None)
    if not config.read(path):
        raise FileNotFoundError(path)
    part = config[section]
    return Connection(
        url=f"{part['host']}:{part['port']}/{database}",
        driver=part["driver"],
        user=part["user"],
        password=part["pass"],
    )


@dataclass(frozen=True)
class Slices:
    """Parallel read over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int


def read_options(
    connection: Connection,
    table: str | None = None,
    query: str | None = None,
    slices: Slices | None = None,
    schema: str | None = None,
) -> dict[str, str]:
    """Reader options for a table, or for a query the database runs itself."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = connection.options()
    if slices is not None:
        # A sliced read needs dbtable, so a query goes in as a derived table.
        options["dbtable"] = table if table is not None else f"({query}) pushed"
        options.update(
            partitionColumn=slices.column,
            lowerBound=slices.lower,
            upperBound=slices.upper,
            numPartitions=str(slices.count),
        )
    elif table is not None:
        options["dbtable"] = table
    else:
        options["query"] = query
    if schema is not None:
        options["customSchema"] = schema
    return options


def read_jdbc(spark: SparkSession, connection: Connection, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, **kwargs)).load()


def write_options(connection: Connection, table: str, batch_rows: int = 10_000) -> dict[str, str]:
    return {**connection.options(), "dbtable": table, "batchsize": str(batch_rows)}


def write_jdbc(
    df: DataFrame, connection: Connection, table: str, mode: str = "append", writers: int = 16
) -> None:
    """Write with at most ``writers`` connections open at once.

    The shuffle keeps the tasks before it as many as they were.
    """
    options = {**write_options(connection, table), "numPartitions": str(writers)}
    df.repartition(writers).write.format("jdbc").options(**options).mode(mode).save()
