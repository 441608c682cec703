"""JDBC connection settings and reads."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The default table and driver of the target database.
DEFAULT_TABLE = "transaction_data"
POSTGRES_DRIVER = "org.postgresql.Driver"

#: Rows that a connection fetches at a time.
FETCH_SIZE = 10_000


@dataclass(frozen=True)
class JdbcTarget:
    """Where a table lives. The password stays out of ``repr``.

    ``options`` are further settings of the connection, such as ``sslmode``.
    """

    url: str
    table: str = DEFAULT_TABLE
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = POSTGRES_DRIVER
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_env(cls, table: str = DEFAULT_TABLE, env: dict[str, str] | None = None):
        """Build a PostgreSQL target from ``DB_HOST/PORT/NAME/USER/PASS``."""
        env = dict(os.environ) if env is None else env
        host, port = env.get("DB_HOST", "localhost"), env.get("DB_PORT", "5432")
        return cls(
            url=f"jdbc:postgresql://{host}:{port}/{env['DB_NAME']}",
            table=table,
            user=env.get("DB_USER"),
            password=env.get("DB_PASS"),
        )

    @property
    def properties(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        known = {name: value for name, value in given.items() if value is not None}
        return {**self.options, **known}


def jdbc_query(
    spark: SparkSession,
    target: JdbcTarget,
    query: str,
    predicates: Sequence[str] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """Run ``query`` inside the database and read its rows, ``fetch_size`` at a time.

    One task reads the result, unless ``predicates`` cuts it into disjoint parts
    that are read in parallel, one task and connection each.
    """
    table = f"({query}) AS q"
    # without it the driver of this database holds the whole result
    properties = {"fetchsize": str(fetch_size), **target.properties}
    if predicates:
        return spark.read.jdbc(
            target.url, table, predicates=list(predicates), properties=properties
        )
    return spark.read.jdbc(target.url, table, properties=properties)


def hash_parts(column: str, parts: int) -> list[str]:
    """Predicates that cut a result into disjoint parts by a hash of a text column."""
    return [f"mod(hashtext({column}) & 2147483647, {parts}) = {i}" for i in range(parts)]


def check_connection(
    spark: SparkSession, target: JdbcTarget, query: str = "SELECT version() AS db_version"
) -> DataFrame:
    """Read and show a one-row query; raises if the database cannot be reached."""
    answer = jdbc_query(spark, target, query)
    answer.show(truncate=False)
    return answer
