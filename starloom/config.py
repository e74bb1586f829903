"""Session and settings; settings come from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    # dates must not depend on where the job runs
    "spark.sql.session.timeZone": "UTC",
    # nor must casts and overflows
    "spark.sql.ansi.enabled": "true",
    # the JVM compiles no method above 8000 bytes of bytecode: a generated stage beyond
    # that (typing 50 columns is one) would run interpreted, so Spark is told to generate
    # smaller pieces for it
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# The variables and their defaults. Passwords have no default.
DEFAULTS = {
    "POSTGRES_JDBC_URL": "jdbc:postgresql://postgres:5432/bigdata",
    "POSTGRES_USER": "bigdata",
    "POSTGRES_DRIVER": "org.postgresql.Driver",
    "SOURCE_TABLE": "mock_data",
    "SOURCE_SCHEMA": "star",
    "TARGET_SCHEMA": "star",
    "CLICKHOUSE_HOST": "clickhouse",
    "CLICKHOUSE_PORT": "8123",
    "CLICKHOUSE_DATABASE": "default",
    "CLICKHOUSE_USER": "default",
    "MONGODB_URI": "mongodb://mongodb:27017",
    "MONGODB_DATABASE": "reports",
    "JDBC_SLICES": "64",
    "JDBC_CONNECTIONS": "64",
}

CLICKHOUSE_DRIVER = "com.clickhouse.jdbc.ClickHouseDriver"
CLICKHOUSE_TABLE_OPTIONS = "ENGINE = MergeTree() ORDER BY tuple()"


@dataclass(frozen=True)
class JdbcStore:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str
    fetch_size: int = 10_000
    batch_size: int = 10_000
    # tasks that write at once
    connections: int = 64

    def properties(self) -> dict[str, str]:
        return {
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }

    def options(self, table: str | None = None) -> dict[str, str]:
        named = {"dbtable": table} if table else {}
        return {"url": self.url, **self.properties(), **named}


@dataclass(frozen=True)
class Settings:
    warehouse: JdbcStore
    source_table: str
    source_schema: str
    target_schema: str
    reports: JdbcStore
    documents_uri: str = field(repr=False)
    documents_database: str
    # tasks that a database table is read by
    slices: int


def settings(environment: Mapping[str, str] = os.environ) -> Settings:
    def value(name: str) -> str:
        return environment.get(name, DEFAULTS.get(name, ""))

    host, port = value("CLICKHOUSE_HOST"), value("CLICKHOUSE_PORT")
    return Settings(
        warehouse=JdbcStore(
            url=value("POSTGRES_JDBC_URL"),
            user=value("POSTGRES_USER"),
            password=value("POSTGRES_PASSWORD"),
            driver=value("POSTGRES_DRIVER"),
            connections=int(value("JDBC_CONNECTIONS")),
        ),
        source_table=value("SOURCE_TABLE"),
        source_schema=value("SOURCE_SCHEMA"),
        target_schema=value("TARGET_SCHEMA"),
        reports=JdbcStore(
            url=f"jdbc:clickhouse:http://{host}:{port}/{value('CLICKHOUSE_DATABASE')}",
            user=value("CLICKHOUSE_USER"),
            password=value("CLICKHOUSE_PASSWORD"),
            driver=CLICKHOUSE_DRIVER,
            connections=int(value("JDBC_CONNECTIONS")),
        ),
        documents_uri=value("MONGODB_URI"),
        documents_database=value("MONGODB_DATABASE"),
        slices=int(value("JDBC_SLICES")),
    )


def prepared(spark: SparkSession) -> SparkSession:
    """The caller's session with the settings the jobs rely on."""
    for name, setting in SESSION_SETTINGS.items():
        spark.conf.set(name, setting)
    return spark


def open_session(name: str) -> SparkSession:
    """The session of a submitted job; master, jars and sizes come with the submit."""
    return prepared(SparkSession.builder.appName(name).getOrCreate())
