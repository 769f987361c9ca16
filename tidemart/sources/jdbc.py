"""Relational databases: type maps, partitioned pulls, distributed export."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

EXPORT_BATCH = 10_000

# Relational column types and the warehouse types that hold them.
WAREHOUSE_TYPES = {
    "tinyint": "int", "smallint": "int", "mediumint": "int", "int": "int", "integer": "int",
    "bigint": "bigint", "float": "float", "double": "double", "decimal": "decimal", "numeric": "decimal",
    "char": "string", "varchar": "string", "text": "string", "tinytext": "string", "mediumtext": "string",
    "longtext": "string", "enum": "string", "set": "string", "json": "string", "date": "date",
    "datetime": "timestamp", "timestamp": "timestamp", "time": "string", "year": "int", "bit": "boolean",
    "boolean": "boolean", "binary": "binary", "varbinary": "binary", "blob": "binary",
}
# Warehouse types and the relational column types they are exported to.
RELATIONAL_TYPES = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INT", "bigint": "BIGINT", "float": "FLOAT",
    "double": "DOUBLE", "string": "TEXT", "boolean": "TINYINT(1)", "date": "DATE", "timestamp": "DATETIME",
    "binary": "BLOB",
}


def warehouse_type(relational: str) -> str:
    """Warehouse type of a relational column type such as `decimal(10,2) unsigned`."""
    match = re.match(r"\s*([a-z]+)\s*(\(([^)]*)\))?", relational.lower())
    if not match:
        raise ValueError(f"unreadable type {relational!r}")
    base = WAREHOUSE_TYPES.get(match.group(1), "string")
    if base == "decimal":
        return f"decimal({match.group(3).replace(' ', '')})" if match.group(3) else "decimal(10,0)"
    return base


def relational_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return RELATIONAL_TYPES.get(kind.simpleString(), "TEXT")


@dataclass(frozen=True)
class RelationalColumn:
    name: str
    type: str
    comment: str = ""


def warehouse_ddl(table: str, columns: list[RelationalColumn], path: str, day: str = "dt", comment: str = "",
                  fmt: str = "orc") -> str:
    """CREATE TABLE of the warehouse copy of a relational table."""
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    lines = ",\n".join(f"  `{c.name}` {warehouse_type(c.type)}" + (f" COMMENT {quoted(c.comment)}" if c.comment else "")
                       for c in columns)
    note = f" COMMENT {quoted(comment)}" if comment else ""
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n{lines},\n  `{day}` string\n) USING {fmt}{note}\n"
            f"PARTITIONED BY (`{day}`)\nLOCATION {quoted(path)}")


@dataclass(frozen=True)
class Connection:
    """Where a database is. Credentials come from the environment only."""

    url: str
    driver: str
    user_variable: str = "JDBC_USER"
    password_variable: str = "JDBC_PASSWORD"
    extra: Mapping[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        found = {"user": os.environ.get(self.user_variable), "password": os.environ.get(self.password_variable)}
        return {"driver": self.driver, **{k: v for k, v in found.items() if v}, **self.extra}


def read_table(spark: SparkSession, connection: Connection, table: str, time_col: str, *, key: str | None = None,
               lower: int = 0, upper: int = 0, parts: int = 1, day: str = "dt") -> DataFrame:
    """Pull a table with its day partition; rows without a time are dropped. With `key`
    the pull runs in `parts` tasks over ranges of that whole-number column."""
    ranges = {"column": key, "lowerBound": lower, "upperBound": upper, "numPartitions": parts} if key else {}
    rows = spark.read.jdbc(connection.url, table, properties=connection.properties(), **ranges)
    return rows.filter(F.col(time_col).isNotNull()).withColumn(day, F.date_format(time_col, "yyyyMMdd"))


def unique_columns(df: DataFrame) -> DataFrame:
    """First of each group of columns whose names differ in case only."""
    seen: set[str] = set()
    kept = []
    for i, name in enumerate(df.columns):
        if name.lower() not in seen:
            seen.add(name.lower())
            kept.append(i)
    if len(kept) == len(df.columns):
        return df
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return positional.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in kept])


def export_options(df: DataFrame, batch: int = EXPORT_BATCH) -> dict[str, str]:
    types = ", ".join(f"`{f.name}` {relational_type(f.dataType)}" for f in df.schema.fields)
    return {"batchsize": str(batch), "createTableColumnTypes": types, "truncate": "true"}


def export_table(df: DataFrame, connection: Connection, table: str, batch: int = EXPORT_BATCH,
                 writers: int | None = None, mode: str = "overwrite") -> None:
    """Write to a database from the executors in batches; nothing passes the driver."""
    out = unique_columns(df)
    if writers:
        out = out.coalesce(writers)
    out.write.options(**export_options(out, batch)).jdbc(connection.url, table, mode, connection.properties())
