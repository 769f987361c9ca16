"""Catalog settings and table registration."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def object_store_conf(endpoint: str, path_style: bool = True) -> dict[str, str]:
    """Settings for an S3-compatible warehouse; keys come from the environment only."""
    conf = {"spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}
    access, secret = os.environ.get("AWS_ACCESS_KEY_ID"), os.environ.get("AWS_SECRET_ACCESS_KEY")
    if access and secret:
        conf |= {"spark.hadoop.fs.s3a.access.key": access, "spark.hadoop.fs.s3a.secret.key": secret}
    return conf


def lake_catalog_conf(name: str, implementation: str, warehouse: str) -> dict[str, str]:
    """Settings that add a table catalog, such as a lake format's, under `name`."""
    return {f"spark.sql.catalog.{name}": implementation, f"spark.sql.catalog.{name}.warehouse": warehouse}


def metastore_conf(uris: str, warehouse: str) -> dict[str, str]:
    return {"spark.sql.catalogImplementation": "hive", "spark.hadoop.hive.metastore.uris": uris,
            "spark.sql.warehouse.dir": warehouse}


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.catalog.setCurrentDatabase(database)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))
