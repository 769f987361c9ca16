"""One page-log stream into error, start, display, action and page streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BRANCHES = ("err", "start", "display", "action", "page")


def split(logs: DataFrame) -> dict[str, DataFrame]:
    """The five branches. A start record is only a start record; displays and actions
    become one row each and carry the common and page parts."""
    started = F.col("start").isNotNull()
    pages = logs.filter(~started)
    return {
        "err": logs.filter(F.col("err").isNotNull()).select("err"),
        "start": logs.filter(started).select("common", "start", "ts"),
        "display": pages.select("common", "page", F.explode("displays").alias("display"), "ts"),
        "action": pages.select("common", "page", F.explode("actions").alias("action")),
        "page": pages.select("common", "page", "ts"),
    }
