"""Zip tables stored by end date.

Open versions are in the partition of `OPEN_END`, closed ones in that of the day they ended. A day's load
reads and writes two partitions, the open one and the one that ends on the day before; all others keep
their files. Both switch in one step, so a reader never sees a version twice or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.history import OPEN_END
from .switched import SwitchedTable

START, END = "start_date", "end_date"


class ZipTable:
    """`schema` has the keys and the columns whose changes are kept."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.keys, self.columns = list(keys), schema.names
        stored = T.StructType([*schema.fields, T.StructField(START, T.DateType()), T.StructField(END, T.DateType())])
        self.table = SwitchedTable(spark, path, stored, END)

    def load(self, snapshot: DataFrame, day: date) -> None:
        """Versions as of `day`, from its snapshot or only its changed rows.

        A changed row closes its version on the day before; an unchanged or missing one stays as it is. Of several
        rows with one key the greatest counts, NULL keys are one key. Days come in rising order; the last
        day may be loaded again, with other rows too: its first load is taken back.
        """
        close = day - timedelta(days=1)
        of_day, end = F.lit(day), F.lit(OPEN_END).cast("date")
        touched = [OPEN_END, close.isoformat()]
        stored = self.table.read(touched)
        if not stored.filter(F.col(START) > of_day).isEmpty():
            raise ValueError(f"a day after {day} is loaded already")
        row = F.struct(*self.columns)
        # What ended the day before was ended by this day's load; what starts on this day came from it.
        before = stored.filter(F.col(START) < of_day).select(*self.keys, F.struct(START, row.alias("row")).alias("_old"))
        both = before.unionByName(snapshot.select(*self.keys, row.alias("_new")), allowMissingColumns=True)
        pair = both.groupBy(*self.keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
        old, new = F.col("_old.row"), F.col("_new")

        def version(of, start, stop):
            return F.struct(of.alias("row"), start.alias(START), stop.alias(END))

        versions = F.when(F.col("_old").isNull(), F.array(version(new, of_day, end))) \
            .when(new.isNull() | old.eqNullSafe(new), F.array(version(old, F.col(f"_old.{START}"), end))) \
            .otherwise(F.array(version(old, F.col(f"_old.{START}"), F.lit(close)), version(new, of_day, end)))
        rows = pair.select(F.inline(versions)).select("row.*", START, END)
        self.table.replace(rows, touched)

    def read(self) -> DataFrame:
        return self.table.read()

    def current(self) -> DataFrame:
        """Open versions; only their partition is read."""
        return self.table.read([OPEN_END])

    def as_of(self, day: date) -> DataFrame:
        """Versions in force on `day`; partitions that ended before it aren't read."""
        ends = [value for value in self.table.partitions() if value >= day.isoformat()]
        return self.table.read(ends).filter(F.col(START) <= F.lit(day))
