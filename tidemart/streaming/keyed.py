"""Keyed state with expiry: newest time, first day and last row per key.

State lives in the session's state store (RocksDB in `session.RUNTIME_CONF`), one small value per key,
so a micro-batch costs what its own rows cost, however many came before. A busy key is thinned out
before the shuffle: each Arrow batch keeps only the rows that can still matter. What is left of one
key's rows of one micro-batch is handled in one task; the source's rate limit bounds it.

Streams that use processing time (`ttl_ms`, windows of processing time) run batches without data for
their timers, so they need a trigger that goes on; a run over the available data would not end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from .visitors import DAY_MS


def _value(name: str, kind: str) -> T.StructType:
    return T.StructType().add(name, kind)


def _read(state) -> object:
    """The one field of a value state, None where there is none."""
    got = state.get()
    return None if got is None else got[0]


# ---- newer than all before -------------------------------------------------------------------

def rising(rows: pd.DataFrame, keys: list[str], time: str, arrival: str) -> pd.DataFrame:
    """Rows newer than every earlier arrival of their key among these rows, in the order of arrival."""
    rows = rows.sort_values([*keys, arrival], kind="stable")
    highest = rows.groupby(keys, dropna=False, sort=False)[time].cummax()
    seen = highest.groupby([rows[k] for k in keys], dropna=False, sort=False).shift()
    return rows[rows[time].notna() & (seen.isna() | (rows[time] > seen))]


class NewestSeen(StatefulProcessor):
    """Passes the rows newer than every earlier arrival of their key. The newest time is forgotten
    `ttl_ms` after it was written (processing time), never without it."""

    def __init__(self, key: str, time: str, arrival: str, ttl_ms: int | None = None):
        self.key, self.time, self.arrival, self.ttl_ms = key, time, arrival, ttl_ms

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", _value("t", "long"), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = _read(self.newest)
        kept = rising(pd.concat(list(rows)), [self.key], self.time, self.arrival)
        if newest is not None:
            kept = kept[kept[self.time] > newest]
        if len(kept):
            self.newest.update((int(kept[self.time].iloc[-1]),))
            yield kept

    def close(self) -> None:
        pass


class NewestSeenRows(NewestSeen):
    """The same over plain rows: a frame for each key of a micro-batch costs far more than its few rows."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = known = _read(self.newest)
        timed = [r for r in rows if r[self.time] is not None]
        timed.sort(key=lambda r: (r[self.arrival] is None, r[self.arrival]))
        for row in timed:
            if newest is None or row[self.time] > newest:
                newest = row[self.time]
                yield row
        if newest != known:
            self.newest.update((int(newest),))


def newer_only(stream: DataFrame, key: str, time: str, arrival: str, ttl_ms: int | None = None) -> DataFrame:
    """Rows whose `time` is above that of every earlier arrival of their key; micro-batches come in the
    order of `arrival`, their rows in any. Rows without a time are left out."""
    names = stream.columns

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rising(rows, [key], time, arrival)

    return stream.mapInPandas(thin, stream.schema).groupBy(key).transformWithState(
        NewestSeenRows(key, time, arrival, ttl_ms), stream.schema, "Append", "ProcessingTime" if ttl_ms else "None").select(*names)


# ---- first day of a device -------------------------------------------------------------------

class FirstDay(StatefulProcessor):
    """Sets the new-visitor flag of rows after a device's first day to '0'.

    Rows with `hint` only tell of a visit and aren't passed on. With `idle_ms` a device is forgotten
    when the watermark is so far beyond its last visit, or its next visit comes so much later.
    """

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", T.StructType().add("day", "long").add("last", "long"))

    def noted(self, begin: int, flag: str, end: int) -> int:
        """First day of the device, after visits from `begin`, with that flag, to `end`."""
        known = self.first.get()
        if known is not None and self.idle_ms is not None and begin - known[1] > self.idle_ms:
            known = None
        day, last = (begin // DAY_MS - (flag != "1"), end) if known is None else (known[0], max(known[1], end))
        self.first.update((int(day), int(last)))
        if self.idle_ms is not None:
            self.handle.registerTimer(last + self.idle_ms + 1)
        return int(day)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        here = pd.concat(list(rows))
        begin, end = int(here["ts"].min()), int(here["ts"].max())
        day = self.noted(begin, here[here["ts"] == begin]["is_new"].fillna("").min(), end)   # '0' before '1' at the same time
        passed = here[~here["hint"]]
        if len(passed):
            stale = (passed["is_new"] == "1") & (passed["ts"] // DAY_MS != day)
            yield passed.assign(is_new=np.where(stale, "0", passed["is_new"]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.first.get()
        if known is not None and expiredTimerInfo.getExpiryTimeInMs() > known[1] + self.idle_ms:
            self.first.clear()
        return iter(())

    def close(self) -> None:
        pass


class FirstDayOfVisits(FirstDay):
    """The same over rows that hold a device's visits of an Arrow batch (`visits_of`): gives out the times of
    those that claim to be new with the device's first day."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        begin, flag = min((r.begin, r.flag) for r in rows)
        day = self.noted(begin, flag, max(r.end for r in rows))
        for r in rows:
            if r.claims:
                yield Row(mid=key[0], claims=r.claims, day=day)


VISITS = "mid string, claims array<long>, begin long, flag string, end long"


def visits_of(rows: pd.DataFrame) -> pd.DataFrame:
    """One row a device: the times of its rows that claim to be new, the first time and its flag, the last time."""
    rows = rows.assign(is_new=rows["is_new"].fillna("")).sort_values(["mid", "ts", "is_new"], kind="stable")
    mid, ts, flag = (rows[c].to_numpy() for c in ("mid", "ts", "is_new"))
    starts = np.flatnonzero(np.r_[True, mid[1:] != mid[:-1]])
    ends, claim = np.r_[starts[1:], len(rows)], flag == "1"
    claims = [ts[a:b][claim[a:b]] for a, b in zip(starts, ends)]
    return pd.DataFrame({"mid": mid[starts], "claims": claims, "begin": ts[starts], "flag": flag[starts], "end": ts[ends - 1]})


def repair_is_new(logs: DataFrame, idle_ms: int | None = None, delay: str = "3 seconds") -> DataFrame:
    """Columns mid, ts, is_new of a stream: a device counts as new only on the day of its first visit.

    Of each Arrow batch a device sends one row through the state, with the times that claim to be new and its
    earliest and latest visit. Rows without a device or a time keep their flag. With `idle_ms` the stream
    gets a watermark of `delay`, and a device's rows behind it count as not seen before; rows then go through
    the state one by one, those that don't claim to be new as a device's earliest and latest of an Arrow batch.
    """
    logs = logs.select("mid", "ts", "is_new")
    usable = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    claims = F.coalesce(F.col("is_new") == "1", F.lit(False)) & usable

    if idle_ms is None:
        packed = logs.filter(usable).mapInPandas(lambda batches: (visits_of(rows) for rows in batches if len(rows)), VISITS)
        days = packed.groupBy("mid").transformWithState(FirstDayOfVisits(), "mid string, claims array<long>, day long", "Append", "None")
        day = F.expr(f"(ts - pmod(ts, {DAY_MS})) div {DAY_MS}")
        told = days.select("mid", F.explode("claims").alias("ts"), "day")
        return logs.filter(~claims).unionByName(told.select("mid", "ts", F.when(day != F.col("day"), "0").otherwise("1").alias("is_new")))

    def hints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            new = rows["is_new"] == "1"
            others = rows[~new].sort_values(["mid", "ts", "is_new"], kind="stable")
            ends = pd.concat([others.drop_duplicates("mid"), others.drop_duplicates("mid", keep="last")])
            yield pd.concat([rows[new].assign(hint=False), ends.assign(hint=True)])

    schema = T.StructType([*logs.schema.fields, T.StructField("hint", T.BooleanType())])
    told = logs.filter(usable).mapInPandas(hints, schema)
    told = told.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)
    repaired = told.groupBy("mid").transformWithStateInPandas(FirstDay(idle_ms), logs.schema, "Append", "EventTime")
    return logs.filter(~claims).unionByName(repaired)


# ---- last row of a processing-time window ------------------------------------------------------

class LastOfWindow(StatefulProcessor):
    """Keeps the newest row of the running window of a key and gives it out when the window's time is over.

    Windows are of the machine's clock: rows of a micro-batch belong to the window in which the batch
    runs. A timer at the window's end gives out the row; a batch that comes first does so itself.
    """

    def __init__(self, schema: T.StructType, width_ms: int, order: list[str]):
        self.schema, self.width_ms, self.order = schema, width_ms, order

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType().add("window_ms", "long").add("row", self.schema))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        window = timerValues.getCurrentProcessingTimeInMs() // self.width_ms * self.width_ms
        held = self.last.get()
        best = None
        for part in rows:
            top = part.sort_values(self.order, kind="stable").iloc[-1:]
            best = top if best is None else pd.concat([best, top]).sort_values(self.order, kind="stable").iloc[-1:]
        if held is not None and held[0] == window:
            old = pd.DataFrame([tuple(held[1])], columns=self.schema.names)
            best = pd.concat([old, best[self.schema.names]]).sort_values(self.order, kind="stable").iloc[-1:]
        elif held is not None:
            yield self._out(held)
        self.last.update((window, tuple(_plain(best[c].iloc[0]) for c in self.schema.names)))
        self.handle.registerTimer(window + self.width_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        if held is not None and held[0] + self.width_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
            yield self._out(held)

    def _out(self, held) -> pd.DataFrame:
        row = dict(zip(self.schema.names, tuple(held[1]), strict=True))
        return pd.DataFrame([{**row, "window_ms": held[0]}])

    def close(self) -> None:
        pass


def _plain(value):
    return value.item() if isinstance(value, np.generic) else value


def last_per_processing_window(stream: DataFrame, key: str, order: list[str], width_ms: int = 120_000) -> DataFrame:
    """The last row (by `order`) of each key in each window of processing time, with the window's begin `window_ms`."""
    out = T.StructType([*stream.schema.fields, T.StructField("window_ms", T.LongType())])
    return stream.groupBy(key).transformWithStateInPandas(
        LastOfWindow(stream.schema, width_ms, order), out, "Append", "ProcessingTime")
