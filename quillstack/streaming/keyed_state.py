"""State with a lifetime: a cache of keys whose entries expire.

A row of a key is a ``miss`` if the key has no entry, and makes one that lives for ``ttl`` from the row's time; rows
within that are a ``hit``. An entry is dropped when the watermark passes its end, by an event-time timer, so state
holds the live entries and not every key there ever was. Rows that come after the watermark has passed their times
are dropped, as everywhere in streams; rows of one batch are taken in the order of their times, equal ones as they
come, which makes the first the miss. A row without a time has no place and is dropped; null keys are one key.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The setting that state with timers needs.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Cache(StatefulProcessor):
    """Entries as the microsecond that each lives until."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        until = begun = self.until.get()[0] if self.until.exists() else None
        for us in sorted(r["us"] for r in rows):
            missed = until is None or us >= until
            if missed:
                until = us + self.ttl
            yield Row(key=key[0], us=us, kind="miss" if missed else "hit")
        if until != begun:
            if begun is not None:
                self.handle.deleteTimer(-(-begun // 1000))
            self.until.update((until,))
            self.handle.registerTimer(-(-until // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.until.exists() and self.until.get()[0] <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            until = self.until.get()[0]
            self.until.clear()
            yield Row(key=key[0], us=until, kind="expired")

    def close(self) -> None:
        pass


def cached(stream: DataFrame, key: str, time: str, ttl: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(key, time, kind): a hit or a miss for each row, and the end of each entry that the watermark has passed."""
    spark = stream.sparkSession
    spark.conf.set(*PROVIDER)
    length = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {ttl}")).alias("x")).first()["x"]
    own = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(time).alias("time")).where("time IS NOT NULL").withWatermark("time", late).select("key", "time", F.unix_micros("time").alias("us"))
    made = rows.groupBy("key").transformWithState(
        statefulProcessor=_Cache(length), outputStructType=f"key {own}, us long, kind string", outputMode="append", timeMode="EventTime"
    )
    return made.select(F.col("key").alias(key), F.timestamp_micros("us").alias(time), "kind")
