"""Episodes of a stream, kept up by Spark's keyed state.

The state of a key holds its events by period, in the RocksDB store that Spark checkpoints to the
shared folder. A batch opens only the keys that it has events for, and of those only the periods that
the events fall into and their neighbours; what ends in these periods is worked out anew and replaces
what was found before. Events may come in any order and more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.streaming.parts import add_part, parts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A period is so many times as long as an episode may last.
PERIODS = 8


class EpisodeFinder(StatefulProcessor):
    """Rows (key, period, episodes) for every period in which episodes may have changed."""

    def __init__(self, pattern: list[str], gap: int, id_type: str, keep_ms: int | None):
        self.pattern, self.gap, self.id_type, self.keep_ms = pattern, gap, id_type, keep_ms
        self.period = PERIODS * gap * max(1, len(pattern) - 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        rows = f"rows array<struct<at:bigint,id:{self.id_type},state:string>>"
        self.events = handle.getMapState("events", "period bigint", rows, self.keep_ms)

    def _rows(self, period: int) -> list[tuple]:
        if not self.events.containsKey((period,)):
            return []
        return [tuple(r) for r in self.events.getValue((period,))[0]]

    def _ending(self, period: int) -> list[dict]:
        """What ends in a period; an episode is shorter than one, so it begins there or in the one before."""
        steps = len(self.pattern) - 1
        before = self._rows(period - 1)[-steps:] if steps else []
        rows = before + self._rows(period)
        found = []
        for i in range(max(len(before), steps), len(rows)):
            run = rows[i - steps : i + 1]
            if [r[2] for r in run] == self.pattern and all(b[0] - a[0] <= self.gap for a, b in zip(run, run[1:], strict=False)):
                found.append({"started": run[0][0], "finished": run[-1][0], "last_event_id": run[-1][1]})
        return found

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, set] = {}
        for frame in rows:
            for at, event, state in zip(frame["at"].tolist(), frame["id"].tolist(), frame["state"].tolist(), strict=True):
                fresh.setdefault(at // self.period, set()).add((at, event, state))
        for period, events in fresh.items():
            self.events.updateValue((period,), (sorted(events.union(self._rows(period))),))
        changed = sorted(fresh | {p + 1: None for p in fresh if self.events.containsKey((p + 1,))})
        yield pd.DataFrame({"key": [key[0]] * len(changed), "period": changed, "episodes": [self._ending(p) for p in changed]})

    def close(self) -> None:
        pass


def _latest(found: DataFrame) -> DataFrame:
    return found.groupBy("key", "period").agg(F.max_by(F.struct("batch", "episodes"), "batch").alias("last")).select("key", "period", "last.*")


def episode_stream(
    events: DataFrame, key: str, event: str, moment: str, state: str, pattern: list[str], max_gap_seconds: int, path: str, checkpoint: str, keep_ms: int | None = None
):
    """Finds runs of consecutive events of a key that spell ``pattern`` without a longer pause.

    ``keep_ms`` lets Spark's timers drop events from the state so long after they were written; without
    it no event is too late. :func:`episodes` reads what has been found.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kinds = dict(events.dtypes)
    narrow = events.select(
        F.col(key).alias("key"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("at"),
        F.col(event).alias("id"),
        F.col(state).alias("state"),
    ).where("at IS NOT NULL")
    schema = f"key {kinds[key]}, period bigint, episodes array<struct<started:bigint,finished:bigint,last_event_id:{kinds[event]}>>"
    found = narrow.groupBy("key").transformWithStateInPandas(
        EpisodeFinder(pattern, max_gap_seconds * 1_000_000, kinds[event], keep_ms),
        outputStructType=StructType.fromDDL(schema),
        outputMode="Update",
        timeMode="ProcessingTime" if keep_ms else "None",
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        add_part(batch.withColumn("batch", F.lit(batch_id).cast("long")), path, batch_id, _latest)

    return found.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)


def episodes(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, started_at, finished_at, last_event_id) of the episodes over all events so far."""
    rows = _latest(parts(spark, path)).select("key", F.inline("episodes"))
    return rows.select(
        F.col("key").alias(key),
        F.timestamp_micros("started").alias("started_at"),
        F.timestamp_micros("finished").alias("finished_at"),
        "last_event_id",
    )
