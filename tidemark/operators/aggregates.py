"""Aggregates written in Python, with a combiner.

Rows are reduced to one state per key and batch where they lie, states are merged in two rounds, by
(key, salt) and by key. No task ever holds the rows of a group, nor all states of a frequent key, and a
round streams over states that are sorted by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SALTS = 64
Frames = Iterator[pd.DataFrame]


class Aggregate(NamedTuple):
    """Functions on frames that may hold any number of keys; each keeps the key columns."""

    #: Columns of a state and of the result, as in SQL.
    state: str
    result: str
    #: Rows to one state per key, states to one state per key, states to results.
    reduce: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    merge: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    finish: Callable[[pd.DataFrame], pd.DataFrame]


def _arrow(df: DataFrame, function: Callable[[Frames], Frames], ddl: str) -> DataFrame:
    """``mapInArrow`` over frames whose columns keep their Arrow types, nulls among integers too."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in function(batch.to_pandas(types_mapper=pd.ArrowDtype) for batch in batches if batch.num_rows):
            yield pa.RecordBatch.from_pandas(frame[schema.names], schema, preserve_index=False)

    return df.mapInArrow(run, ddl)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _merged(states: DataFrame, keys: list[str], merge: Callable[[pd.DataFrame, list[str]], pd.DataFrame]) -> DataFrame:
    """One state per value of ``keys``: rows of a key follow one another, and only the last key of a
    batch waits for the next batch."""

    def run(frames: Frames) -> Frames:
        waiting: pd.DataFrame | None = None
        for frame in frames:
            rows = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            found, last = merge(rows, keys), rows[keys].iloc[-1]
            same = np.ones(len(found), dtype=bool)
            for k in keys:
                same &= (found[k].isna() if pd.isna(last[k]) else (found[k] == last[k]).fillna(False)).to_numpy(dtype=bool)
            waiting = found[same]
            yield found[~same]
        if waiting is not None:
            yield waiting

    return _arrow(states.repartition(*keys).sortWithinPartitions(*keys), run, _ddl(states))


def aggregate(df: DataFrame, keys: list[str], columns: list[str], by: Aggregate, salts: int = SALTS) -> DataFrame:
    """``keys`` and the result of ``by`` over ``columns`` for each key; null keys are a group."""
    types = _ddl(df.select(*keys))
    first = _arrow(df.select(*keys, *columns), lambda frames: (by.reduce(f, keys) for f in frames), f"{types}, {by.state}")
    salted = first.withColumn("_salt", F.pmod(F.spark_partition_id() + F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    once = _merged(salted, [*keys, "_salt"], by.merge).drop("_salt")
    return _arrow(_merged(once, keys, by.merge), lambda frames: (by.finish(f) for f in frames), f"{types}, {by.result}")


def geometric_mean(column: str) -> Aggregate:
    """``n`` and ``geo_mean`` of the positive values of ``column``."""

    def reduce(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        good = rows[rows[column] > 0]
        logs = good.assign(total=np.log(good[column].astype("float64")), n=1)
        return logs.groupby(keys, dropna=False, as_index=False).agg(n=("n", "sum"), total=("total", "sum"))

    def merge(states: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        return states.groupby(keys, dropna=False, as_index=False).agg(n=("n", "sum"), total=("total", "sum"))

    def finish(states: pd.DataFrame) -> pd.DataFrame:
        return states.assign(geo_mean=np.exp((states["total"] / states["n"]).astype("float64"))).drop(columns="total")

    return Aggregate("n bigint, total double", "n bigint, geo_mean double", reduce, merge, finish)
