"""Keyed mutable tables: merge, upsert, update, change data and history.

Each operator is DataFrame in, DataFrame out; the caller writes the result as the table's next state.
If the target is read from buckets (:mod:`tidemark.sources.bucketed`) and ``buckets`` gives their
number, the source is exchanged once into the same buckets, for its windows and the join; the target
stays where it is, and the result lies in the buckets of the next state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import segments as G
from tidemark.operators.relational import latest_per_key


REPEATED = "several source rows match one target row"


def _dealt(source: DataFrame, keys: list[str], buckets: int | None) -> DataFrame:
    return source.repartition(buckets, *keys) if buckets else source


def _tagged(source: DataFrame, keys: list[str], buckets: int | None) -> DataFrame:
    """Source rows with their number per key, counted along the exchange of the join."""
    source = _dealt(source, keys, buckets)
    rest = [F.col(c).alias(f"_new_{c}") for c in source.columns if c not in keys]
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return source.select(*keys, *rest, rows.alias("_rows"))


def _taken(c: str, matched: Column, kept: Column, kind: str) -> Column:
    """The new value of a matching row, the kept one else; a second match is an error."""
    twice = F.when(F.col("_rows") > 1, F.raise_error(F.lit(REPEATED)).cast(kind))
    return F.when(matched, twice.otherwise(F.col(f"_new_{c}"))).otherwise(kept).alias(c)


def merge_update(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], buckets: int | None = None
) -> DataFrame:
    """Take ``columns`` from the matching source row; other source rows are ignored.

    Two source rows for one target row are an error, as in a MERGE statement.
    """
    kinds = dict(target.dtypes)
    joined = target.join(_tagged(source.select(*keys, *columns), keys, buckets), keys, "left")
    matched = F.col("_rows").isNotNull()
    return joined.select(
        *(_taken(c, matched, F.col(c), kinds[c]) if c in columns else F.col(c) for c in target.columns)
    )


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], buckets: int | None = None
) -> DataFrame:
    """Update matching rows and insert the source rows that match nothing.

    Two source rows for one target row are an error; repeated new keys are inserted as they are.
    """
    kinds = dict(target.dtypes)
    joined = target.withColumn("_known", F.lit(True)).join(
        _tagged(source, keys, buckets), keys, "full_outer"
    )
    known, fresh = F.col("_known").isNotNull(), F.col("_known").isNull()

    def pick(c: str) -> Column:
        if c in keys or c not in source.columns:
            return F.col(c)
        kept = F.when(fresh, F.col(f"_new_{c}")).otherwise(F.col(c))
        if c in columns:
            return _taken(c, known & F.col("_rows").isNotNull(), kept, kinds[c])
        return kept.alias(c)

    return joined.select(*(pick(c) for c in target.columns))


def upsert_latest(
    target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str], buckets: int | None = None
) -> DataFrame:
    """The newest row per key of target and source; at equal age the source row wins.

    ``target`` has one row per key. Only the source is reduced to its newest rows; the target is
    joined as it is.
    """
    order = [F.col(c).desc() for c in order_by]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    newest = _dealt(source.select(*target.columns), keys, buckets).withColumn("_n", first).filter("_n = 1").drop("_n")
    rest = [c for c in target.columns if c not in keys]
    new = newest.select(*keys, F.struct(*rest).alias("_new"))
    joined = target.withColumn("_old", F.struct(*rest)).join(new, keys, "full_outer")
    newer = F.struct(*(F.col(f"_new.{c}") for c in order_by)) >= F.struct(*(F.col(f"_old.{c}") for c in order_by))
    chosen = F.when(F.col("_new").isNull() | (F.col("_old").isNotNull() & ~newer), F.col("_old"))
    picked = joined.select(*keys, chosen.otherwise(F.col("_new")).alias("_row"))
    return picked.select(*keys, "_row.*").select(*target.columns)


def update_where(target: DataFrame, predicate: Column, changes: dict[str, Column]) -> DataFrame:
    """``UPDATE target SET .. WHERE predicate``."""
    return target.select(
        *(
            F.when(predicate, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in target.columns
        )
    )


def first_rows(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def cdc_apply(
    target: DataFrame, changes: DataFrame, keys: list[str], order_by: list[str], op: str = "op"
) -> DataFrame:
    """Apply insert, update and delete changes in order; only the last one per key counts."""
    last = latest_per_key(changes, keys, order_by).select(
        *keys,
        F.col(op).alias("_op"),
        *(F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys),
    )
    joined = target.join(last, keys, "full_outer").filter(
        F.coalesce(F.lower("_op") != "delete", F.lit(True))
    )
    return joined.select(
        *(
            F.col(c)
            if c in keys
            else F.when(F.col("_op").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        )
    )


def scd2(versions: DataFrame, keys: list[str], valid_from: str, order: list[str]) -> DataFrame:
    """History rows with ``valid_to`` and ``is_current``.

    A version ends where the next one of its key begins. A long history is cut into pieces along
    ``order`` (see :mod:`tidemark.operators.segments`).
    """
    rows = G.segmented(versions, keys, order, keep=[valid_from], reverse=True)
    following = G.earlier_value(valid_from, G.inside(order, reverse=True))
    return (
        rows.withColumn("valid_to", following)
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("_segment", "_before")
    )


def compact(df: DataFrame, rows_per_file: int, total_rows: int) -> DataFrame:
    """Fewer, larger files: about ``rows_per_file`` rows in each."""
    return df.repartition(max(1, -(-total_rows // rows_per_file)))
