"""Windows over keys of any size.

A window partitioned by a key alone puts a whole key into one task. Here a key with more than ``rows``
rows is cut into segments of about that many along its order, at borders taken from a sample of its
rows; windows run per segment, and what crosses a border (the last rows and the totals of the segments
before) comes from a summary with one row per segment. Rows are read once and exchanged once, by key
and segment; the summary is made from the same exchange, and goes back to the rows by a join that
leaves them where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.session import stored

#: Rows of a segment, about; and how many of them a sample holds.
ROWS, SAMPLED = 1 << 20, 32


def _sorted_by(order: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc_nulls_first() if reverse else F.col(c).asc() for c in order]


def borders(df: DataFrame, keys: list[str], order: list[str], rows: int = ROWS) -> DataFrame | None:
    """(keys, ``_borders``): values of ``order[0]`` that cut each key of more than ``rows`` rows.

    None if there is no such key. Only keys and order columns are read: counts are summed before the
    shuffle, then every ``rows / SAMPLED``-th row of the large keys, by a digest, is put in order.
    """
    small = df.select(*dict.fromkeys([*keys, *order]))
    hot = stored(small.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows).drop("_rows"), "hot-keys")
    if hot.isEmpty():
        return None
    step = max(1, rows // SAMPLED)
    sample = small.where(F.col(order[0]).isNotNull() & (F.pmod(F.xxhash64(*small.columns), F.lit(step)) == 0))
    own = sample.join(hot.select(F.struct(*keys).alias("_hot")), F.struct(*keys) == F.col("_hot"), "left_semi")
    placed = own.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    cuts = placed.where(F.col("_place") % max(1, rows // step) == 0)
    return stored(cuts.groupBy(*keys).agg(F.sort_array(F.collect_set(order[0])).alias("_borders")), "borders")


def with_segment(df: DataFrame, keys: list[str], order: list[str], rows: int = ROWS) -> DataFrame:
    """Adds ``_segment``: the keys, and the number of the segment, which grows along ``order[0]``.

    Rows that are equal in ``order[0]`` share a segment, nulls are in the first one.
    """
    cut = borders(df, keys, order, rows)
    if cut is None:
        return df.withColumn("_segment", F.struct(*keys, F.lit(0).alias("_n")))
    along = F.col(order[0])
    below = F.size(F.filter("_borders", lambda border: border <= along))
    number = F.when(F.col("_borders").isNull() | along.isNull(), 0).otherwise(below)
    found = df.join(cut.select(F.struct(*keys).alias("_hot"), "_borders"), F.struct(*keys) == F.col("_hot"), "left")
    return found.withColumn("_segment", F.struct(*keys, number.alias("_n"))).drop("_hot", "_borders")


def segmented(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    keep: list[str] | None = None,
    tail: int = 1,
    totals: dict[str, Column] | None = None,
    reverse: bool = False,
    rows: int = ROWS,
) -> DataFrame:
    """Add ``_segment`` and ``_before``: what precedes the segment within its key.

    ``_before.rows`` counts the rows, ``_before.tail`` holds the last ``tail`` of them (columns
    ``keep``, oldest first) and ``_before.<name>`` sums each of ``totals``, aggregates of a segment.
    ``order`` has to be unique within a key. With ``reverse`` everything runs from the last row to
    the first. Give only columns that are used afterwards: the rows and the summary share one reading
    and one exchange as long as both need the same columns.
    """
    keep = keep or []
    totals = totals or {}
    columns = df.columns
    dealt = with_segment(df, keys, order, rows).repartition("_segment")
    # the summary asks for whole rows, so that it reads the very exchange that the rows come from
    whole, by = F.struct(*(F.col(f"`{c}`") for c in columns)), F.struct(*order)
    measures = [F.count(F.lit(1)).alias("_rows"), *(value.alias(f"_sum_{name}") for name, value in totals.items())]
    if tail == 1:
        pick = F.min_by if reverse else F.max_by
        summary = dealt.groupBy("_segment").agg(*measures, F.array(pick(whole, by)).alias("_tail"))
    else:
        place = F.row_number().over(Window.partitionBy("_segment").orderBy(*_sorted_by(order, not reverse)))
        last = F.when(F.col("_place") <= tail, F.struct((-F.col("_place")).alias("p"), whole.alias("r")))
        placed = dealt.withColumn("_place", place)
        summary = placed.groupBy("_segment").agg(*measures, F.sort_array(F.collect_list(last)).alias("_picked"))
        summary = summary.withColumn("_tail", F.transform("_picked", lambda x: x["r"])).drop("_picked")
    own = [F.col(f"_segment.`{k}`") for k in keys]
    number = F.col("_segment._n")
    earlier = Window.partitionBy(*own).orderBy(number.desc() if reverse else number).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("rows")]
    before += [F.sum(f"_sum_{name}").over(earlier).alias(name) for name in totals]
    if keep:
        near = F.flatten(F.collect_list("_tail").over(earlier.rowsBetween(-tail, -1)))
        kept = F.slice(near, F.greatest(F.size(near) - tail, F.lit(0)) + 1, F.lit(tail))
        before.append(F.transform(kept, lambda r: F.struct(*(r[c].alias(c) for c in keep))).alias("tail"))
    ahead = summary.select("_segment", F.struct(*before).alias("_before"))
    # one row per segment: a hash table of them is smaller than the segment's partition, and its rows need no sort for the join
    return dealt.join(ahead.hint("shuffle_hash"), "_segment")


def inside(order: list[str], reverse: bool = False) -> WindowSpec:
    """The window that matches :func:`segmented`."""
    return Window.partitionBy("_segment").orderBy(*_sorted_by(order, reverse))


def earlier_value(name: str, window: WindowSpec, distance: int = 1) -> Column:
    """``name`` of the row ``distance`` places before, across segment borders."""
    tail = F.col("_before.tail")
    missing = F.lit(distance) - F.row_number().over(window)
    index = F.size(tail) - 1 - missing
    carried = F.when(index >= 0, F.get(tail, index).getField(name))
    return F.when(F.row_number().over(window) > distance, F.lag(name, distance).over(window)).otherwise(
        carried
    )


def running_total(name: str, value: Column, window: WindowSpec) -> Column:
    so_far = F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(F.col(f"_before.{name}"), F.lit(0)) + so_far


def position(window: WindowSpec) -> Column:
    return (F.col("_before.rows") + F.row_number().over(window)).cast("bigint")


def rank_position(by: list[str], reverse: bool = False) -> Column:
    """``rank`` by the columns ``by``; rows equal in them must share a segment."""
    return (F.col("_before.rows") + F.rank().over(inside(by, reverse))).cast("bigint")


def dense_rank_position(name: str, by: list[str], reverse: bool = False) -> Column:
    """``dense_rank`` by ``by``; ``name`` is the total of their distinct values."""
    return (F.coalesce(F.col(f"_before.{name}"), F.lit(0)) + F.dense_rank().over(inside(by, reverse))).cast("bigint")
