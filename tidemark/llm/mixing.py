"""Mixing sources to target weights by nested hash thresholds.

Every row has a place in [0, 2**60) by the digest of its key. A source takes whole rounds of its
rows as often as its target allows, and of the last, partial round the rows below a threshold. The
threshold comes from histograms: tokens are summed by source and hash bucket, the bucket in which
the running sum passes the budget is the only one refined, by the next bits, until the bits are
used up; rows are then filtered by comparing a hash with a number. Nothing is sorted, and a larger
budget always takes what a smaller one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, whole_row
from tidemark.llm.sharding import digest60
from tidemark.session import stored

#: Bits of the hash, and bits that one histogram resolves.
HASH_BITS, STEP_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """``source, source_size`` with ``target``.

    Sources in code point order, null last, get ``weights`` in turn and share ``share`` times all
    tokens by weight; a target stops at ``limit`` times its source, and what is over is shared again
    by weight until none is above. Works on one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("_w", F.element_at(F.lit(list(weights)), (turn + 1).cast("int")).cast("long"))
    # By fullness a source reaches its limit in this order; after each one the others share the rest.
    filling = everything.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    after = (
        weighed.withColumn("_all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("_capped", F.coalesce(F.sum("source_size").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_left", F.sum("_w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_each", (F.col("_all") - limit * F.col("_capped")) / F.col("_left"))
    )
    # The first source that stays below its limit sets the level for all that follow.
    level = F.min(F.when(F.col("source_size") * limit > F.col("_each") * F.col("_w"), F.struct("_capped", "_each"))).over(everything)
    leveled = after.withColumn("_level", level["_each"])
    target = F.least(F.col("_level") * F.col("_w"), (F.col("source_size") * limit).cast("double"))
    return leveled.select("source", "source_size", F.coalesce(target, (F.col("source_size") * limit).cast("double")).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, below`` for each source of ``budgets`` (``source, budget``; 0 < budget < its size).

    Rows (``source, hash, size``) with a hash under ``below`` sum up to no more than the budget, or
    to the nearest sum above if that is closer; rows of one hash go together.
    """
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("taken"))
    left = HASH_BITS
    while left:
        left -= STEP_BITS
        state = stored(state, "budgets").alias("b")
        bucket = F.shiftright("r.hash", left)
        in_reach = F.shiftright("r.hash", left + STEP_BITS) == F.shiftright("b.begin", left + STEP_BITS)
        if left + STEP_BITS == HASH_BITS:
            in_reach = F.lit(True)
        histogram = (
            rows.alias("r")
            .join(state, F.col("r.source").eqNullSafe(F.col("b.source")) & in_reach)
            .groupBy("b.source", "budget", "taken", bucket.alias("bucket"))
            .agg(F.sum("r.size").alias("tokens"))
        )
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        passing = histogram.withColumn("total", F.col("taken") + F.sum("tokens").over(run)).where("total > budget")
        first = F.min(F.struct("bucket", (F.col("total") - F.col("tokens")).alias("taken"), "total")).alias("first")
        state = passing.groupBy("source", "budget").agg(first).select(
            "source", "budget", F.shiftleft("first.bucket", left).alias("begin"), F.col("first.taken").alias("taken"), F.col("first.total").alias("total")
        )
        if left:
            state = state.drop("total")
    closer = F.col("total") - F.col("budget") < F.col("budget") - F.col("taken")
    return state.select("source", (F.col("begin") + closer.cast("long")).alias("below"))


def mix_plan(rows: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """``source, source_size, target, rounds, below``: each row of a source is taken ``rounds``
    times, and once more if its hash is under ``below``.

    ``rows``: ``source, hash, size``, sizes not null. One row per source, written to the shared
    folder, so that joins with it are planned by its true size.
    """
    sources = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aims = targets(sources, weights, share, limit)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = stored(aims.withColumn("rounds", rounds.cast("int")).withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size")), "aims")
    cuts = thresholds(rows, aims.where("budget > 0").select("source", "budget")).alias("c")
    joined = aims.alias("a").join(cuts, F.col("a.source").eqNullSafe(F.col("c.source")), "left")
    return stored(joined.select("a.source", "source_size", "target", "rounds", F.coalesce("below", F.lit(0)).alias("below")), "mix")


def planned(rows: DataFrame, plan: DataFrame, source: str = "source", hash_column: str = "hash") -> DataFrame:
    """All ``rows`` with ``source_size``, ``target`` and ``times``: how often the mix takes a row."""
    p = plan.select(F.col("source").alias("_source"), "source_size", "target", "rounds", "below")
    joined = rows.join(p, F.col(source).eqNullSafe(F.col("_source")))
    return joined.withColumn("times", F.col("rounds") + (F.col(hash_column) < F.col("below")).cast("int")).drop("_source", "rounds", "below")


def mixed(
    docs: DataFrame, weights: tuple[int, ...], share: float, limit: int, id_column: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with their own columns, repeated ones as often.

    A row's size is its number of words. Its hash comes from its id and text, so that equal rows go
    together; a null id, text or source is a value like any other.
    """
    place = digest60(F.col(id_column), F.crc32(F.col(text).cast("binary"))).alias("hash")
    rows = docs.select(whole_row(docs), F.col(source).alias("source"), place, word_count(F.col(text)).alias("size"))
    sizes = stored(rows.select("source", "hash", "size"), "sizes")
    taken = planned(rows, mix_plan(sizes, weights, share, limit)).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
