"""Streams fed by several files equal the batch result; repeated batches change nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents as D
from tidemark.plans import documents as P
from tidemark.session import new_folder
from tidemark.streaming import jobs as J


@pytest.fixture(scope="module")
def feed(spark, small):
    """The documents, in offset order, as five files."""
    path = new_folder(spark, "feed")
    documents = spark.read.parquet(f"{small}/documents.parquet")
    for part in range(5):
        documents.filter(F.floor(F.col("doc_id") / 40) == part).coalesce(1).write.mode(
            "append"
        ).parquet(path)
    assert spark.read.parquet(path).count() == documents.count()
    return path, documents


def stream(spark, feed):
    return P.raw_events(J.file_stream(spark, feed[0], feed[1].schema, files_per_batch=1))


def listed(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_split_equals_batch(spark, feed):
    path, checkpoint = new_folder(spark, "checked"), new_folder(spark, "c")
    J.run_available(J.split_stream(stream(spark, feed), path, checkpoint, P.MIN_CHARS))
    valid, letters = D.normalize(P.raw_events(feed[1]), P.MIN_CHARS)
    good, dead = J.split_batches(spark, path)
    assert listed(good) == listed(valid)
    assert listed(dead) == listed(letters)
    assert spark.read.parquet(path).select("batch").distinct().count() == 5


def test_a_repeated_batch_replaces_itself(spark):
    path = new_folder(spark, "again")
    for _ in range(2):
        J.write_batch(spark.range(7).toDF("n"), path, 3)
    assert spark.read.parquet(path).count() == 7


def test_state_equals_batch_in_any_order(spark, feed):
    path = new_folder(spark, "state")
    valid, _ = D.normalize(stream(spark, feed), P.MIN_CHARS)
    J.run_available(J.state_stream(valid, path, new_folder(spark, "c")))
    expected = listed(D.compacted(D.normalize(P.raw_events(feed[1]), P.MIN_CHARS)[0]))
    assert listed(J.latest_state(spark, path)) == expected
    # all over again from a new checkpoint: older offsets do not come back
    J.run_available(J.state_stream(valid, path, new_folder(spark, "c")))
    assert listed(J.latest_state(spark, path)) == expected


def test_dedup_stream_equals_batch(spark, feed):
    path, checkpoint = new_folder(spark, "dedup"), new_folder(spark, "c")
    valid, _ = D.normalize(stream(spark, feed), P.MIN_CHARS)
    live = valid.filter(~F.col("tombstone"))
    J.run_available(J.dedup_stream(live, ["event_id"], ["document_id"], path, checkpoint))
    batch = D.dedup_events(D.normalize(P.raw_events(feed[1]), P.MIN_CHARS)[0], ["document_id"])
    found = J.first_events(spark, path, ["event_id"], ["document_id"])
    assert listed(found.select(batch.columns)) == listed(batch)


def test_index_forgets_old_versions_and_deleted_documents(spark):
    def event(key, offset, text):
        return (key, offset, text is None, text)

    schema = "document_id STRING, offset LONG, tombstone BOOLEAN, text STRING"
    source, path = new_folder(spark, "in"), new_folder(spark, "index")
    for rows in ([event("a", 1, "old words"), event("b", 2, "kept")], [event("a", 4, "new words")], [event("c", 3, "gone"), event("c", 5, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    feed = J.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    J.run_available(J.index_stream(feed, path, new_folder(spark, "c")))
    found = {(r.term, r.document_id, r.tf) for r in J.current_index(spark, path).collect()}
    assert found == {("new", "a", 1), ("words", "a", 1), ("kept", "b", 1)}


def test_groups_read_independently(spark, feed):
    """Two jobs on one stream, each with its checkpoint; a second run finds nothing new."""
    first, second = new_folder(spark, "one"), new_folder(spark, "two")
    checkpoint = new_folder(spark, "c")
    J.run_available(J.to_lake(stream(spark, feed), first, checkpoint, ["topic"]))
    J.run_available(J.to_lake(stream(spark, feed), second, new_folder(spark, "c"), ["topic"]))
    J.run_available(J.to_lake(stream(spark, feed), first, checkpoint, ["topic"]))
    count = feed[1].count()
    assert spark.read.parquet(first).count() == spark.read.parquet(second).count() == count


def test_window_totals_count_every_row_in_any_order(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    source = new_folder(spark, "events")
    for part in (3, 0, 2, 1):  # the latest events come first
        events.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == part).coalesce(1).write.mode("append").parquet(source)
    path = new_folder(spark, "totals")
    feed = J.file_stream(spark, source, events.schema, files_per_batch=1).select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id"
    )
    history = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("seen"))
    J.run_available(J.window_stream(feed, ["event_type"], "ts", "event_id", "1 day", path, new_folder(spark, "c")))
    found = J.window_totals(spark, path, ["event_type"], history)
    assert found.agg(F.sum("n")).first()[0] == events.count()
    batch = (
        events.groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))
        .join(history, "event_type")
        .select("w", "event_type", "n", "total", "seen")
    )
    assert listed(found.select("window_start", "event_type", "n", "total", "seen")) == listed(batch)


def test_order_within_keys(spark, feed):
    ordered = D.in_key_order(P.raw_events(feed[1]), "key", "offset", 6)
    rows = ordered.select("key", "offset").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)


def test_replay_keeps_what_cannot_be_repaired(spark):
    raw = spark.createDataFrame(
        [("t", "k1", "plain words", 1), ("t", "k2", '{"event_id":"e"}', 2), ("t", "k3", "", 3),
         ("t", "k4", None, 4), ("t", "k5", '{"event_id":"x","document_id":"d","version":1,"text":" "}', 5)],
        "topic STRING, key STRING, value STRING, offset BIGINT",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    valid, dead = D.normalize(raw)
    assert sorted((r.offset, r.reason) for r in dead.collect()) == [
        (1, D.MALFORMED),
        (2, D.MISSING_FIELD),
        (3, D.MALFORMED),
        (5, D.EMPTY_TEXT),
    ]
    assert [(r.document_id, r.tombstone) for r in valid.collect()] == [("k4", True)]
    again, still = D.replay(valid, dead)
    assert sorted((r.document_id, r.version) for r in again.collect() if not r.tombstone) == [
        ("k1", 0),
        ("k2", 0),
    ]
    assert sorted(r.offset for r in still.collect()) == [3, 5]


def test_cover_is_short():
    from tidemark.streaming.parts import BASE, cover

    for n in range(1, 1025):
        found = cover(n)
        ends = [first + BASE**level for level, first in found]
        assert [first for _, first in found] == [0, *ends[:-1]] and ends[-1] == n
        assert len(found) <= 12 if n <= 100 else len(found) <= 16


def test_parts_are_merged_and_a_repeated_batch_changes_nothing(spark):
    from tidemark.streaming.parts import add_part, cover, folders, parts

    path = new_folder(spark, "parts")

    def total(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    def batch(i):
        return total(spark.createDataFrame([(k, i) for k in range(3)], "k INT, n LONG").coalesce(1))

    for i in range(17):
        add_part(batch(i), path, i, total)
        assert len(folders(spark, path)) == len(cover(i + 1)) <= 6
    expected = [(k, sum(range(17))) for k in range(3)]
    assert sorted(map(tuple, total(parts(spark, path)).collect())) == expected
    for i in (15, 16, 3):  # again, as after a failure, and from an older checkpoint
        add_part(batch(i), path, i, total)
        assert sorted(map(tuple, total(parts(spark, path)).collect())) == expected


def test_episodes_over_batches_in_any_order(spark):
    import random
    from datetime import datetime, timedelta

    from tidemark.streaming.episodes import episode_stream, episodes

    rng = random.Random(4)
    rows = [(rng.choice((1, 1, 1, 2, 3)), i, datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(4000)), rng.choice("abc")) for i in range(300)]
    schema = "user INT, id LONG, ts TIMESTAMP, kind STRING"
    path = new_folder(spark, "shuffled")
    rng.shuffle(rows)
    for at in range(0, 300, 100):  # some events arrive twice
        spark.createDataFrame(rows[at : at + 120], schema).coalesce(1).write.mode("append").parquet(path)
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "c")
    stream_ = J.file_stream(spark, path, spark.createDataFrame(rows[:1], schema).schema, files_per_batch=1)
    job = J.run_available(episode_stream(stream_, "user", "id", "ts", "kind", ["a", "b", "c"], 30, out, checkpoint))
    assert len([p for p in job.recentProgress if p["numInputRows"]]) == 3
    expected = D.sequence_episodes(spark.createDataFrame(rows, schema).withColumnRenamed("id", "event_id"), "user", "ts", "kind", ["a", "b", "c"], 30)
    assert listed(episodes(spark, out, "user")) == listed(expected) != []


def test_rows_of_a_crashed_batch_are_not_there_until_it_is_committed(spark, feed):
    from tidemark.streaming import publish as U

    path, checkpoint = new_folder(spark, "published"), new_folder(spark, "c")
    events, seen = stream(spark, feed), []

    def work(batch):
        if len(seen) == 2:
            seen.append("crash")
            U.write_rows(batch.select("topic", "offset"), path, 2)  # written, never committed
            raise RuntimeError("lost")
        seen.append("done")
        return batch.select("topic", "offset")

    with pytest.raises(Exception, match="lost"):
        J.run_available(U.publish_stream(events, path, checkpoint, work))
    assert U.commits(spark, path).select("batch").distinct().count() == 2
    committed = U.committed(spark, path).count()
    assert committed == U.commits(spark, path).agg(F.sum("rows")).first()[0] < spark.read.parquet(f"{path}/rows").count()
    J.run_available(U.publish_stream(events, path, checkpoint, work))
    everything = P.raw_events(feed[1])
    assert U.committed(spark, path).count() == everything.count() == U.commits(spark, path).agg(F.sum("rows")).first()[0]
    # another group starts from the beginning, with its own checkpoint
    other = new_folder(spark, "other")
    J.run_available(U.publish_stream(events, other, new_folder(spark, "c"), lambda batch: batch.filter("value IS NULL")))
    assert U.committed(spark, other).count() == everything.filter("value IS NULL").count()
