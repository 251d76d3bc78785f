"""Document events: validation, state, history, references and the term index.

All functions take batch or streaming frames unless they say otherwise; raw events are
``(topic, key, value, timestamp, partition, offset)`` and a null value is a tombstone.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import terms_of
from tidemark.operators import segments as G
from tidemark.operators.keyed import scd2
from tidemark.operators.relational import latest_per_key

PAYLOAD = (
    "event_id STRING, document_id STRING, case_id STRING, base_document_id STRING,"
    " version BIGINT, text STRING"
)
MALFORMED = "malformed payload"
MISSING_FIELD = "missing field"
EMPTY_TEXT = "empty text"

# Days that each stream keeps its events.
RETENTION_DAYS = {
    "docs.law.raw.v1": 7,
    "docs.court.raw.v1": 7,
    "docs.edition.raw.v1": 7,
    "docs.normalized.v1": 30,
    "docs.edition-events.v1": 180,
    "docs.references.v1": 90,
    "docs.dlq.v1": 30,
}


def union_topics(raws: list[DataFrame]) -> DataFrame:
    """Several raw streams as one; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), raws)


def checked(raw: DataFrame, min_chars: int = 1) -> DataFrame:
    """Parse the payload and give ``reason``: null for a valid event or tombstone."""
    body = F.col("_body")
    known = F.coalesce("_body.document_id", "_body.case_id", "_body.base_document_id")
    fields = body.getField("event_id").isNotNull() & known.isNotNull() & body.getField(
        "version"
    ).isNotNull()
    reason = (
        F.when(F.col("value").isNull(), None)
        .when(body.getField("_corrupt").isNotNull() | ~F.trim("value").startswith("{"), MALFORMED)
        .when(~fields, MISSING_FIELD)
        .when(F.length(F.trim(F.coalesce(body.getField("text"), F.lit("")))) < min_chars, EMPTY_TEXT)
    )
    schema = PAYLOAD + ", _corrupt STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    verdict = F.struct(
        reason.alias("reason"),
        F.coalesce(known, F.col("key")).alias("document_id"),
        *(body.getField(c).alias(c) for c in ("event_id", "version", "text")),
    )
    # generating the verdict keeps filters on it from parsing the payload again
    return raw.withColumn("_body", F.from_json("value", schema, options)).select(
        *raw.columns, F.inline(F.array(verdict))
    )


def valid_events(checked_events: DataFrame) -> DataFrame:
    """One schema for all topics; tombstones keep a null ``event_id``."""
    return checked_events.filter(F.col("reason").isNull()).select(
        "topic",
        "document_id",
        "event_id",
        "version",
        "text",
        "timestamp",
        "offset",
        F.col("value").isNull().alias("tombstone"),
    )


def dead_letters(checked_events: DataFrame) -> DataFrame:
    return checked_events.filter(F.col("reason").isNotNull()).select(
        F.sha2("value", 256).alias("error_hash"), "topic", "key", "value", "reason", "timestamp", "offset"
    )


def normalize(raw: DataFrame, min_chars: int = 1) -> tuple[DataFrame, DataFrame]:
    """Raw events to (valid, dead)."""
    seen = checked(raw, min_chars)
    return valid_events(seen), dead_letters(seen)


def repair(dead: DataFrame) -> DataFrame:
    """Raw events again: loose text is wrapped as a payload, a missing version becomes zero."""
    wrapped = F.to_json(
        F.struct(
            F.col("error_hash").alias("event_id"),
            F.col("key").alias("document_id"),
            F.lit(0).cast("bigint").alias("version"),
            F.col("value").alias("text"),
        )
    )
    fields = F.from_json("value", PAYLOAD)
    completed = F.to_json(
        F.struct(
            F.coalesce(fields["event_id"], F.col("error_hash")).alias("event_id"),
            F.coalesce(
                fields["document_id"], fields["case_id"], fields["base_document_id"], F.col("key")
            ).alias("document_id"),
            F.coalesce(fields["version"], F.lit(0).cast("bigint")).alias("version"),
            F.coalesce(fields["text"], F.lit("(no text)")).alias("text"),
        )
    )
    value = (
        F.when(F.col("reason") == MALFORMED, wrapped)
        .when(F.col("reason") == MISSING_FIELD, completed)
        .otherwise(F.col("value"))
    )
    return dead.select("topic", "key", value.alias("value"), "timestamp", "offset")


def replay(
    valid: DataFrame, dead: DataFrame, fix: Callable[[DataFrame], DataFrame] = repair, min_chars: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Put repaired dead letters back; what is still invalid stays dead."""
    again, still = normalize(fix(dead), min_chars)
    return valid.unionByName(again), still


def first_per(df: DataFrame, keys: list[str], order_by: str, keep: list[str]) -> DataFrame:
    """The earliest row per key, with columns ``keep``; copies are dropped before the shuffle."""
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(order_by, *keep), order_by).alias("_first"))
        .select(*keys, "_first.*")
    )


def dedup_events(valid: DataFrame, keep: list[str]) -> DataFrame:
    """One row per ``event_id``, the first by offset (batch)."""
    return first_per(valid.filter(~F.col("tombstone")), ["event_id"], "offset", keep)


def dedup_versions(valid: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document and version, the first by offset (batch)."""
    return first_per(valid.filter(~F.col("tombstone")), ["document_id", "version"], "offset", keep)


def compacted(valid: DataFrame) -> DataFrame:
    """The last event per document, tombstones included (batch)."""
    return latest_per_key(valid, ["document_id"], ["offset"])


def current_state(valid: DataFrame) -> DataFrame:
    """The last event per document; a tombstone removes the document (batch)."""
    return compacted(valid).filter(~F.col("tombstone"))


def edition_history(valid: DataFrame) -> DataFrame:
    """Versions of each document with the time each was in force (batch)."""
    rows = valid.filter(~F.col("tombstone")).select(
        "document_id", "version", "offset", F.col("timestamp").alias("valid_from")
    )
    return scd2(rows, ["document_id"], "valid_from", ["version", "offset"])


# How links, court cases and acts are written in a text.
REFERENCES = {
    "link": 'href="([^"]*)"',
    "case": r"([A-ZА-Я][0-9]{1,3}-[0-9]+/[0-9]{4})",
    "act": r"№ ?([0-9]+-[A-ZА-Я]+)",
}


def references(pages: DataFrame, key: str, text: str) -> DataFrame:
    """(source, kind, target) for every link, cited case and cited act in ``text``."""

    def found(kind: str, pattern: str) -> Column:
        targets = F.regexp_extract_all(F.col(text), F.lit(pattern), 1)
        return F.transform(targets, lambda target: F.struct(F.lit(kind).alias("kind"), target.alias("target")))

    return pages.select(F.col(key).alias("source_document_id"), F.inline(F.concat(*(found(k, p) for k, p in REFERENCES.items()))))


def inverted_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, document, term frequency); counted inside each task before the shuffle."""
    return (
        docs.select(F.col(key).alias("doc_id"), F.explode(terms_of(F.col(text))).alias("term"))
        .filter("term <> ''")  # on rows, in generated code, rather than inside the array
        .groupBy("term", "doc_id")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def apply_retention(df: DataFrame, now: datetime | Column, days: int | Column) -> DataFrame:
    """Keep what is not older than ``days`` at ``now``."""
    moment = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    span = days if isinstance(days, Column) else F.lit(days)
    return df.filter(F.col("timestamp") >= moment - F.make_dt_interval(span))


def days_of(topic: Column) -> Column:
    """Retention days of a topic; null for a topic without a rule."""
    entries = [x for k, v in RETENTION_DAYS.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*entries), topic)


def compact_delete(valid: DataFrame, now: datetime, days: int) -> DataFrame:
    """Compaction and time retention together (batch)."""
    return apply_retention(compacted(valid), now, days)


def in_key_order(df: DataFrame, key: str, order: str, partitions: int | None = None) -> DataFrame:
    """Rows of a key one after the other, by ``order``; a large key spans several tasks (batch)."""
    ranged = (
        df.repartitionByRange(partitions, key, order)
        if partitions
        else df.repartitionByRange(key, order)
    )
    return ranged.sortWithinPartitions(key, order)


def consumer_lag(events: DataFrame, committed: DataFrame) -> DataFrame:
    """End offset minus committed offset per topic and partition (batch)."""
    keys = ["topic", "partition"]
    ends = events.groupBy(*keys).agg(F.max("offset").alias("end_offset"))
    return ends.join(committed, keys, "left").select(
        *keys, (F.col("end_offset") - F.coalesce("committed_offset", F.lit(-1))).alias("lag")
    )


def sequence_episodes(
    events: DataFrame,
    key: str,
    moment: str,
    state: str,
    pattern: list[str],
    max_gap_seconds: int,
) -> DataFrame:
    """Runs of consecutive events of a key that spell ``pattern`` without a longer pause (batch)."""
    steps = len(pattern) - 1
    order = [moment, "event_id"]
    rows = G.segmented(
        events.select(key, "event_id", moment, state),
        [key],
        order,
        keep=[moment, state],
        tail=steps,
    )
    window = G.inside(order)
    columns = {}
    for i in range(1, steps + 1):
        columns[f"_state{i}"] = G.earlier_value(state, window, i)
        columns[f"_time{i}"] = G.earlier_value(moment, window, i)
    rows = rows.withColumns(columns)
    found = F.col(state) == pattern[-1]
    later = F.unix_micros(F.col(moment).cast("timestamp"))
    for i in range(1, steps + 1):
        earlier = F.unix_micros(F.col(f"_time{i}").cast("timestamp"))
        found = found & (F.col(f"_state{i}") == pattern[-1 - i])
        found = found & (later - earlier <= max_gap_seconds * 1_000_000)
        later = earlier
    return rows.filter(found).select(
        key,
        F.col(f"_time{steps}").alias("started_at"),
        F.col(moment).alias("finished_at"),
        F.col("event_id").alias("last_event_id"),
    )
