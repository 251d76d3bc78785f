"""Document-event queries; raw events are the documents under three topics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators import documents as D
from tidemark.plans.catalog import query
from tidemark.session import new_folder, stored
from tidemark.sources.tables import Tables
from tidemark.streaming import jobs as J
from tidemark.streaming.episodes import episode_stream, episodes
from tidemark.streaming.publish import commits, committed, publish_stream

NOW = datetime(2024, 7, 19)
MIN_CHARS = 20
TOPICS = ["docs.law.raw.v1", "docs.court.raw.v1", "docs.edition.raw.v1"]


def raw_events(documents: DataFrame) -> DataFrame:
    """Documents as keyed messages, some broken and some tombstones; works on streams too."""
    n = F.col("doc_id")
    topic = F.get(F.array(*(F.lit(t) for t in TOPICS)), (n % 3).cast("int"))
    key = F.when(n % 3 == 2, F.concat(F.lit("B-"), "source")).otherwise(
        F.concat(F.lit("D-"), F.floor(n / 12))
    )
    digest = F.sha2("text", 256)
    fields = [
        F.col("_digest").alias("event_id"),
        F.when(n % 3 == 0, F.col("key")).alias("document_id"),
        F.when(n % 3 == 1, F.col("key")).alias("case_id"),
        F.when(n % 3 == 2, F.col("key")).alias("base_document_id"),
        n.alias("version"),
        F.col("text"),
    ]
    value = (
        F.when(n % 40 == 13, None)
        .when(n % 50 == 7, F.col("text"))
        .when(n % 50 == 9, F.format_string('{"event_id":"%s"}', "_digest"))
        .otherwise(F.to_json(F.struct(*fields)))
    )
    minutes = (n * 7919) % (200 * 1440)
    moment = F.timestamp_seconds(F.lit(1704067200) + minutes * 60)
    return (
        documents.withColumns({"key": key, "_digest": digest})
        .select(
            topic.alias("topic"),
            "key",
            value.alias("value"),
            moment.alias("timestamp"),
            (n % 12).cast("int").alias("partition"),
            n.alias("offset"),
        )
    )


RAW = f"""
    e AS (SELECT doc_id AS "offset", doc_id AS version, text, sha256(text) AS digest,
                 ['docs.law.raw.v1', 'docs.court.raw.v1', 'docs.edition.raw.v1'][doc_id % 3 + 1] AS topic,
                 CASE WHEN doc_id % 3 = 2 THEN 'B-' || source ELSE 'D-' || (doc_id // 12) END AS key,
                 TIMESTAMP '2024-01-01' + to_minutes((doc_id * 7919) % (200 * 1440)) AS ts,
                 CAST(doc_id % 12 AS INTEGER) AS part,
                 doc_id % 40 = 13 AS tombstone,
                 CASE WHEN doc_id % 40 = 13 THEN NULL
                      WHEN doc_id % 50 = 7 THEN '{D.MALFORMED}'
                      WHEN doc_id % 50 = 9 THEN '{D.MISSING_FIELD}'
                      WHEN length(trim(text, ' ')) < {MIN_CHARS} THEN '{D.EMPTY_TEXT}' END AS reason
          FROM documents),
    v AS (SELECT * FROM e WHERE reason IS NULL),
    live AS (SELECT * FROM v WHERE NOT tombstone)
"""


def documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text", "source")


def raw_topics(t: Tables) -> list[DataFrame]:
    raw = raw_events(documents(t))
    return [raw.filter(F.col("topic") == name) for name in TOPICS]


def valid(t: Tables) -> DataFrame:
    return D.normalize(raw_events(documents(t)), MIN_CHARS)[0]


@query(
    "normalize_union",
    f"""
    WITH {RAW}
    SELECT topic, key AS document_id, CASE WHEN NOT tombstone THEN version END AS version,
           CASE WHEN NOT tombstone THEN digest END AS event_id,
           CASE WHEN NOT tombstone THEN length(text) END AS chars, "offset", tombstone
    FROM v
    """,
)
def normalize_union(t: Tables) -> DataFrame:
    events, _ = D.normalize(D.union_topics(raw_topics(t)), MIN_CHARS)
    return events.select(
        "topic",
        "document_id",
        "version",
        "event_id",
        F.length("text").cast("bigint").alias("chars"),
        "offset",
        "tombstone",
    )


DLQ_SQL = f"""
    WITH {RAW}
    SELECT topic, reason, count(*) AS letters,
           count(DISTINCT CASE reason WHEN '{D.MALFORMED}' THEN digest
               WHEN '{D.MISSING_FIELD}' THEN sha256('{{"event_id":"' || digest || '"}}')
               ELSE concat_ws('/', digest, version) END) AS hashes,
           min(CASE reason WHEN '{D.MALFORMED}' THEN digest
               WHEN '{D.MISSING_FIELD}' THEN sha256('{{"event_id":"' || digest || '"}}') END) AS lowest
    FROM e WHERE reason IS NOT NULL GROUP BY 1, 2
"""


def _letters(dead: DataFrame) -> DataFrame:
    return dead.groupBy("topic", "reason").agg(
        F.count(F.lit(1)).alias("letters"),
        F.count_distinct("error_hash").alias("hashes"),
        F.min(F.when(F.col("reason") != D.EMPTY_TEXT, F.col("error_hash"))).alias("lowest"),
    )


@query("dlq_split", DLQ_SQL)
def dlq_split(t: Tables) -> DataFrame:
    return _letters(D.normalize(raw_events(documents(t)), MIN_CHARS)[1])


@query(
    "dlq_replay",
    f"""
    WITH {RAW},
    again AS (SELECT topic, key, "offset", CASE WHEN reason IS NULL AND NOT tombstone THEN version
                     WHEN reason = '{D.MALFORMED}' THEN 0 END AS version,
                     CASE WHEN reason = '{D.MISSING_FIELD}' OR reason = '{D.EMPTY_TEXT}'
                            OR (reason = '{D.MALFORMED}' AND length(trim(text, ' ')) < {MIN_CHARS})
                          THEN '{D.EMPTY_TEXT}' END AS still_dead
              FROM e)
    SELECT topic, key AS document_id, still_dead, count(*) AS events,
           CAST(sum(version) AS BIGINT) AS versions
    FROM again GROUP BY 1, 2, 3
    """,
)
def dlq_replay(t: Tables) -> DataFrame:
    good, dead = D.normalize(raw_events(documents(t)), MIN_CHARS)
    events, still = D.replay(good, dead, min_chars=MIN_CHARS)
    recovered = events.select("topic", "document_id", F.lit(None).cast("string").alias("still_dead"), "version")
    unable = still.select(
        "topic", F.col("key").alias("document_id"), F.col("reason").alias("still_dead"), F.lit(None).cast("bigint").alias("version")
    )
    return recovered.unionByName(unable).groupBy("topic", "document_id", "still_dead").agg(
        F.count(F.lit(1)).alias("events"), F.sum("version").alias("versions")
    )


@query(
    "dedup_events",
    f"""
    WITH {RAW}
    SELECT digest AS event_id, min("offset") AS "offset", arg_min(key, "offset") AS document_id
    FROM live GROUP BY 1
    """,
)
def dedup_events(t: Tables) -> DataFrame:
    return D.dedup_events(valid(t), ["document_id"])


@query(
    "dedup_versions",
    f"""
    WITH {RAW}
    SELECT key AS document_id, version % 5 AS version, min("offset") AS "offset",
           arg_min(digest, "offset") AS event_id FROM live GROUP BY 1, 2
    """,
)
def dedup_versions(t: Tables) -> DataFrame:
    folded = valid(t).withColumn("version", F.col("version") % 5)
    return D.dedup_versions(folded, ["event_id"])


@query(
    "current_state",
    f"""
    WITH {RAW}, l AS (SELECT key, max("offset") AS o FROM v GROUP BY 1)
    SELECT v.key AS document_id, version, digest AS event_id, length(text) AS chars
    FROM v JOIN l ON v.key = l.key AND v."offset" = l.o WHERE NOT tombstone
    """,
)
def current_state(t: Tables) -> DataFrame:
    return D.current_state(valid(t)).select(
        "document_id", "version", "event_id", F.length("text").cast("bigint").alias("chars")
    )


@query(
    "edition_history",
    f"""
    WITH {RAW}
    SELECT key AS document_id, version, epoch_us(ts) // 1000000 AS valid_from,
           epoch_us(lead(ts) OVER w) // 1000000 AS valid_to, lead(ts) OVER w IS NULL AS is_current
    FROM live WINDOW w AS (PARTITION BY key ORDER BY version, "offset")
    """,
)
def edition_history(t: Tables) -> DataFrame:
    return D.edition_history(valid(t)).select(
        "document_id",
        "version",
        F.unix_seconds("valid_from").alias("valid_from"),
        F.unix_seconds("valid_to").alias("valid_to"),
        "is_current",
    )


_FOUND = " UNION ALL ".join(
    f"SELECT page_id, '{kind}' AS kind, unnest(regexp_extract_all(body, '{pattern}', 1)) AS target FROM c"
    for kind, pattern in D.REFERENCES.items()
)


@query(
    "references",
    f"""
    WITH c AS (SELECT page_id, html || ' А' || (page_id % 90) || '-' || page_id || '/2020, № '
                      || (page_id % 400) || '-ФЗ' AS body FROM pages)
    SELECT page_id AS source_document_id, kind, target, count(*) AS links FROM ({_FOUND})
    GROUP BY 1, 2, 3
    """,
)
def references(t: Tables) -> DataFrame:
    """Links of the pages and, added to each page, a case and an act."""
    n = F.col("page_id")
    cited = F.concat("html", F.format_string(" А%d-%d/2020, № %d-ФЗ", n % 90, n, n % 400))
    return (
        D.references(t.pages.select("page_id", cited.alias("body")), "page_id", "body")
        .groupBy("source_document_id", "kind", "target")
        .agg(F.count(F.lit(1)).alias("links"))
    )


TERMS = r"""regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r.,;:!?()\[\]"''<>/=]+')"""


@query(
    "inverted_index",
    f"""
    SELECT term, doc_id, count(*) AS tf FROM (
      SELECT doc_id, unnest({TERMS}) AS term FROM documents)
    WHERE term <> '' GROUP BY 1, 2
    """,
)
def inverted_index(t: Tables) -> DataFrame:
    return D.inverted_index(t.documents.select("doc_id", "text"), "doc_id", "text")


@query(
    "retention",
    f"""
    WITH {RAW}, d AS (SELECT *, CASE "offset" % 4 WHEN 0 THEN 7 WHEN 1 THEN 30 WHEN 2 THEN 90
                             ELSE 180 END AS days,
                      ['docs.law.raw.v1', 'docs.normalized.v1', 'docs.references.v1',
                       'docs.edition-events.v1']["offset" % 4 + 1] AS stream FROM e)
    SELECT stream, count(*) AS events, CAST(min("offset") AS BIGINT) AS lowest FROM d
    WHERE ts >= TIMESTAMP '2024-07-19' - to_days(CAST(days AS INTEGER)) GROUP BY 1
    """,
)
def retention(t: Tables) -> DataFrame:
    names = ["docs.law.raw.v1", "docs.normalized.v1", "docs.references.v1", "docs.edition-events.v1"]
    stream = F.get(F.array(*(F.lit(x) for x in names)), (F.col("offset") % 4).cast("int"))
    events = raw_events(documents(t)).withColumn("stream", stream)
    kept = D.apply_retention(events, NOW, D.days_of(F.col("stream")))
    return kept.groupBy("stream").agg(
        F.count(F.lit(1)).alias("events"), F.min("offset").alias("lowest")
    )


@query(
    "compact_delete",
    f"""
    WITH {RAW}, l AS (SELECT key, max("offset") AS o FROM v GROUP BY 1)
    SELECT v.key AS document_id, "offset", tombstone FROM v JOIN l ON v.key = l.key AND "offset" = o
    WHERE ts >= TIMESTAMP '2024-07-19' - INTERVAL 180 DAY
    """,
)
def compact_delete(t: Tables) -> DataFrame:
    return D.compact_delete(valid(t), NOW, 180).select("document_id", "offset", "tombstone")


@query(
    "ordered_events",
    f"WITH {RAW} SELECT key, \"offset\", topic, row_number() OVER (ORDER BY key, \"offset\") AS place FROM e",
)
def ordered_events(t: Tables) -> DataFrame:
    """The events in key order with the place at which each one stands there."""
    rows = raw_events(documents(t)).select("key", "offset", "topic")
    task, inside = F.spark_partition_id(), F.monotonically_increasing_id()
    stood = stored(D.in_key_order(rows, "key", "offset").select("*", task.alias("task"), inside.alias("at")), "ordered")
    sizes = stood.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return stood.join(starts, "task").select("key", "offset", "topic", place.alias("place"))


@query(
    "consumer_lag",
    f"""
    WITH {RAW}
    SELECT topic, part AS "partition", max("offset") - coalesce(max("offset")
           FILTER (WHERE reason IS NULL), -1) AS lag FROM e GROUP BY 1, 2
    """,
)
def consumer_lag(t: Tables) -> DataFrame:
    """How far the published (valid) events are behind the raw ones."""
    events = raw_events(documents(t))
    published = D.normalize(events, MIN_CHARS)[0].select("topic", "offset")
    committed = (
        events.select("topic", "partition", "offset")
        .join(published, ["topic", "offset"])
        .groupBy("topic", "partition")
        .agg(F.max("offset").alias("committed_offset"))
    )
    return D.consumer_lag(events, committed)


EPISODE_SQL = """
    SELECT user_id, epoch_us(t2) AS started_us, epoch_us(ts) AS finished_us,
           event_id AS last_event_id
    FROM (SELECT *, lag(event_type, 1) OVER w AS s1, lag(event_type, 2) OVER w AS s2,
                 lag(ts, 1) OVER w AS t1, lag(ts, 2) OVER w AS t2
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE s2 = 'view' AND s1 = 'click' AND event_type = 'purchase'
      AND epoch_us(ts) - epoch_us(t1) <= 172800000000
      AND epoch_us(t1) - epoch_us(t2) <= 172800000000
"""
PATTERN = ["view", "click", "purchase"]
MAX_GAP = 172_800


def _episodes(found: DataFrame) -> DataFrame:
    return found.select(
        "user_id",
        F.unix_micros(F.col("started_at").cast("timestamp")).alias("started_us"),
        F.unix_micros(F.col("finished_at").cast("timestamp")).alias("finished_us"),
        "last_event_id",
    )


@query("sequence_episodes", EPISODE_SQL)
def sequence_episodes(t: Tables) -> DataFrame:
    return _episodes(
        D.sequence_episodes(t.events, "user_id", "ts", "event_type", PATTERN, MAX_GAP)
    )


# --- the same on streams ----------------------------------------------------------------------


def _stream(t: Tables, table: str) -> DataFrame:
    return J.file_stream(t.spark, t.path(table), getattr(t, table).schema)


@query(
    "stream_raw",
    f"""
    WITH {RAW}
    SELECT topic, count(*) AS events, count(DISTINCT key) AS keys,
           CAST(sum(CASE WHEN tombstone THEN 1 ELSE 0 END) AS BIGINT) AS tombstones
    FROM e GROUP BY 1
    """,
)
def stream_raw(t: Tables) -> DataFrame:
    """Ingest the raw topics into the lake, partitioned by topic."""
    lake, checkpoint = new_folder(t.spark, "raw"), new_folder(t.spark, "raw-checkpoint")
    J.run_available(J.to_lake(raw_events(_stream(t, "documents")), lake, checkpoint, ["topic"]))
    return (
        t.spark.read.parquet(lake)
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("key").alias("keys"),
            F.count_if(F.col("value").isNull()).alias("tombstones"),
        )
    )


@query("stream_dlq", DLQ_SQL)
def stream_dlq(t: Tables) -> DataFrame:
    path, checkpoint = new_folder(t.spark, "checked"), new_folder(t.spark, "split-checkpoint")
    raw = raw_events(_stream(t, "documents"))
    J.run_available(J.split_stream(raw, path, checkpoint, MIN_CHARS))
    return _letters(J.split_batches(t.spark, path)[1])


@query(
    "stream_dedup",
    f"""
    WITH {RAW}
    SELECT digest AS event_id, min("offset") AS "offset", arg_min(key, "offset") AS document_id
    FROM live GROUP BY 1
    """,
)
def stream_dedup(t: Tables) -> DataFrame:
    path, checkpoint = new_folder(t.spark, "firsts"), new_folder(t.spark, "dedup-checkpoint")
    clean, _ = D.normalize(raw_events(_stream(t, "documents")), MIN_CHARS)
    live = clean.filter(~F.col("tombstone"))
    J.run_available(J.dedup_stream(live, ["event_id"], ["document_id"], path, checkpoint))
    return J.first_events(t.spark, path, ["event_id"], ["document_id"])


@query(
    "stream_lake",
    f"""
    WITH {RAW}
    SELECT topic, CAST(ts AS DATE) AS day, count(*) AS events,
           CAST(coalesce(sum(CASE WHEN NOT tombstone THEN length(text) END), 0) AS BIGINT) AS chars
    FROM v GROUP BY 1, 2
    """,
)
def stream_lake(t: Tables) -> DataFrame:
    """Clean events to the lake, one folder per topic."""
    lake, checkpoint = new_folder(t.spark, "lake"), new_folder(t.spark, "lake-checkpoint")
    clean, _ = D.normalize(raw_events(_stream(t, "documents")), MIN_CHARS)
    J.run_available(J.to_lake(clean, lake, checkpoint, ["topic"]))
    return (
        t.spark.read.parquet(lake)
        .groupBy("topic", F.to_date("timestamp").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
        )
    )


@query(
    "stream_state",
    f"""
    WITH {RAW}, l AS (SELECT key, max("offset") AS o FROM v GROUP BY 1)
    SELECT v.key AS document_id, version, digest AS event_id
    FROM v JOIN l ON v.key = l.key AND v."offset" = l.o WHERE NOT tombstone
    """,
)
def stream_state(t: Tables) -> DataFrame:
    path, checkpoint = new_folder(t.spark, "state"), new_folder(t.spark, "state-checkpoint")
    clean, _ = D.normalize(raw_events(_stream(t, "documents")), MIN_CHARS)
    J.run_available(J.state_stream(clean, path, checkpoint))
    state = J.latest_state(t.spark, path).filter(~F.col("tombstone"))
    return state.select("document_id", "version", "event_id")


@query(
    "stream_index",
    f"""
    WITH {RAW}
    , l AS (SELECT key, max("offset") AS o FROM v GROUP BY 1),
    now AS (SELECT v.* FROM v JOIN l ON v.key = l.key AND v."offset" = l.o WHERE NOT tombstone)
    SELECT term, count(*) AS documents, CAST(sum(tf) AS BIGINT) AS occurrences FROM (
      SELECT term, key, count(*) AS tf FROM (
        SELECT key, unnest({TERMS}) AS term FROM now) WHERE term <> '' GROUP BY 1, 2)
    GROUP BY 1
    """,
)
def stream_index(t: Tables) -> DataFrame:
    """An index of the last versions: terms of replaced versions and deleted documents are gone."""
    index, checkpoint = new_folder(t.spark, "index"), new_folder(t.spark, "index-checkpoint")
    clean, _ = D.normalize(raw_events(_stream(t, "documents")), MIN_CHARS)
    J.run_available(J.index_stream(clean, index, checkpoint))
    return (
        J.current_index(t.spark, index)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("tf").alias("occurrences"))
    )


@query(
    "stream_window_agg",
    """
    WITH h AS (SELECT event_type, count(*) AS seen FROM events GROUP BY 1)
    SELECT epoch_us(date_trunc('hour', ts)) // 1000000 AS window_start, e.event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max(seen) AS seen
    FROM events e JOIN h ON e.event_type = h.event_type GROUP BY 1, 2
    """,
)
def stream_window_agg(t: Tables) -> DataFrame:
    """Hourly totals of a stream beside the counts of the stored history."""
    path, checkpoint = new_folder(t.spark, "window"), new_folder(t.spark, "window-checkpoint")
    events = _stream(t, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    history = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("seen"))
    J.run_available(J.window_stream(events, ["event_type"], "ts", "value", "1 hour", path, checkpoint))
    return J.window_totals(t.spark, path, ["event_type"], history).select(
        F.unix_seconds("window_start").alias("window_start"),
        "event_type",
        "n",
        F.col("total").cast("double").alias("total"),
        "seen",
    )


@query("stream_episodes", EPISODE_SQL)
def stream_episodes(t: Tables) -> DataFrame:
    """Events that arrive as a stream in any order; a batch works on the keys it has events for."""
    path, checkpoint = new_folder(t.spark, "episodes"), new_folder(t.spark, "episodes-checkpoint")
    events = _stream(t, "events").select("user_id", "event_id", "ts", "event_type")
    J.run_available(episode_stream(events, "user_id", "event_id", "ts", "event_type", PATTERN, MAX_GAP, path, checkpoint))
    return _episodes(episodes(t.spark, path, "user_id"))


@query(
    "stream_groups",
    f"""
    WITH {RAW},
    g AS (SELECT 'audit' AS consumer, topic, "offset" FROM e
          UNION ALL SELECT 'lake', topic, "offset" FROM e WHERE NOT tombstone)
    SELECT g.consumer, g.topic, count(*) AS events, max(read.rows) AS read_rows,
           max(read.first_offset) AS first_offset, max(read.last_offset) AS last_offset
    FROM g JOIN (SELECT topic, count(*) AS rows, min("offset") AS first_offset, max("offset") AS last_offset
                 FROM e GROUP BY 1) read ON g.topic = read.topic
    GROUP BY 1, 2
    """,
)
def stream_groups(t: Tables) -> DataFrame:
    """Two groups read the raw topics on their own; rows and offsets of a batch are committed together."""
    works = {"audit": lambda batch: batch.select("topic", "offset"), "lake": lambda batch: batch.filter("value IS NOT NULL").select("topic", "offset")}
    found = []
    for name, work in works.items():
        path, checkpoint = new_folder(t.spark, f"group-{name}"), new_folder(t.spark, f"group-{name}-checkpoint")
        J.run_available(publish_stream(raw_events(_stream(t, "documents")), path, checkpoint, work))
        read = commits(t.spark, path).groupBy("topic").agg(
            F.sum("rows").alias("read_rows"), F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
        )
        counted = committed(t.spark, path).groupBy("topic").agg(F.count(F.lit(1)).alias("events"))
        found.append(counted.join(read, "topic").select(F.lit(name).alias("consumer"), "topic", "events", "read_rows", "first_offset", "last_offset"))
    return found[0].unionByName(found[1])
