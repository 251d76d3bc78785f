"""Near duplicates by SimHash: an inverted index on byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most ``d`` bits share at least ``8 - d`` of their
eight bytes in place. Fingerprints are indexed under sets of positional bytes chosen so that any
``8 - d`` shared bytes hold one of the sets; those that meet in a posting list have their shared
bytes tallied, pairs that reach the guaranteed number are verified bit by bit, and of each list
only a star per linked group leaves the task, never its pairs. Keys are counted first: the members of
a frequent key are indexed under all ``8 - d`` bytes that hold it, as lists of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import whole_row, word_blocks
from tidemark.llm.components import connected_components
from tidemark.session import stored

#: Fixed value: the seed of the shingle digests.
SEED = 42
#: Lists up to this length are compared all against all inside their task; a longer one, whose
#: fingerprints then share ``8 - d`` bytes, is probed bit pattern by bit pattern. Both are exact.
DIRECT = 2048


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one text as an unsigned number; 0 if there is no word."""
    counts, total, carry = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks((text or b"").lower()):
        words = carry + words
        if len(words) >= shingle:
            joined = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
            digests = np.array([xxh64_intdigest(x, SEED) for x in joined], dtype=">u8")
            counts += np.unpackbits(digests.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(joined)
            words = words[len(words) - shingle + 1 :]
        carry = words
    if not total and carry:
        return xxh64_intdigest(b" ".join(carry), SEED)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """``keys`` and ``fingerprint`` (its 64 bits as a long) for every row of ``docs``.

    A null text counts as empty, and a text without a word has fingerprint 0; fewer words than a
    shingle count as one shingle.
    """
    schema = docs.select(*keys).schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(len(keys))], dtype=np.uint64)
            columns = [batch.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=schema.fieldNames())

    return docs.select(*keys, F.col(text).cast("binary").alias("_text")).mapInArrow(run, schema)


def posting_sets(shared: int, size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions of which any ``shared`` positions out of 8 hold one.

    Positions fall into as many groups as can each have ``size - 1`` of the shared positions and
    still leave one over; every set inside a group is taken.
    """
    groups = max(1, (shared - 1) // (size - 1)) if size > 1 else 8
    parts = [tuple(int(x) for x in part) for part in np.array_split(np.arange(8), groups)]
    return [x for part in parts for x in combinations(part, size)]


def _masked(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * (7 - p)) for p in positions)


def _equal_bytes(difference: np.ndarray) -> np.ndarray:
    """The number of positional bytes two fingerprints share, from their exclusive or."""
    x = difference | (difference >> np.uint64(4))
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    x &= np.uint64(0x0101010101010101)
    return 8 - ((x * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int8)


def _linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    difference = a[:, None] ^ b[None, :]
    close = _equal_bytes(difference) >= 8 - distance
    rows, columns = np.nonzero(close)
    close[rows, columns] = np.bitwise_count(difference[rows, columns]) <= distance
    return close


def _spread(labels: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> bool:
    """Gives both ends of each pair the smaller label; true if any label changed."""
    changed = False
    for a, b in pairs:
        low = np.minimum(labels[a], labels[b])
        changed |= bool((labels[a] != low).any() or (labels[b] != low).any())
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
    return changed


def _direct(values: np.ndarray, distance: int) -> np.ndarray:
    linked = _linked(values, values, distance)
    labels = np.arange(len(values))
    while True:
        new = np.where(linked, labels[None, :], len(values)).min(axis=1)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _probed(values: np.ndarray, free: list[int], distance: int) -> np.ndarray:
    """Labels for fingerprints (sorted) that differ in the bits ``free`` only: each one is looked up
    with every pattern of up to ``distance`` of those bits turned."""
    labels = np.arange(len(values))

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for size in range(1, distance + 1):
            for bits in combinations(free, size):
                turned = values ^ np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(values, turned), len(values) - 1)
                found = np.flatnonzero(values[at] == turned)
                if len(found):
                    yield found, at[found]

    while _spread(labels, pairs()):
        pass
    return labels


def star_links(values: np.ndarray, held: tuple[int, ...], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each group of a posting list: (fingerprint, smallest of its group).

    ``values``: distinct fingerprints, sorted, that share the bytes at ``held``.
    """
    free = [8 * (7 - p) + i for p in range(8) if p not in held for i in range(8)]
    labels = _direct(values, distance) if len(values) <= DIRECT else _probed(values, free, distance)
    linked = np.flatnonzero(labels != np.arange(len(values)))
    return values[linked], values[labels[linked]]


def _posted(prints: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """``fingerprint, key``: a row for each of ``sets``, the key being its number and its bytes."""
    keys = [F.struct(F.lit(n).alias("set"), F.col("fingerprint").bitwiseAND(F.lit(_signed(_masked(s)))).alias("bytes")) for n, s in enumerate(sets)]
    return prints.select("fingerprint", F.explode(F.array(*keys)).alias("key"))


def _starred(posted: DataFrame, sets: list[tuple[int, ...]], distance: int) -> DataFrame:
    """The links of all posting lists."""
    lists = posted.groupBy("key").agg(F.collect_list("fingerprint").alias("members")).where(F.size("members") > 1).select(F.col("key.set").alias("set"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst = [], []
            for n, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.sort(np.asarray(members.values).astype(np.int64).view(np.uint64))
                a, b = star_links(values, sets[n], distance)
                src.append(a.view(np.int64))
                dst.append(b.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (src, dst)], names=["src", "dst"])

    return lists.mapInArrow(run, "src long, dst long")


def links(distinct: DataFrame, distance: int = 3, posting_bytes: int = 3) -> DataFrame:
    """Links ``(src, dst)`` that connect all fingerprints within ``distance`` bits of each other.

    ``distinct`` holds each fingerprint once. ``posting_bytes``: the length of an index key; with
    more bytes the lists are shorter and there are more of them. A key that more than
    ``DIRECT`` fingerprints have gets lists by all bytes that must be shared instead. Null
    fingerprints are linked to none.
    """
    if not 0 <= distance <= 7:
        raise ValueError("beyond 7 bits no byte needs to be shared")
    shared = 8 - distance
    size = min(posting_bytes, shared)
    sets, wide = posting_sets(shared, size), list(combinations(range(8), shared))
    if size == shared:
        return _starred(_posted(distinct, wide), wide, distance).distinct()
    posted = _posted(distinct, sets)
    frequent = stored(posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > DIRECT).select("key"), "frequent")
    # Fingerprints that share the bytes of a wide set also share those of any set in it, so a list of
    # a wide set is whole whichever of its sets is frequent.
    within = [[n for n, w in enumerate(wide) if set(s) <= set(w)] for s in sets]
    wider = F.array(*[F.array(*[F.lit(n) for n in own]) for own in within])
    kinds = (
        posted.join(frequent, "key")
        .select("fingerprint", F.explode(wider[F.col("key.set")]).alias("set"))
        .groupBy("fingerprint")
        .agg(F.collect_set("set").alias("own"))
    )
    kept = F.array(*[F.lit(_signed(_masked(w))) for w in wide])
    single = kinds.select("fingerprint", F.explode("own").alias("set"))
    split = single.select("fingerprint", F.struct("set", F.col("fingerprint").bitwiseAND(kept[F.col("set")]).alias("bytes")).alias("key"))
    short = _starred(posted.join(frequent, "key", "left_anti"), sets, distance)
    return short.unionAll(_starred(split, wide, distance)).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def rooted(distinct: DataFrame, distance: int = 3, posting_bytes: int = 3) -> DataFrame:
    """``distinct``, which holds each fingerprint once, with ``_root``: a fingerprint of its group,
    the same for the whole group and for no other, whatever the ids of the rows are."""
    roots = connected_components(links(distinct, distance, posting_bytes)).withColumnRenamed("node", "fingerprint")
    return distinct.join(roots, "fingerprint", "left").withColumn("_root", F.coalesce("root", "fingerprint")).drop("root")


def near_duplicates(prints: DataFrame, id_column: str = "doc_id", distance: int = 3, posting_bytes: int = 3) -> DataFrame:
    """The rows of ``prints`` (``id_column``, ``fingerprint`` and more) with ``component_id``.

    Rows belong together if a chain of fingerprints, each within ``distance`` bits of the next,
    joins them; ``component_id`` is the smallest id of the group. Equal fingerprints are one
    member of the index whatever their number. A group whose ids are all null has no id.
    """
    placed = rooted(prints.groupBy("fingerprint").agg(F.min(id_column).alias("_first")), distance, posting_bytes)
    smallest = placed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    names = placed.join(smallest, "_root").select("fingerprint", "component_id")
    return prints.join(names, "fingerprint")


def _stored_prints(docs: DataFrame, id_column: str, text: str, shingle: int) -> DataFrame:
    rows = docs.select(F.col(id_column), F.xxhash64(F.col(text)).alias("text_digest"), F.col(text).alias("_body"))
    return stored(fingerprints(rows, [id_column, "text_digest"], "_body", shingle), "simhash")


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``id_column``, ``text_digest``, ``fingerprint`` and ``component_id`` for every row.

    The id and the digest of the text together name a row; rows that are equal in both are copies
    of each other and stay apart in the result. Nulls and empty texts: see ``fingerprints``.
    """
    return near_duplicates(_stored_prints(docs, id_column, text, shingle), id_column, distance)


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, with all its columns.

    The row with the smallest id stays (a null id is larger than any other); of rows that share
    the id the one with the smallest digest of its text, and of full copies one. Groups go by their
    fingerprints: one id given to unrelated texts does not join their groups.
    """
    prints = _stored_prints(docs, id_column, text, shingle)
    first = F.min(F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), F.col("text_digest").alias("digest")))
    firsts = rooted(prints.groupBy("fingerprint").agg(first.alias("_first")), distance)
    keep = firsts.groupBy("_root").agg(F.min("_first").alias("_first")).select("_first.id", "_first.digest")
    # Keys without nulls: one shuffle of the documents then serves the join and the dropping of copies.
    key = [F.coalesce(F.col("id"), F.lit(0)).alias("_id"), F.col("id").isNull().alias("_none"), F.col("digest").alias("_digest")]
    rows = docs.select(whole_row(docs), F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("digest"))
    names = ["_id", "_none", "_digest"]
    kept = rows.select("row", *key).join(keep.select(*key).distinct(), names, "left_semi")
    return kept.dropDuplicates(names).select("row.*")
