"""Benchmark decontamination by a prefix-filtered set join.

An item's text gives windows of a fixed number of words. A window's words, its shingles, are
ordered by how rare they are in the corpus; as all of them must be found, a prefix of one, the
rarest, is necessary. Documents are joined on that word alone, the place of the word in the window
fixes where the window must lie, length and position bounds drop what does not fit, and the
survivors are verified word by word.

Windows go by numbers: what a document is hit by is a set of numbers, and the items behind a set are
listed once, however many documents have it. A small benchmark is broadcast in a few blocks, each read
against the documents where they are; the windows of a larger one meet, in one pass and by a shuffle on
the rare word, the words around those document words that a fixed table of bits lets through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, pieces, whole_row
from tidemark.session import stored

#: Words of a text with A to Z lower-cased are runs of 0-9, a-z and anything beyond
#: ASCII; here for texts in any case, what lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows are sent to the tasks in blocks of at most about this many bytes, if there are at most so
#: many blocks; else they are shuffled.
BLOCK_BYTES, BLOCKS = 4 << 20, 8
#: Bits of the table of rare words, which is broadcast as 64 of them a row.
TABLE_BITS = 1 << 24


def word_list(text: Column) -> Column:
    """The words in their own case; there may be an empty entry at either end."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def item_windows(items: DataFrame, item_id: str, text: str, length: int) -> tuple[DataFrame, DataFrame]:
    """``number, words``: the distinct windows, and ``number, item``: which items have them. An item
    of fewer words is one window; one without words has none. A null item is not listed."""
    words = F.filter(word_list(ascii_lower(F.col(text))), lambda w: w != "")
    own = items.select(F.col(item_id).cast("string").alias("item"), words.alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - length + 1))
    held = stored(own.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, length))).alias("words")).distinct(), "item_windows")
    windows = stored(held.select("words").distinct().select(F.monotonically_increasing_id().alias("number"), "words"), "windows")
    return windows, held.where(F.col("item").isNotNull()).join(windows, "words").select("number", "item")


def in_blocks(rows: DataFrame, size: Column, by: str) -> list[DataFrame]:
    """``rows`` in parts of at most about ``BLOCK_BYTES`` by a column's digest, to be broadcast; none
    if that takes more than ``BLOCKS`` parts."""
    blocks = pieces(rows.agg(F.sum(size)).first()[0] or 0, BLOCK_BYTES)
    if blocks > BLOCKS:
        return []
    return [rows.where(F.pmod(F.xxhash64(by), F.lit(blocks)) == k) for k in range(blocks)]


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for frame in others:
        first = first.unionAll(frame)
    return first


def rarest_words(windows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``number, words`` with ``rare``, its word that the corpus has least often (ties: the first in code
    point order), and ``offset``, its first place in the window; counts are over all documents."""
    vocabulary = stored(windows.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    tokens = docs.select(F.explode_outer(word_list(F.col(text))).alias("raw")).select(F.lower("raw").alias("raw"))
    held = vocabulary.withColumn("key", F.lower("word"))
    blocks = in_blocks(held, 2 * F.octet_length("word") + 16, "word")
    if blocks:
        counted = _union([tokens.join(F.broadcast(block), F.col("raw") == F.col("key")).groupBy("word").agg(F.count("*").alias("n")) for block in blocks])
    else:
        counted = tokens.groupBy("raw").agg(F.count("*").alias("n")).join(held, F.col("raw") == F.col("key")).select("word", "n")
    counts = stored(counted, "counts")
    ranked = (
        windows.select("number", F.explode("words").alias("word"))
        .join(counts, "word", "left")
        .groupBy("number")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "word")).alias("least"))
    )
    rare = windows.join(ranked, "number").withColumn("rare", F.col("least.word"))
    return stored(rare.select("number", "words", "rare", F.array_position("words", F.col("rare")).alias("offset")), "windows")


def occurrences(docs: DataFrame, windows: DataFrame, key: list[str], text: str, length: int) -> DataFrame:
    """``key, start, length, number`` for every place where a window, of at most ``length`` words,
    occurs; places count from 1 in the entries of ``word_list``."""
    parted = docs.select(*key, word_list(F.col(text)).alias("_all"))
    tokens = parted.select(*key, "_all", F.posexplode_outer("_all").alias("_at", "_raw"))
    lookup = windows.select(F.lower("rare").alias("rare"), "offset", F.size("words").alias("length"), F.array_join("words", " ").alias("phrase"), "number")
    start = F.col("_at") + 2 - F.col("offset")
    fits = (start >= 1) & (start + F.col("length") - 1 <= F.col("_size"))
    # Words hold no space, so that phrases are equal if and only if their words are. Only functions
    # with generated code: explode and join then run as one loop that never copies a word list.
    same = lambda words, at: ascii_lower(F.array_join(F.slice(words, at, F.col("length")), " ")) == F.col("phrase")
    found = [*key, start.alias("start"), "length", "number"]
    blocks = in_blocks(lookup, 2 * F.octet_length("phrase") + 128, "number")
    if blocks:
        met = [tokens.join(F.broadcast(block), F.lower("_raw") == F.col("rare")) for block in blocks]
        return _union([m.withColumn("_size", F.size("_all")).where(fits & same("_all", start)).select(*found) for m in met])
    low = F.greatest(F.lit(1), F.col("_at") + 2 - length)
    around = F.slice("_all", low, F.col("_at") + 1 - low + length)
    places = _let_through(tokens, windows.select(F.lower("rare").alias("rare")))
    met = places.select(*key, "_at", F.size("_all").alias("_size"), F.lower("_raw").alias("rare"), low.alias("_low"), around.alias("_around")).join(lookup, "rare")
    return met.where(fits).where(same("_around", start - F.col("_low") + 1)).select(*found)


def _let_through(tokens: DataFrame, rare: DataFrame) -> DataFrame:
    """The rows of ``tokens`` whose word may be one of ``rare``, by a table of bits whose size does
    not depend on them."""
    place = lambda word: F.pmod(F.xxhash64(word), F.lit(TABLE_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place(F.col("rare")).bitwiseAND(F.lit(63)).cast("int"))
    table = rare.groupBy(F.shiftright(place(F.col("rare")), 6).alias("_slot")).agg(F.bit_or(bit).alias("_bits"))
    own = place(F.lower("_raw"))
    met = tokens.join(F.broadcast(table), F.shiftright(own, 6) == F.col("_slot"))
    return met.where(F.call_function("shiftright", F.col("_bits"), own.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)


def _found(docs: DataFrame, items: DataFrame, length: int, id_column: str, text: str, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """The stored occurrences in ``docs``, by id and digest of the text, and ``number, item``."""
    numbered, links = item_windows(items, item_id, item_text, length)
    windows = rarest_words(numbered, docs, text)
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("_body"))
    return stored(occurrences(rows, windows, ["id", "digest"], "_body", length), "occurrences"), links


def contamination(
    docs: DataFrame, items: DataFrame, length: int = 10, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``id_column``, ``text_digest``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings) and
    ``contaminated`` for every row of ``docs``.

    A word is hit if it lies inside any occurrence of a window. A null or empty text has no words,
    an item without words no windows; a null item id counts as hit words but is not listed. Rows
    that are equal in id and text get equal results. Other columns are not read.
    """
    found, links = _found(docs, items, length, id_column, text, item_id, item_text)
    key = ["id", "digest"]
    places = found.select(*key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place"))
    hits = places.distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    numbers = found.select(*key, "number").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("number")).alias("numbers"))
    sets = stored(numbers.select(*key, F.sha2(F.array_join("numbers", ","), 256).alias("set"), "numbers"), "sets")
    members = sets.groupBy("set").agg(F.first("numbers").alias("numbers")).select("set", F.explode("numbers").alias("number"))
    listed = members.join(links, "number").select("set", "item").distinct().groupBy("set").agg(F.array_sort(F.collect_list("item")).alias("items"))
    both = F.col("h.id").eqNullSafe(F.col("s.id")) & (F.col("h.digest") == F.col("s.digest"))
    judged = hits.alias("h").join(sets.alias("s"), both).select(F.col("h.id").alias("_id"), F.col("h.digest").alias("_digest"), "n_hit", "set")
    counted = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("digest"), word_count(F.col(text)).alias("n_words"))
    met = counted.join(judged, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    # A clean document's set is a name of its own, so that these do not meet in one task.
    named = met.withColumn("set", F.coalesce("set", F.col("digest").cast("string")))
    return named.join(listed, "set", "left").select(
        F.col("id").alias(id_column),
        F.col("digest").alias("text_digest"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, length: int = 10, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    found, _ = _found(docs, items, length, id_column, text, "item_id", "text")
    hit = stored(found.select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "contaminated")
    rows = docs.select(whole_row(docs), F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("digest"))
    return rows.join(hit, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_anti").select("row.*")
