"""Token ids of documents in ORC files, and reading them back by stripes.

Documents are dealt by ranges of their id, so files follow one another in the order of ids and the
minima and maxima in their footers prune by id. A row holds at most ``RUN`` ids of a document (ORC
writes integers as run lengths and deltas); row indexes and Bloom filters on the id let a reader skip
the rest of a file. Every reader works on stripes: what goes over several rows (number of ids,
checksum) is put together from one small record a row.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, pieces, text_bytes
from tidemark.session import stored

#: Token ids in a row.
RUN = 8192
#: UTF-8 bytes of text in a file and of text that a task looks at together.
FILE, SLICE = 32 << 20, 4 << 20
#: Words whose ids a task remembers; the ids of others are looked up again.
KNOWN = 600_000
#: Long texts are cut at these, the tokenizer's words end at them all.
_GAP = re.compile(rb"[\x20\x09-\x0D]")
# Lower-case letters and digits of Latin texts; ASCII punctuation but for the apostrophe.
_LETTERS, _MARKS = "a-zà-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: A word that is not looked up as it is, apart from its end: it has no clitic and no name of a special id.
_CORE = rf"(?s)^[^']*[{_LETTERS}0-9]"
_ENDED = rf"{_CORE}[{_MARKS}]+$"
_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_ONE_WORD = re.compile(f"[{_LETTERS}]+")


class Encoder:
    """Ids of texts by a file of the tokenizers library that splits at white space.

    Every distinct word of a slice is looked up once, in lower case and without the punctuation at its
    end, which the tokenizer splits off anyway. Words of letters alone go to the library as one text,
    told apart by the ids that end a word, all others one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def learn(self, parts: list[str]) -> None:
        """Looks ``parts`` up in the library."""
        for start in range(0, len(parts), 10_000):
            some = parts[start : start + 10_000]
            plain = [p for p in some if _ONE_WORD.fullmatch(p)]
            ids = np.array(self.tokenizer.encode(" ".join(plain), add_special_tokens=False).ids, dtype=np.int32)
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) != len(plain):
                plain, ends = [], []
            raw, at = ids.tobytes(), 0
            for part, end in zip(plain, ends, strict=True):
                self.known[part] = raw[at:end]
                at = end
            rest = [p for p in some if p not in self.known]
            for part, found in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True):
                self.known[part] = np.array(found.ids, dtype=np.int32).tobytes()

    def ids(self, parts: list[str]) -> pa.ListArray:
        """The ids of each part."""
        if len(self.known) > KNOWN:
            self.known.clear()
        self.learn([p for p in parts if p not in self.known])
        found = [self.known[p] for p in parts]
        offsets = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids of all of them."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = lists.values.dictionary_encode()
        words = coded.dictionary
        special = pc.match_substring(words, "<|")
        words = pc.if_else(special, words, pc.ascii_lower(words))
        ended = pc.and_(pc.invert(special), pc.match_substring_regex(words, _ENDED))
        tails = pc.if_else(ended, pc.replace_substring_regex(words, _CORE, ""), "")
        cores = pc.if_else(ended, pc.utf8_rtrim(words, _PUNCTUATION), words)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        ids = self.ids(parts.dictionary.to_pylist())
        both = np.stack([parts.indices.to_numpy()[: len(words)], parts.indices.to_numpy()[len(words) :]], axis=1).reshape(-1)
        halves = ids.take(pa.array(both))
        whole = pa.ListArray.from_arrays(pa.array(halves.offsets.to_numpy()[::2]), halves.values)
        taken = whole.take(coded.indices)
        borders = taken.offsets.to_numpy()[lists.offsets.to_numpy()]
        return np.diff(borders), taken.values.to_numpy()[borders[0] : borders[-1]]


def cut(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut behind white space."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, min(at + size, len(text)))
        stop = gap.end() if gap else len(text)
        yield text[at:stop]
        at = stop


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _rows(batches: Iterator[pa.RecordBatch], path: str, end_id: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part, encoder = TaskContext.get().partitionId(), _encoder(path)
    number, size = -1, 0
    keys: dict[int, object] = {}  # of the documents that are not yet written in whole
    pending: list[tuple[int, bytes, bool]] = []  # document, text, whether the document ends with it
    rest, seq = np.array([], dtype=np.int32), 0  # ids of an open document that fill no row yet

    def flush() -> pa.RecordBatch:
        nonlocal rest, seq
        rows = []
        lengths, ids = encoder.encode([text for _, text, _ in pending])
        for (place, _, last), own in zip(pending, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
            have = np.concatenate([rest, own, [end_id]]) if last else np.concatenate([rest, own])
            full = len(have) if last else len(have) // RUN * RUN
            for start in range(0, full, RUN):
                rows.append((keys[place], place, seq, have[start : min(start + RUN, full)]))
                seq += 1
            rest = have[full:]
            if last:
                seq = 0
                del keys[place]
        pending.clear()
        offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])]).astype(np.int32)
        values = np.concatenate([r[3] for r in rows]).astype(np.int32) if rows else np.array([], dtype=np.int32)
        arrays = [
            pa.array([r[0] for r in rows], schema.field("doc_id").type),
            pa.array([part] * len(rows), pa.int32()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), type=schema.field("ids").type),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            number += 1
            keys[number] = key
            texts = list(cut(text.as_py() or b"")) or [b""]
            for i, piece in enumerate(texts):
                pending.append((number, piece, i == len(texts) - 1))
                size += len(piece)
                if size >= SLICE:
                    yield flush()
                    size = 0
    if pending:
        yield flush()


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    stripe: int = 16 << 20,
    stride: int = 2000,
    file_bytes: int = FILE,
) -> None:
    """Writes the ids of whole texts to ORC files under ``path``, in ascending order of ``key``.

    Rows are (doc_id, part, doc_no, seq, ids): ``part`` numbers the files in order, ``doc_no`` the
    documents of a file, ``seq`` the rows of a document. ``end_id`` closes every document. Null texts
    are empty, null keys come last, documents of one key go by a digest of their text and then in the
    order they are read, so a frequent key spreads over files. An empty table gives no documents.
    """
    parts = pieces(text_bytes(docs, text), file_bytes)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest").asc(), F.col("place").asc()]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ddl = token_schema(docs, key)
    schema = arrow_schema(ddl)
    encoded = dealt.mapInArrow(lambda batches: _rows(batches, tokenizer, end_id, schema), ddl)
    writer = encoded.write.option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id")
    writer = writer.option("orc.bloom.filter.fpp", 0.01).option("orc.stripe.size", stripe).option("orc.row.index.stride", stride)
    writer.option("orc.rows.between.memory.checks", 100).orc(path)  # rows are long, look at the stripe's size often


def token_schema(docs: DataFrame, key: str = "doc_id") -> str:
    return f"doc_id {docs.schema[key].dataType.simpleString()}, part int, doc_no bigint, seq int, ids array<int>"


def read_token_ids(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of :func:`write_token_ids`; filters on ``doc_id`` skip files, stripes and strides."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.orc(path)


def _run_records(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(4)
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
        arrays = [*(batch.column(i) for i in range(4)), pa.array(np.diff(offsets), pa.int64()), pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _joined_crc(runs: list[dict]) -> int:
    """The checksum of runs that follow one another, from theirs: it is linear over exclusive or."""
    crc = runs[0]["crc"]
    for run in runs[1:]:
        zeros = bytes(4 * run["n"])
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ run["crc"]
    return crc


def _whole(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [_joined_crc(runs) for runs in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(crcs, pa.int64())], names=names)


def token_documents(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the rows of the files.

    ``start`` counts the ids ahead of the document: of the files before it and of its own file. The
    checksum covers the ids as little-endian unsigned 32-bit integers.
    """
    key = f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}"
    names = ["doc_id", "part", "doc_no", "seq", "n", "crc"]
    rows = tokens.select("doc_id", "part", "doc_no", "seq", "ids").mapInArrow(
        lambda batches: _run_records(batches, names), f"{key}, part int, doc_no bigint, seq int, n bigint, crc bigint"
    )
    runs = F.sort_array(F.collect_list(F.struct("seq", "n", "crc"))).alias("runs")
    grouped = rows.groupBy("part", "doc_no").agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), runs)
    names_whole = ["doc_id", "part", "doc_no", "n_tokens", "ids_crc32"]
    docs = stored(
        grouped.select("doc_id", "part", "doc_no", "n_tokens", "runs").mapInArrow(
            lambda batches: _whole(batches, names_whole), f"{key}, part int, doc_no bigint, n_tokens bigint, ids_crc32 bigint"
        ),
        "token-documents",
    )
    files = docs.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    ahead = files.select(
        F.col("part").alias("file"),
        F.coalesce(F.sum("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
    )
    inside = Window.partitionBy("part").orderBy("doc_no").rowsBetween(Window.unboundedPreceding, -1)
    started = docs.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return started.join(ahead, F.col("part") == F.col("file")).select(
        "doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
