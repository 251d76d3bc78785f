"""Repeated byte strings by digests of grams and winnowed anchors, in place of sorted suffix buckets.

``gram_ids`` gives every place of a text the digest of the 1, 2, 3, 6, 12, 24 and 25 bytes that begin
there, each level made from the one before at two offsets, inside the text. One 25-byte anchor is kept
per 50-byte window, and only what two texts share is compared across the corpus: anchors, then runs of
windows, then single windows, equal by 64-bit identifiers (see ``repeats``).

Buckets of suffixes are not sorted across the corpus: one sort of all suffixes by their first eight
bytes moves 13.7 bytes per byte of text, 24 times the stored input (README), against a limit of 4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.repeats import Rule, covered_texts, lists, mix, spans

_BYTES = mix(mix(np.arange(256, dtype=np.uint64), np.ones(256, np.uint64)), np.ones(256, np.uint64))


def byte_symbols(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def byte_ids(symbols: np.ndarray) -> np.ndarray:
    return _BYTES[symbols]


def remove_earlier_strings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the
    bytes left) and ``starts`` / ``stops`` of the removed stretches.

    A byte goes if a string of ``length`` bytes around it also starts in a text of a smaller id. A
    string repeated in one text only, or in rows of one id only, stays. A null id is larger than
    any other. A null text is empty; a text shorter than ``length`` stays whole. The cut may fall
    inside a character, therefore ``kept`` is binary. Other columns are not read.
    """
    schema = f"{id_column} long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, stops array<long>"

    def finish(ids: list, texts: list[bytes], rows: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
        own, size, removed, number, kept, starts, stops = [], [], [], [], [], [], []
        for row, covered in rows:
            a, b = spans(covered)
            own.append(ids[row])
            size.append(len(covered))
            removed.append(int((b - a).sum()))
            number.append(len(a))
            kept.append(np.frombuffer(texts[row], np.uint8)[~covered].tobytes() if len(a) else texts[row])
            starts.append(a)
            stops.append(b)
        counts = [pa.array(x, pa.int64()) for x in (own, size, removed, number)]
        names = [id_column, "n_bytes", "n_removed", "n_spans", "kept", "starts", "stops"]
        return pa.table([*counts, pa.array(kept, pa.binary()), lists(starts), lists(stops)], names=names)

    return covered_texts(docs, Rule(length, (length + 1) // 2, True, byte_symbols, byte_ids), id_column, text, schema, finish)
