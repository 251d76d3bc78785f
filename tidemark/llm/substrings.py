"""Repeated passages of words: seed and extend.

Seeds are winnowed anchors: the smallest of the 12-word grams in every window. Texts that share a
seed meet in its bucket (the join), where the seed is extended to the left and to the right by
comparing the contexts around it, first as far as the seed is the anchor of the windows, then
window by window where contexts part. Windows that hold are joined to maximal repeats, all of at
least the asked length. See ``repeats`` for the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from tidemark.llm.common import word_blocks
from tidemark.llm.repeats import Rule, covered_texts, lists, spans


def word_symbols(text: bytes) -> np.ndarray:
    parts = [np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64) for words in word_blocks(text)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def kept_words(text: bytes, covered: np.ndarray) -> bytes:
    at, kept = 0, []
    for words in word_blocks(text):
        own = covered[at : at + len(words)]
        at += len(words)
        if not own.all():
            kept.append(b" ".join(w for w, gone in zip(words, own.tolist(), strict=True) if not gone) if own.any() else b" ".join(words))
    return b" ".join(kept)


def remove_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 35, seed: int = 12) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed``, ``kept`` (the words left,
    joined by one space, as UTF-8 bytes) and ``starts`` / ``stops`` of the maximal repeats in words.

    A word goes if any ``length`` consecutive words around it also start at another place, in the
    same text or another one. Words are runs without a space or the controls tab to return. A null
    or empty text has no words; a text shorter than ``length`` keeps all; equal rows are separate
    texts, so long enough ones remove each other. Other columns are not read. ``seed`` words make a
    seed, at most ``length``; shorter seeds are fewer but meet more often by chance.
    """
    schema = f"{id_column} long, n_words long, n_removed long, kept binary, starts array<long>, stops array<long>"

    def finish(ids: list, texts: list[bytes], rows: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
        own, words, removed, kept, starts, stops = [], [], [], [], [], []
        for row, covered in rows:
            a, b = spans(covered)
            own.append(ids[row])
            words.append(len(covered))
            removed.append(int((b - a).sum()))
            kept.append(kept_words(texts[row], covered))
            starts.append(a)
            stops.append(b)
        counts = [pa.array(x, pa.int64()) for x in (own, words, removed)]
        names = [id_column, "n_words", "n_removed", "kept", "starts", "stops"]
        return pa.table([*counts, pa.array(kept, pa.binary()), lists(starts), lists(stops)], names=names)

    return covered_texts(docs, Rule(length, min(seed, length), False, word_symbols, lambda ids: ids), id_column, text, schema, finish)
