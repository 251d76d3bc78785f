"""Substring dedup by words and by bytes against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import earlier_strings, repeated_words
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.substrings import remove_repeated_passages
from tidemark.llm.suffixes import remove_earlier_strings

DOCS = "doc_id long, text string, kept string, row string"


def corpus(seed: int, letters: str, gap: str) -> list:
    """Texts over few symbols, with passages shared in part, copies, a repeated row and odd rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(letters, k=rng.randint(1, 3)))
    passages = [gap.join(word() for _ in range(rng.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p) + 1), 2))
            parts.append(rng.choice([p, p[a:b], word()]))
        rows.append((i, gap.join(parts)))
    rows += [(100 + i, rows[5][1]) for i in range(5)] + [rows[7], rows[7]]  # copies, equal rows
    rows += [(None, rows[3][1]), (None, rows[4][1]), (200, None), (201, ""), (202, " \t\n "), (203, "é" * 40 + "ü" * 40), (204, "ü" * 60)]
    rows += [(205, "a" * 300), (206, ("xy" * 200)), (300, rows[9][1][:90])]
    return rows


def run(spark, rows, operator, columns, **options):
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], DOCS)
    found = operator(docs, **options)
    return sorted((tuple(r) for r in found.select(*columns, F.sha2("kept", 256)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = corpus(seed, "ab", " ")
    got = run(spark, rows, remove_repeated_passages, ["doc_id", "n_words", "n_removed"], length=8, seed=3)
    assert got == sorted(repeated_words(rows, 8), key=str)


def test_words_of_the_contract_length(spark):
    rows = corpus(3, "abcdefgh", " \n")
    got = run(spark, rows, remove_repeated_passages, ["doc_id", "n_words", "n_removed"], length=35)
    assert got == sorted(repeated_words(rows, 35), key=str)


@pytest.mark.parametrize("seed", [4, 5])
def test_bytes(spark, seed):
    rows = corpus(seed, "abcd", " ")
    got = run(spark, rows, remove_earlier_strings, ["doc_id", "n_bytes", "n_removed", "n_spans"], length=50)
    assert got == sorted(earlier_strings(rows, 50), key=str)


def test_many_chunks_and_buckets_and_cut_texts(spark, monkeypatch):
    """The result does not depend on how texts are dealt out or cut."""
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 500)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 700)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    rows = corpus(6, "abc", " ")
    assert run(spark, rows, remove_earlier_strings, ["doc_id", "n_bytes", "n_removed", "n_spans"], length=20) == sorted(earlier_strings(rows, 20), key=str)
    assert run(spark, rows, remove_repeated_passages, ["doc_id", "n_words", "n_removed"], length=10, seed=4) == sorted(repeated_words(rows, 10), key=str)


def test_one_group_holding_a_third_of_all_rows(spark):
    hot = " ".join(f"w{i}" for i in range(60))
    rows = [(i, hot if i % 3 == 0 else f"start {i} " + hot[: 100 + i] + f" end {i}") for i in range(150)]
    assert run(spark, rows, remove_earlier_strings, ["doc_id", "n_bytes", "n_removed", "n_spans"]) == sorted(earlier_strings(rows, 50), key=str)
    assert run(spark, rows, remove_repeated_passages, ["doc_id", "n_words", "n_removed"], length=20) == sorted(repeated_words(rows, 20), key=str)


def test_empty_table_and_spans(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_passages(empty).collect() == []
    assert remove_earlier_strings(empty).collect() == []
    text = "0123456789" * 6
    found = remove_earlier_strings(spark.createDataFrame([(1, text), (2, "<" + text + ">")], "doc_id long, text string"))
    got = {r.doc_id: (r.starts, r.stops, bytes(r.kept)) for r in found.collect()}
    assert got == {1: ([], [], text.encode()), 2: ([1], [61], b"<>")}


def test_texts_travel_once(spark, small):
    """All rounds read one shuffle of the texts."""
    found = remove_earlier_strings(spark.read.parquet(f"{small}/documents.parquet"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 3


def test_smallest_is_leftmost():
    values = np.random.default_rng(1).integers(0, 5, 200)
    for width in (1, 2, 3, 7, 26):
        want = [i + int(values[i : i + width].argmin()) for i in range(200 - width + 1)]
        assert repeats.smallest_in(values, width).tolist() == want


def test_windows_of_one_anchor_spread_over_buckets():
    """A phrase with another context in each text: its windows must not meet in one bucket."""
    import pyarrow as pa
    from tidemark.llm.suffixes import byte_ids, byte_symbols

    rng = random.Random(7)
    context = lambda: bytes(rng.choices(range(97, 123), k=80))
    texts = [context() + b"THE ONE PHRASE THAT ALL OF THEM HAVE" + context() for _ in range(200)]
    search = repeats.Search(repeats.Rule(50, 25, True, byte_symbols, byte_ids), 16)
    table = pa.table({"_id": list(range(200)), "_chunk": [0] * 200, "_text": texts})

    def judged(messages, verdicts):
        rows = messages.to_pylist()
        parts = [messages.filter(pa.array([r["bucket"] == b for r in rows])) for b in sorted({r["bucket"] for r in rows})]
        return pa.concat_tables([search.judge(part, verdicts) for part in parts])

    runs = judged(search.send_anchors(table), search.judge_anchors)
    sent = search.send_windows(table, judged(search.send_runs(table, runs), search.judge_runs))
    sizes = [len(r["body"]) for r in sent.to_pylist() if r["bucket"] >= 0]
    assert sum(sizes) > 24 * 1000 and max(sizes) < sum(sizes) / 4
    got = judged(sent, search.judge_windows)
    assert not any(covered.any() for _, covered in search.covered(table, got))
