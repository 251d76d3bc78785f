"""Conversation repair, token files and fill-in-the-middle, against plain versions."""

from __future__ import annotations

import glob
import hashlib
import random
import re
import zlib
from functools import cache

import public_tokenizers
import pyarrow.orc as orc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import conversations, infill, tokens
from tidemark.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
INITIAL_ORDERS = re.compile(r"(s?(ua)+)?")


# -- conversations ----------------------------------------------------------------------------


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def place(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role, text[:64], hashlib.md5(f"{role}\n{text}".encode()).hexdigest())


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip("\x20\t\n\x0b\x0c\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least cost and least audit, by a table of whole audits, and the repaired rows."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, inserted):
        ways = []
        if i == len(rows):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            cost, edits, kept = best(i + 1, last, 0)
            ways.append((cost + 4, "D" + edits, kept))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                if role[:1] == follow[last] or role[:1] == "s" and last == "":
                    cost, edits, kept = best(i + 1, role[:1], 0)
                    ways.append((cost + extra, "K" + edits, ((role, text), *kept)))
                to = follow[last]
                cost, edits, kept = best(i + 1, to, 0)
                ways.append((cost + extra + 3, "R" + edits, (({"u": "user", "a": "assistant"}[to], text), *kept)))
        if inserted < 3:
            to = follow[last]
            cost, edits, kept = best(i, to, inserted + 1)
            ways.append((cost + 3, "I" + edits, (({"u": "user", "a": "assistant"}[to], ""), *kept)))
        return min(ways, default=(1 << 40, "", ()))

    return best(0, "", 0)


def repaired(rows):
    """The rows of op11 by the plain version."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=place)
        faults = faults_of(own)
        cost, audit, kept = cheapest(own, faults)
        turns = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def conversation_rows(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", "Well! ", "é…", None, "Long text here. And more"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "Assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(c, t, ("user", "assistant")[t % 2], f"Turn {t}.") for c in range(60, 90) for t in range(rng.randint(1, 8))]
    rows += [(100, None, "user", "No turn."), (100, None, "assistant", "None."), (100, 5, "user", "a."), (100, 5, "assistant", "b.")]
    rows += [(None, 1, "user", "No id."), (None, 2, "assistant", "Still none."), (101, None, None, None)]
    rows += [(102, 3, "user", "The same.")] * 300
    rows += [(103, t, rng.choice(("user", "assistant", "system")), rng.choice(("One.", "Two", "Three!", "x" * rng.randint(1, 200)))) for t in range(900)]
    return rows


COLUMNS = "conv_id long, turn long, role string, text string"


def result(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_op11_query(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = conversation_rows(4)
    spark.createDataFrame([(*r, "clash") for r in rows], COLUMNS + ", audit string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(QUERIES["op11_conversation_structure_repair"](spark, str(tmp_path))) == repaired(rows)


def test_long_conversation_lies_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 3000)
    rows = spark.createDataFrame([r for r in conversation_rows(5) if r[0] in (1, 103)], COLUMNS)
    found = conversations.repair(rows)
    assert found.summary.where("conv_id = 103").first().blocks > 5
    roles = [r.role for r in conversations.messages(found.blocks.where("conv_id = 103")).orderBy("part", "place").collect()]
    assert INITIAL_ORDERS.fullmatch("".join(r[0] for r in roles))


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_conversation_structure_repair"](spark, str(tmp_path)).collect() == []


rows_strategy = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", None]), st.sampled_from([0, 3])), max_size=14)


@given(rows_strategy, st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_walk_equals_a_table_of_audits(given_rows, leaf):
    """Division down to single rows gives the least audit, from any block border too."""
    rows = [(r, 0 if r is None else price, 1) for r, price in given_rows]
    kept, conversations.LEAF = conversations.LEAF, leaf
    try:
        edits = []
        state = conversations.walk(rows, 0, len(rows), 0, conversations.ENDING, edits)
    finally:
        conversations.LEAF = kept
    audit = "".join(edits) + "I" * (conversations.ENDING[state] // 3)
    faults = ["blank" if r is None else "truncated" if p else "" for r, p, _ in rows]
    cost, least, _ = cheapest([(0, i, r or "", str(i)) for i, (r, _, _) in enumerate(rows)], faults)
    matrix = conversations.transfer(rows)
    assert audit == least
    assert min(m + e for m, e in zip(matrix[:4], conversations.ENDING, strict=True)) == cost


# -- token files ------------------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " ", "It's  'S don't.", "a≠b é. ́x ,.̸", "<|endoftext|> <|ENDOFTEXT|>.", "Ünïcode ΑΣ. ΑΣΣ İ ß", "x y z.　w",
    "123,456.78", "tab\tand\nline\x0bvt\x0cff\x1cfs\x85nel", "€. ,€ ½. ²,", "漢字。かな カナ!!", "한국어 ᄀ ᅡ ᆨ", "emoji 👩‍👩‍👧. ok", "word." * 50,
]


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n.,'-<|>aZé̸́ß1½€Σ漢")), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_encoder_equals_the_library(texts):
    lengths, ids = ENCODER.encode([t.encode() for t in texts])
    expected = plain_ids_of(texts)
    assert lengths.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


ENCODER = tokens.Encoder(WORDS)


def plain_ids_of(texts):
    return [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_the_text():
    text = ("some words\nof a text " * 1000).encode()
    assert b"".join(tokens.cut(text, 100)) == text
    assert max(map(len, tokens.cut(text, 100))) < 120
    assert list(tokens.cut(b"x" * 1000, 100)) == [b"x" * 1000]


def document_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["Some", "words,", "größer.", "12"], k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(5000, "one id, many rows")] * 100 + [(None, f"no id {i}.") for i in range(5)] + [(2000, "word " * 30_000)]
    return rows


def test_op12_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "FILE", 40_000)
    rows = document_rows()
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_token_id_binary_output"](spark, str(tmp_path)).collect()
    expected = sorted((k is None, k or 0, len(ids) + 1, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in [*ids, 1]))) for (k, _), ids in zip(rows, plain_ids([t for _, t in rows]), strict=True))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    assert ids[-5:] == [None] * 5


def test_files_have_stripes_and_prune_by_id(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(str(rng.random()) for _ in range(400))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = f"{tmp_path}/ids"
    tokens.write_token_ids(docs, path, WORDS, end_id=1, stripe=1 << 16, stride=1000, file_bytes=8 << 20)
    files = sorted(glob.glob(f"{path}/part-*.orc"))
    assert len(files) > 1
    first = orc.ORCFile(files[0])
    assert first.nstripes > 1
    stripes = [first.read_stripe(i, columns=["doc_id"]).column(0).to_pylist() for i in range(first.nstripes)]
    assert [x for s in stripes for x in s] == sorted(x for s in stripes for x in s)
    read = tokens.read_token_ids(spark, path).where("doc_id = 77")
    assert "EqualTo(doc_id,77)" in read._jdf.queryExecution().executedPlan().toString()
    ids = [i for r in read.orderBy("seq").collect() for i in r.ids]
    assert ids == plain_ids([rows[77][1]])[0] + [1]


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_token_id_binary_output"](spark, str(tmp_path)).collect() == []
    assert QUERIES["op13_fill_in_middle"](spark, str(tmp_path)).collect() == []


# -- fill in the middle -----------------------------------------------------------------------


def plain_infill(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(lines)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def infill_rows():
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a", "ß漢", "\n", "word ", "\r\n", "<", "P>"]) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "has <M> in it\n"), (503, "\n"), (504, "\n\n\n"), (None, "a\nb\nc"), (505, "x" * 5000), (506, "line\n" * 3000), (506, "line\n" * 3000)]
    return rows


@pytest.mark.parametrize("frame", [1 << 16, 7])
def test_op13_query(spark, tmp_path, frame):
    rows = infill_rows()
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, output string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    expected = sorted((plain_infill(*r) for r in rows), key=str)
    if frame == 7:
        for k, t in rows:
            text = infill.Frames.of([t or ""], frame)
            form, prefix, middle, output = infill.transformed(text, k, 7, 100, 50)
            small = infill.Frames.of(output.read(0, len(output)), frame)
            row = (k, text.lines(), form, prefix, middle, small.sha256(), small.sha256(infill.restored_spans(small, form)))
            assert row == plain_infill(k, t)
        return
    found = QUERIES["op13_fill_in_middle"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


@given(st.text(alphabet="ab\nß<P>", max_size=60), st.integers(1, 9), st.data())
@settings(max_examples=200, deadline=None)
def test_frames_are_seekable(text, frame, data):
    frames = infill.Frames.of([text[:10], text[10:]], frame)
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert len(frames) == len(text)
    assert frames.lines() == len(lines)
    n = data.draw(st.integers(0, len(lines)))
    assert frames.behind_line(n) == len("".join(lines[:n]))
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(a, len(text)))
    assert "".join(frames.read(a, b)) == text[a:b]
    place = text.find("<P>", a)
    assert frames.find(("<P>",), a) == (None if place < 0 else (place, "<P>"))


def test_selection_opens_only_the_frames_of_its_cuts(monkeypatch):
    frames, opened = infill.Frames.of(["line\n" * 10_000], 100), []
    plain = infill.Frames.frame
    monkeypatch.setattr(infill.Frames, "frame", lambda self, i: opened.append(i) or plain(self, i))
    assert frames.behind_line(5_000) == 25_000
    assert "".join(frames.read(25_000, 25_005)) == "line\n"
    assert len(opened) == 2


def test_output_column_holds_the_text(spark):
    rows = [(i, f"first {i}\nsecond\nthird\n") for i in range(20)]
    made = infill.fill_in_middle(infill.in_frames(spark.createDataFrame(rows, "doc_id long, text string")), seed=7, spm=0)
    for r in made.select("doc_id", "form", infill.text_of(F.col("output")).alias("text")).collect():
        assert r.form == "psm"
        assert r.text.startswith("<P>")
        assert re.sub("<S>(.*)<M>(.*)", r"\2\1", r.text[3:], flags=re.S) == rows[r.doc_id][1]
