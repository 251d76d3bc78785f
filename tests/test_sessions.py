"""The session-log grammar: hand-written cases and random texts against a line model."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.operators import sessions as S

DAY = dt.date(2020, 6, 23)


def files_of(spark, *texts):
    rows = [(f"f{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "source_file STRING, content STRING")


def parsed(spark, *texts):
    return [frame.collect() for frame in S.parse_sessions(files_of(spark, *texts))]


def test_quick_search_with_result_and_open(spark):
    searches, opens, warnings = parsed(
        spark,
        "SESSION_START 23.06.2020_03:53:29\nQS 23.06.2020_03:55:06 {some words}\n"
        "276 LAW_1 ACC_2\nDOC_OPEN 23.06.2020_03:56:47 276 ACC_2\n",
    )
    assert [tuple(r) for r in searches] == [("f0", "276", "QS", DAY, ["LAW_1", "ACC_2"], 3)]
    assert [tuple(r) for r in opens] == [("f0", "276", "ACC_2", DAY, 4)]
    assert warnings == []


def test_card_search_with_parameters(spark):
    searches, _, warnings = parsed(
        spark,
        "CARD_SEARCH_START Fri,_26_Jun_2020_16:24:28_+0300\n$134 слова запроса\n"
        "CARD_SEARCH_END \n-26 PKBO_1 ACC_2\n",
    )
    assert [tuple(r) for r in searches] == [
        ("f0", "-26", "CARD", dt.date(2020, 6, 26), ["PKBO_1", "ACC_2"], 4)
    ]
    assert warnings == []


def test_undated_open_and_short_open(spark):
    _, opens, warnings = parsed(spark, "DOC_OPEN  518 PAP_1\r\nDOC_OPEN 518\r\n")
    assert [tuple(r) for r in opens] == [("f0", "518", "PAP_1", None, 1)]
    assert [tuple(r) for r in warnings] == [("f0", 2, S.WARN_OPEN_FIELDS)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("QS 23.06.2020_03:55:06 {q}\nDOC_OPEN 1 2\n", [(1, S.WARN_QUICK_RESULT)]),
        ("QS soon {q}\n1 A\n", [(1, S.WARN_QUICK_DATE)]),
        ("QS 99.99.2020_00:00:00 {q}\n1 A\n", [(1, S.WARN_QUICK_DATE)]),
        ("CARD_SEARCH_START 01.01.2020_00:00:00\n$0 x\n", [(1, S.WARN_CARD_END)]),
        ("CARD_SEARCH_START\nCARD_SEARCH_END\n7 A\n", [(1, S.WARN_CARD_DATE)]),
        ("\nCARD_SEARCH_START 01.01.2020_00:00:00\nCARD_SEARCH_END\nx\n", [(3, S.WARN_CARD_RESULT)]),
        ("CARD_SEARCH_START 01.01.2020_00:00:00\nCARD_SEARCH_END", [(2, S.WARN_CARD_RESULT)]),
        ("DOC_OPEN soon 1 A\n", [(1, S.WARN_OPEN_DATE)]),
        ("QS  \n1 A\n", []),
        ("", []),
        ("CARD_SEARCH_END\n1 A\n", []),
    ],
)
def test_warnings(spark, text, expected):
    assert [(w.line_number, w.message) for w in parsed(spark, text)[2]] == expected


def test_block_hides_what_is_inside(spark):
    searches, opens, _ = parsed(
        spark,
        "CARD_SEARCH_START 01.01.2020_00:00:00\nQS 01.01.2020_00:00:00 q\n5 X\nDOC_OPEN 5 X\n"
        "CARD_SEARCH_START 02.01.2020_00:00:00\nCARD_SEARCH_END\n6 Y\nDOC_OPEN 6 Y\n",
    )
    assert [(s.search_id, s.event_date, s.line_number) for s in searches] == [
        ("6", dt.date(2020, 1, 1), 7)
    ]
    assert [(o.search_id, o.line_number) for o in opens] == [("6", 8)]


def test_usage_marts(spark):
    text = (
        "QS 01.02.2020_00:00:00 {q}\n1 A B\nDOC_OPEN 1 A\nDOC_OPEN 03.02.2020_00:00:00 1 B\n"
        "DOC_OPEN 1 MISSING\nDOC_OPEN 9 A\nCARD_SEARCH_START 01.02.2020_00:00:00\n$0 A\n"
        "CARD_SEARCH_END\n2 A\nDOC_OPEN 2 A\n"
    )
    files = files_of(spark, text, text)
    searches, opens, _ = S.parse_sessions(files)
    by_day = S.doc_opens_by_day(searches, opens)
    assert sorted(tuple(r) for r in by_day.collect()) == [
        (dt.date(2020, 2, 1), "A", 2),
        (dt.date(2020, 2, 3), "B", 2),
    ]
    assert S.card_doc_hits(S.card_searches(files), "A").first().card_search_count == 2
    assert S.card_param_hits(files, "A").first().card_search_count == 2
    assert S.orphan_opens(searches, opens).count() == 2
    cards = searches.filter("search_type = 'CARD'").select("source_file", "search_id", "documents")
    assert sorted(cards.collect()) == sorted(S.card_searches(files).collect())
    few = S.session_events(files, ("QS", "OPEN"))
    assert sorted(S.doc_opens_of(few).collect()) == sorted(opens.collect())
    top = S.doc_opens_of_top(by_day, 2)
    assert sorted(tuple(r)[1:] for r in top.collect()) == [(1, "A", 2), (2, "B", 2)]
    wide = S.widened(top).orderBy("date")
    assert wide.columns == ["date", "open_count_A", "open_count_B"]
    assert [tuple(r)[1:] for r in wide.collect()] == [(2, 0), (0, 2)]


# --- random texts -----------------------------------------------------------------------------

LINES = [
    "QS 01.02.2020_10:00:00 {a}", "QS never {a}", "QS", " \tQS 01.02.2020_10:00:00", "QSX 1",
    "CARD_SEARCH_START 02.02.2020_10:00:00", "CARD_SEARCH_START", "CARD_SEARCH_STARTED x y",
    "CARD_SEARCH_END", "  CARD_SEARCH_END ", "$0 A", "5 A B", "-6", " 7  C\t", "8x A", "",
    "DOC_OPEN 5 A", "DOC_OPEN 01.02.2020_10:00:00 5 A more", "DOC_OPEN", "DOC_OPENING bad 5 A",
    "Sun,_1_Mar_2020_00:00:00_+0300", "QS Sun,_1_Mar_2020_00:00:00_+0300 x", "\x01QS 1 2",
]


def line_model(text):
    """Events and warnings by reading line after line with a cursor."""
    lines = [line.strip("".join(map(chr, range(33)))) for line in re.split(r"\r?\n", text)]
    searches, opens, warnings = [], [], []

    def day(words):
        token = words[1] if len(words) > 1 else ""
        if re.fullmatch(r"\d\d\.\d\d\.\d{4}_\d\d:\d\d:\d\d", token):
            return dt.datetime.strptime(token, "%d.%m.%Y_%H:%M:%S").date()
        if token.startswith("Sun,"):
            return dt.datetime.strptime(token[:-6], "%a,_%d_%b_%Y_%H:%M:%S").date()
        return None

    def answer(at):
        words = lines[at].split() if at < len(lines) else []
        return words if words and re.fullmatch(r"-?\d+", words[0]) else None

    cursor = iter(range(len(lines)))
    for at in cursor:
        line, words = lines[at], lines[at].split()
        if line.startswith("DOC_OPEN"):
            if len(words) < 3:
                warnings.append((at + 1, S.WARN_OPEN_FIELDS))
            else:
                dated = len(words) > 3
                when = day(words) if dated else None
                if dated and when is None:
                    warnings.append((at + 1, S.WARN_OPEN_DATE))
                opens.append((*words[1 + dated : 3 + dated], when, at + 1))
        elif line.startswith("QS "):
            if day(words) is None:
                warnings.append((at + 1, S.WARN_QUICK_DATE))
            if found := answer(at + 1):
                searches.append((found[0], "QS", day(words), found[1:], at + 2))
            else:
                warnings.append((at + 1, S.WARN_QUICK_RESULT))
        elif line.startswith("CARD_SEARCH_START"):
            if day(words) is None:
                warnings.append((at + 1, S.WARN_CARD_DATE))
            end = next((i for i in range(at, len(lines)) if lines[i].startswith("CARD_SEARCH_END")), None)
            if end is None:
                warnings.append((at + 1, S.WARN_CARD_END))
                continue
            while next(cursor) < end:
                pass
            if found := answer(end + 1):
                searches.append((found[0], "CARD", day(words), found[1:], end + 2))
            else:
                warnings.append((end + 1, S.WARN_CARD_RESULT))
    return sorted(map(repr, searches)), sorted(map(repr, opens)), sorted(map(repr, warnings))


texts = st.lists(
    st.tuples(st.lists(st.sampled_from(LINES), max_size=14), st.sampled_from(["\n", "\r\n"])).map(
        lambda x: x[1].join(x[0])
    ),
    min_size=150,
    max_size=150,
)


@settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.large_base_example, HealthCheck.data_too_large, HealthCheck.too_slow],
)
@given(texts)
def test_random_texts_equal_the_line_model(spark, batch):
    searches, opens, warnings = parsed(spark, *batch)
    for i, text in enumerate(batch):
        mine = tuple(
            sorted(repr(tuple(r)[1:]) for r in rows if r.source_file == f"f{i}")
            for rows in (searches, opens, warnings)
        )
        assert mine == line_model(text), text


def in_blocks(spark, texts_, size):
    rows = []
    for i, text in enumerate(texts_):
        lines = text.split("\n")
        rows += [(f"f{i}", at // size, "\n".join(lines[at : at + size])) for at in range(0, len(lines), size)]
    return S.block_context(spark.createDataFrame(rows, "source_file STRING, block INT, content STRING"))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts, st.integers(1, 5))
def test_blocks_of_any_size_give_the_same_events(spark, batch, size):
    whole = [sorted(map(str, frame)) for frame in parsed(spark, *batch)]
    cut = [sorted(map(str, frame.collect())) for frame in S.parse_sessions(in_blocks(spark, batch, size))]
    assert cut == whole
    cards = sorted(map(str, S.card_searches(files_of(spark, *batch)).collect()))
    assert sorted(map(str, S.card_searches(in_blocks(spark, batch, size)).collect())) == cards


def test_card_over_many_blocks(spark):
    text = "QS 01.01.2020_00:00:00 {q}\n7 A\nCARD_SEARCH_START 02.01.2020_00:00:00\n" + "$0 x\nDOC_OPEN 7 A\n" * 20
    text += "CARD_SEARCH_START soon\nCARD_SEARCH_END\n9 B\nDOC_OPEN 9 B\nCARD_SEARCH_START 03.01.2020_00:00:00\n$1 y\nDOC_OPEN 7 A\n"
    want = [[tuple(r) for r in frame.orderBy("line_number").collect()] for frame in S.parse_sessions(files_of(spark, text))]
    assert [r[1] for r in want[0]] == ["7", "9"] and len(want[2]) == 1
    for size in (1, 2, 3, 7):
        got = [[tuple(r) for r in frame.orderBy("line_number").collect()] for frame in S.parse_sessions(in_blocks(spark, [text], size))]
        assert got == want


def test_large_files_are_read_in_blocks(spark, tmp_path):
    """A file over many splits gives the events of the whole file."""
    from tidemark.sources.readers import read_session_blocks, read_session_files

    session = "QS 01.01.2020_00:00:00 {q}\n%d A\nCARD_SEARCH_START 02.01.2020_00:00:00\n$0 x\nDOC_OPEN 7 A\nCARD_SEARCH_END\n%d B\nDOC_OPEN %d A\n"
    (tmp_path / "one").write_text("".join(session % (i, -i, i) for i in range(3000)))
    (tmp_path / "two").write_text("DOC_OPEN 1\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        blocks = read_session_blocks(spark, str(tmp_path), 64)
        assert blocks.select("block.split").distinct().count() > 5
        got = [sorted(map(tuple, frame.collect()), key=str) for frame in S.parse_sessions(S.block_context(blocks))]
        lines = S.session_lines(S.block_context(blocks)).where("line = 'DOC_OPEN 2999 A'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    want = [sorted(map(tuple, frame.collect()), key=str) for frame in S.parse_sessions(read_session_files(spark, str(tmp_path)))]
    assert got == want and len(got[0]) == 6000
    assert [r.line_number for r in lines] == [24_000]


def test_lines_are_found_and_trimmed_without_patterns(spark):
    """Trimming looks at both ends of a text and gives what trimming all of it gives; lines and dates as before."""
    from pyspark.sql import functions as F

    from tidemark.functions.text import EDGE_BLANKS, trim_blanks

    edges = ["", " ", "\t", "\x00", "\x1f ", "é", "\u0085", "　", "!", "~"]
    rows = [(a + middle + b,) for a in edges for b in edges for middle in ("", "x", "a b", "ж")] + [(None,)]
    trimmed = spark.createDataFrame(rows, "t STRING").select("t", trim_blanks(F.col("t")).alias("trimmed"))
    assert all(r.trimmed == (r.t if r.t is None else r.t.strip(EDGE_BLANKS)) for r in trimmed.collect())
    events = S.session_events(files_of(spark, " QS  \nQS \n\x01QS 1 2\nQS"))
    assert [r.line_number for r in events.collect()] == [3]
    parsed_plan = S.parse_warnings_of(events)._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(line" not in parsed_plan and "regexp_extract" not in parsed_plan


def test_sessions_are_dealt_in_a_stated_number_of_parts(spark, small_lines):
    """Parts sized by the narrow columns are too few for the text: here they would be one."""
    from tidemark.plans.sessions import session_files
    from tidemark.sources.tables import Tables

    files = session_files(Tables(spark, small_lines))
    assert files.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


@pytest.fixture
def small_lines(spark, tmp_path):
    """Line items with rows of one key and of no key."""
    columns = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_returnflag STRING, l_shipdate TIMESTAMP"
    day = dt.datetime(2020, 6, 23)
    rows = [(i // 7, i % 200, i % 10, i % 7 + 1, "NRA"[i % 3], day) for i in range(700)] + [(1, 1, 1, 1, "N", day)] * 2 + [(None, 1, 1, 2, "N", day)] * 2
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_joins_by_search_sort_by_a_digest_first(spark):
    """Rows of one name meet as before, null names never; the first sort key is the digest."""
    searches = spark.createDataFrame([("f", "1", "QS", DAY, ["A", "B"], 2)] * 2 + [(None, "1", "QS", DAY, ["A"], 2)], "source_file STRING, search_id STRING, search_type STRING, event_date DATE, documents ARRAY<STRING>, line_number INT")
    opens = spark.createDataFrame([("f", "1", "A", None, 3)] * 3 + [("f", "2", "A", DAY, 4), (None, "1", "A", DAY, 5)], "source_file STRING, search_id STRING, document_id STRING, event_date DATE, line_number INT")
    found, orphans = S.found_opens(searches.hint("merge"), opens), S.orphan_opens(searches.hint("merge"), opens)
    assert found.columns == ["source_file", "search_id", "document_id", "line_number", "date", "date_restored"]
    assert orphans.columns == opens.columns
    assert [tuple(r)[2:] for r in found.collect()] == [("A", 3, DAY, True)] * 6
    assert sorted(r.line_number for r in orphans.collect()) == [4, 5]
    for joined in (found, orphans):
        assert "[_key" in joined._jdf.queryExecution().executedPlan().toString()


def test_events_without_names_are_stored_and_counted(spark, small_lines):
    from tidemark.plans import QUERIES

    events = S.session_events(files_of(spark, "QS 01.01.2020_00:00:00 {q}\n7 A B\nDOC_OPEN 7 A\n"))
    nameless = events.drop("source_file")
    for part in (S.searches_of, S.doc_opens_of):
        assert part(nameless).collect() == part(events).drop("source_file").collect()
    plan = QUERIES["session_events"](spark, small_lines)._jdf.queryExecution().analyzed().toString()
    assert "words" in plan and "source_file" not in plan


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts, st.integers(1, 5))
def test_context_by_windows_that_carry_the_text(spark, batch, size):
    blocks = in_blocks(spark, batch, size).select("source_file", "block", "content")
    joined = sorted(map(str, S.block_context(blocks).collect()))
    carried = S.block_context(blocks, together=True)
    assert sorted(map(str, carried.select(S.block_context(blocks).columns).collect())) == joined
    assert sorted(map(str, S.session_events(carried).collect())) == sorted(map(str, S.session_events(S.block_context(blocks)).collect()))


def test_shares_hold_every_file_once_in_stated_parts(spark, small_lines):
    from pyspark.sql import functions as F

    from tidemark.plans.sessions import session_blocks
    from tidemark.sources.tables import Tables

    t = Tables(spark, small_lines)
    shares = [session_blocks(t, 4, share, 3) for share in range(3)]
    assert all(blocks.count() > 500 for blocks in shares)
    named = [F.substring_index("source_file", "#", 1).alias("name"), "block", "content"]
    dealt = sorted(row for blocks in shares for row in blocks.select(*named).collect())
    assert dealt == sorted(session_blocks(t, 4).select(*named).collect())
    assert sum(blocks.select("source_file").distinct().count() for blocks in shares) == 704  # line items
    context = S.block_context(shares[0], together=True)
    assert context.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


def test_shares_leave_their_counts_alone(spark, small_lines, monkeypatch):
    """Neither events nor blocks nor shuffles of a share outlive it; what is counted is that of whole files."""
    import os
    import time

    from tidemark.plans import QUERIES, sessions

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return set(re.findall(r"shuffle_(\d+)_", files))

    def stages():
        folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "tidemark")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    want = sorted(map(str, QUERIES["session_events"](spark, small_lines).collect()))
    monkeypatch.setattr(sessions, "SHARE_BYTES", 1, raising=False)
    monkeypatch.setattr(sessions, "MOST_SHARES", 3, raising=False)
    stages_before, shuffles_before = stages(), shuffles()
    counted = QUERIES["session_events_blocks"](spark, small_lines)
    assert [name.split("-")[0] for name in stages() - stages_before] == ["days"] * 3
    for _ in range(50):  # they are removed a moment later
        if not shuffles() - shuffles_before:
            break
        time.sleep(0.2)
    assert not shuffles() - shuffles_before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert sorted(map(str, counted.collect())) == want
