"""Fill-in-the-middle order over seekable compressed text.

A text is stored as independent zstandard frames of about ``FRAME`` characters, each with the number
of characters and of line ends up to its own end. A cut at a line is found by the counts and only its
frame is decompressed; an output is the frames between the cuts, streamed in their new order into
frames of its own. No text has to be decompressed as a whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema

# The markers ahead of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Characters in a frame.
FRAME = 1 << 16
FRAMES = "array<struct<chars:bigint,line_ends:bigint,data:binary>>"


class Frames:
    """A text in compressed frames; ``chars`` and ``line_ends`` are the counts up to each frame's end."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.chars = [r["chars"] for r in rows]
        self.line_ends = [r["line_ends"] for r in rows]
        self._reader = zstandard.ZstdDecompressor()

    @staticmethod
    def of(texts: Iterable[str], frame: int = FRAME) -> Frames:
        """Frames of texts that follow one another."""
        writer = zstandard.ZstdCompressor(level=3)
        rows: list[dict] = []
        chars = line_ends = 0
        waiting: list[str] = []
        size = 0

        def add(text: str) -> None:
            nonlocal chars, line_ends
            chars, line_ends = chars + len(text), line_ends + text.count("\n")
            rows.append({"chars": chars, "line_ends": line_ends, "data": writer.compress(text.encode())})

        for text in texts:
            at = 0
            while at < len(text):
                part = text[at : at + frame - size]
                waiting.append(part)
                at, size = at + len(part), size + len(part)
                if size == frame:
                    add("".join(waiting))
                    waiting, size = [], 0
        if size:
            add("".join(waiting))
        return Frames(rows)

    def __len__(self) -> int:
        return self.chars[-1] if self.rows else 0

    def frame(self, i: int) -> str:
        return self._reader.decompress(self.rows[i]["data"]).decode()

    def lines(self) -> int:
        """Lines, the last of which may have no end."""
        if not self.rows:
            return 0
        return self.line_ends[-1] + (not self.frame(len(self.rows) - 1).endswith("\n"))

    def behind_line(self, n: int) -> int:
        """Characters in the first ``n`` lines; one frame is decompressed for it."""
        if not n:
            return 0
        i = bisect_left(self.line_ends, n)
        if i == len(self.rows):  # the last line has no end
            return len(self)
        text, at = self.frame(i), 0
        for _ in range(n - (self.line_ends[i - 1] if i else 0)):
            at = text.index("\n", at) + 1
        return (self.chars[i - 1] if i else 0) + at

    def read(self, start: int, stop: int) -> Iterator[str]:
        """The characters from ``start`` to ``stop``, a frame at a time."""
        i = bisect_left(self.chars, start + 1)
        while start < stop:
            before = self.chars[i - 1] if i else 0
            text = self.frame(i)
            yield text[start - before : stop - before]
            start, i = self.chars[i], i + 1

    def find(self, words: tuple[str, ...], start: int = 0) -> tuple[int, str] | None:
        """Where the first of ``words`` begins, at or behind ``start``; it may lie across frames."""
        longest, held, at = max(map(len, words)), "", start
        for text in self.read(start, len(self)):
            held += text
            found = [(held.index(w), w) for w in words if w in held]
            if found:
                place, word = min(found)
                return at + place, word
            keep = min(len(held), longest - 1)
            at, held = at + len(held) - keep, held[len(held) - keep :]
        return None

    def sha256(self, spans: Iterable[tuple[int, int]] | None = None) -> str:
        digest = hashlib.sha256()
        for span in [(0, len(self))] if spans is None else spans:
            for text in self.read(*span):
                digest.update(text.encode())
        return digest.hexdigest()


def choices(seed: int, doc_id: object) -> list[int]:
    """Four numbers below 2**32 that depend on the seed and the id alone."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(text: Frames, doc_id: object, seed: int, rate: int, spm: int) -> tuple[str, int | None, int | None, Frames]:
    """Form, characters of prefix and middle, and the output."""
    first, second, chance, order = choices(seed, doc_id)
    if not text.rows or chance % 100 >= rate or text.find(MARKERS):
        return "plain", None, None, text
    n = text.lines()
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = text.behind_line(low), text.behind_line(high)
    form = "spm" if order % 100 < spm else "psm"
    spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}

    def output() -> Iterator[str]:
        for marker in ORDERS[form]:
            yield marker
            yield from text.read(*spans[marker])

    return form, a, b - a, Frames.of(output())


def restored_spans(output: Frames, form: str) -> list[tuple[int, int]]:
    """Where prefix, middle and suffix lie in an output, by its markers alone."""
    if form == "plain":
        return [(0, len(output))]
    marks, at = [], 0
    for _ in MARKERS:
        place, word = output.find(MARKERS, at)
        marks.append((word, place))
        at = place + len(word)
    ends = [place for _, place in marks[1:]] + [len(output)]
    spans = {word: (place + len(word), end) for (word, place), end in zip(marks, ends, strict=True)}
    return [spans[PREFIX], spans[MIDDLE], spans[SUFFIX]]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Row by row, so that one list of frames at a time is a Python object."""
    return zip(*batch.columns, strict=True)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` bytes of frames."""
    held, bytes_held = [], 0
    for row in rows:
        held.append(row)
        bytes_held += 200 + sum(len(f["data"]) for f in row.get("frames") or row.get("output") or ())
        if bytes_held >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, bytes_held = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def in_frames(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, frames) of whole texts; a null text has no frames."""
    ddl = f"doc_id {docs.schema[key].dataType.simpleString()}, frames {FRAMES}"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({"doc_id": k.as_py(), "frames": Frames.of([t.as_py() or ""]).rows} for b in batches for k, t in _rows(b))
        return _batches(rows, schema)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")).mapInArrow(run, ddl)


def fill_in_middle(framed: DataFrame, seed: int, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for texts in frames.

    Of ``n`` lines, the middle lies between two cuts that the id chooses. ``rate`` percent of the
    documents are transformed and ``spm`` percent of those begin with the suffix; an empty text and
    one that holds a marker stay plain, with null counts. ``output`` is in frames. A null id chooses
    as an empty one would; equal rows give equal rows, an empty table none.
    """
    ddl = f"doc_id {framed.schema['doc_id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output {FRAMES}"
    schema = arrow_schema(ddl)

    def one(doc_id: object, rows: list[dict]) -> dict:
        text = Frames(rows or [])
        form, prefix, middle, output = transformed(text, doc_id, seed, rate, spm)
        return {"doc_id": doc_id, "n": text.lines(), "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": output.rows}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((one(k.as_py(), f.as_py()) for b in batches for k, f in _rows(b)), schema)

    return framed.select("doc_id", "frames").mapInArrow(run, ddl)


def digests(made: DataFrame) -> DataFrame:
    """The rows of :func:`fill_in_middle` with the digests of the output and of the text rebuilt
    from it, in place of the output; both are streamed from its frames."""
    kept = made.drop("output")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", output_sha256 string, restored_sha256 string"
    names = [*kept.columns, "output_sha256", "restored_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for form, rows in zip(batch.column(names.index("form")), batch.column(len(names) - 2), strict=True):
                output = Frames(rows.as_py())
                found.append((output.sha256(), output.sha256(restored_spans(output, form.as_py()))))
            columns = [batch.column(i) for i in range(len(names) - 2)]
            shas = [pa.array([x[i] for x in found], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*columns, *shas], names=names)

    return made.select(*kept.columns, "output").mapInArrow(run, ddl)


def text_of(frames: Column) -> Column:
    """The text of a column of frames, for texts that fit a row."""

    @F.pandas_udf("string")
    def joined(rows):
        return rows.map(lambda frames: "".join(Frames(list(frames)).read(0, frames[-1]["chars"])) if len(frames) else "")

    return joined(frames)
