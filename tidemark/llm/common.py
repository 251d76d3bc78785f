"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: The words of a text are the runs without a space or the controls tab to return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, in lists cut from about ``size`` bytes each, so that a very
    long text is never held as one list of words."""
    at, end = 0, len(text)
    while at < end:
        gap = _GAP.search(text, min(at + size, end))
        stop = gap.start() if gap else end
        yield text[at:stop].split()
        at = stop + 1


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts: the figure that chunks and buckets are sized by."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def pieces(total: int, each: int) -> int:
    """How many parts of about ``each`` bytes make up ``total``."""
    return max(1, math.ceil(total / each))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A to Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hex64(column: Column) -> Column:
    """A long as 16 lowercase hex digits, its sign bit being the first binary digit."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct named ``row``, whatever they are called; ``row.*``
    unpacks it again."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a table that is described as in SQL."""
    return to_arrow_schema(StructType.fromDDL(ddl))
