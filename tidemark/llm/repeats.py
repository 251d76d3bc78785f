"""Which fixed-length windows of a corpus repeat, found over sampled anchors without pairs.

Shared by the word-level and the byte-level operator. A text is a row of symbols with 64-bit
identifiers. Identifiers of longer grams are built from identifiers of shorter ones at later
offsets (``gram_ids``), so equal text has equal identifiers on every executor. The smallest gram of
a window is its anchor: equal windows have equal anchors at the same place. Consecutive windows
with one anchor form a run. Texts are dealt into chunks by row, and four rounds follow:

1. anchors: those seen once in the corpus are dropped, and with them most of the text;
2. runs: the left and right context of a shared anchor; runs that repeat as a whole are settled;
3. windows, only of runs that share an anchor but differ in context, one copy of each run;
4. covered spans of each text.

Rounds 1 to 3 send each distinct identifier of a chunk once, whatever the number of copies in it,
to a bucket and get a verdict back. The number of buckets goes by the bytes of the corpus. Anchors
and runs are dealt by anchor, windows by anchor and content: the runs of one anchor, 24 bytes for
each context it has in a chunk, meet in one bucket, which is not split; its windows spread. Nothing
is capped, no list of occurrences is ever built, and verdicts go by identifiers of 64 bits twice
over (anchor and content).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, text_bytes

U = np.uint64
#: Texts of about this size make a chunk, and anchors of about this many bytes of text a bucket.
CHUNK_BYTES, BUCKET_BYTES = 1 << 20, 8 << 20
#: Symbols looked at together; a longer text is cut, its parts overlapping by a window.
SEGMENT = 1 << 18
#: Verdicts on a run: repeated as a whole; to be looked at window by window; its windows are needed.
WHOLE, OPEN, NEEDED = 1, 2, 4

MESSAGE = "bucket int, chunk long, body binary"


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """An identifier of the ordered pair of two identifiers."""
    x = a * U(0x9E3779B97F4A7C15) + b * U(0xC2B2AE3D27D4EB4F) + U(0x165667B19E3779F9)
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    return x


def gram_ids(ids: np.ndarray, length: int, target: int) -> np.ndarray:
    """Identifiers of ``target`` symbols from identifiers of ``length``: those of a position and of
    a later offset give the next ones, which are used again, until the length is reached."""
    while length < target:
        step = min(length, target - length)
        ids = mix(ids[:-step], ids[step:]) if len(ids) > step else ids[:0]
        length += step
    return ids


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost smallest of each ``width`` consecutive values."""
    value, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        later = value[step:] < value[:-step]
        value = np.where(later, value[step:], value[:-step])
        at = np.where(later, at[step:], at[:-step])
        have += step
    return at


@dataclass(frozen=True)
class Rule:
    """``window`` symbols must repeat; anchors are grams of ``gram`` symbols.

    ``earlier``: a window counts if a text of a smaller id has it; else if it starts anywhere else.
    ``symbols`` cuts a text into an array of symbols, and ``identify`` gives such arrays their
    identifiers; texts are held as the former, the latter are made for a part at a time.
    """

    window: int
    gram: int
    earlier: bool
    symbols: Callable[[bytes], np.ndarray]
    identify: Callable[[np.ndarray], np.ndarray]


@dataclass
class Runs:
    """Runs of a chunk: anchor, content, owning text, first symbol, number of windows."""

    anchor: np.ndarray
    content: np.ndarray
    text: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def take(self, which: np.ndarray) -> Runs:
        return Runs(self.anchor[which], self.content[which], self.text[which], self.start[which], self.count[which])


def _segments(texts: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols laid end to end, with the text and the place of each: pieces of long texts overlap
    by ``window - 1`` symbols, so that every window lies in exactly one segment."""
    parts: list[tuple[np.ndarray, int, int]] = []
    held = 0

    def laid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(x) for x, _, _ in parts]
        owner = np.repeat(np.array([t for _, t, _ in parts]), sizes)
        place = np.concatenate([np.arange(p, p + n) for (_, _, p), n in zip(parts, sizes, strict=True)])
        return np.concatenate([x for x, _, _ in parts]), owner, place

    for number, ids in enumerate(texts):
        for at in range(0, max(0, len(ids) - window + 1), SEGMENT):
            part = ids[at : at + SEGMENT + window - 1]
            if held and held + len(part) > SEGMENT + window:
                yield laid()
                parts, held = [], 0
            parts.append((part, number, at))
            held += len(part)
    if parts:
        yield laid()


def _windows(ids: np.ndarray, owner: np.ndarray, place: np.ndarray, rule: Rule):
    """For each whole window of a segment: its first index and anchor place; all identifiers."""
    grams = gram_ids(ids, 1, rule.gram)
    at = smallest_in(grams, rule.window - rule.gram + 1)
    last = slice(rule.window - 1, None)
    whole = (owner[: len(at)] == owner[last]) & (place[last] - place[: len(at)] == rule.window - 1)
    first = np.flatnonzero(whole)
    return first, at[first], grams, gram_ids(grams, rule.gram, rule.window)


def find_runs(texts: list[np.ndarray], rule: Rule) -> Runs:
    found = []
    for symbols, owner, place in _segments(texts, rule.window):
        first, at, grams, contents = _windows(rule.identify(symbols), owner, place, rule)
        if len(first):
            head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(first) != 1)]))
            tail = np.concatenate([head[1:], [len(first)]]) - 1
            i, j = first[head], first[tail]
            content = mix(mix(contents[i], contents[j]), (j - i).astype(U))
            # Mixed again: the smallest identifiers are small numbers, buckets want even ones.
            found.append(Runs(mix(grams[at[head]], U(0)), content, owner[i], place[i], j - i + 1))
    if not found:
        return Runs(*(np.zeros(0, t) for t in (U, U, np.int64, np.int64, np.int64)))
    return Runs(*(np.concatenate([getattr(x, name) for x in found]) for name in ("anchor", "content", "text", "start", "count")))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[k] .. start[k] + count[k]`` for each k, end to end."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def window_ids(texts: list[np.ndarray], runs: Runs, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of ``runs``: the run, the first symbol and the identifier."""
    number = np.arange(len(runs.start))
    run, start = np.repeat(number, runs.count), _ranges(runs.start, runs.count)
    if not len(run):
        return run, start, np.zeros(0, U)
    offset = np.cumsum([0, *map(len, texts)])[runs.text]
    size = runs.count + rule.window - 1
    symbols = np.concatenate(texts)[_ranges(runs.start + offset, size)]
    ids = gram_ids(rule.identify(symbols), 1, rule.window)
    return run, start, ids[_ranges(np.cumsum(size) - size, runs.count)]


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> U(32)) * U(buckets)) >> U(32)


def _sliced(anchor: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The slices of sorted anchors that fall into each bucket."""
    own = _bucket(anchor, buckets)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield int(own[a]), slice(a, b)


def _group(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by the keys, the first one leading: the order, and where each distinct key begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    return order, np.flatnonzero(new)


def _members(order: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The distinct key that each row has, by ``_group``'s result."""
    marks = np.zeros(len(order), np.int64)
    marks[head] = 1
    which = np.zeros(len(order), np.int64)
    which[order] = np.cumsum(marks) - 1
    return which


class Chunk:
    """The texts of one chunk and what each round derives from them again."""

    def __init__(self, ids: list, texts: list[bytes], rule: Rule):
        # Rows come in any order after a shuffle; every round must see the same one.
        order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.rule = rule
        self.rows = order
        self.texts = [rule.symbols(texts[i]) for i in order]
        #: A missing id is larger than any other.
        self.owner = np.array([np.iinfo(np.int64).max if ids[i] is None else ids[i] for i in order], dtype=np.int64)
        self.runs = find_runs(self.texts, rule)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, whether the chunk alone has it twice, and the run's anchor."""
        order, head = _group(self.runs.anchor)
        if self.rule.earlier:
            owner = self.owner[self.runs.text][order]
            twice = np.minimum.reduceat(owner, head) < np.maximum.reduceat(owner, head) if len(head) else np.zeros(0, bool)
        else:
            twice = np.diff(np.append(head, len(order))) > 1
        return self.runs.anchor[order][head], twice, _members(order, head)

    def classes(self, live: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
        """Runs with a shared anchor; of each distinct one its first run, its weight (number of
        runs, or the smallest id), and the class of every run."""
        runs = self.runs.take(live)
        order, head = _group(runs.anchor, runs.content)
        which = _members(order, head)
        if not len(head):
            return runs, head, np.zeros(0, np.int64), which
        if self.rule.earlier:
            weight = np.minimum.reduceat(self.owner[runs.text][order], head)
        else:
            weight = np.diff(np.append(head, len(order)))
        return runs, order[head], weight, which


def _body(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _low48(keys: np.ndarray) -> np.ndarray:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _messages(found: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*found, strict=True)) if found else [[], [], []]
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "chunk": pa.array(columns[1], pa.int64()), "body": pa.array(columns[2], pa.binary())})


def _received(table: pa.Table) -> tuple[list[int], list[int], list[bytes]]:
    return table.column("bucket").to_pylist(), table.column("chunk").to_pylist(), table.column("body").to_pylist()


class Search:
    """The rounds for one rule; a value of this class travels to the tasks."""

    def __init__(self, rule: Rule, buckets: int):
        self.rule, self.buckets = rule, buckets

    # -- the chunks' side -------------------------------------------------------------------

    def _chunk(self, table: pa.Table) -> Chunk:
        return Chunk(table.column("_id").to_pylist(), table.column("_text").to_pylist(), self.rule)

    def send_anchors(self, table: pa.Table) -> pa.Table:
        chunk, number = self._chunk(table), table.column("_chunk")[0].as_py()
        keys, twice, _ = chunk.anchors()
        return _messages([(b, number, _body(_low48(keys[s]), twice[s])) for b, s in _sliced(keys, self.buckets)])

    def _live(self, chunk: Chunk, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        keys, _, which = chunk.anchors()
        live = np.zeros(len(keys), bool)
        for b, s in _sliced(keys, self.buckets):
            live[s] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=s.stop - s.start)
        return live, np.flatnonzero(live[which]) if len(which) else np.zeros(0, np.int64)

    def send_runs(self, table: pa.Table, got: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _messages([])
        chunk, number = self._chunk(table), table.column("_chunk")[0].as_py()
        buckets, _, bodies = _received(got)
        live, which = self._live(chunk, dict(zip(buckets, bodies, strict=True)))
        runs, first, weight, _ = chunk.classes(which)
        anchor, content = runs.anchor[first], runs.content[first]
        out = [(b, number, _body(anchor[s], content[s], weight[s])) for b, s in _sliced(anchor, self.buckets)]
        return _messages([*out, (self._own(number), number, np.packbits(live).tobytes())])

    def _own(self, number: int) -> int:
        """A negative bucket: the message is only handed on to the chunk's next round."""
        return -1 - number % self.buckets

    def _verdicts(self, chunk: Chunk, answers: dict[int, bytes], live: bytes):
        keys, _, anchor_of = chunk.anchors()
        kept = np.unpackbits(np.frombuffer(live, np.uint8), count=len(keys)).astype(bool)
        runs, first, weight, which = chunk.classes(np.flatnonzero(kept[anchor_of]) if len(keys) else np.zeros(0, np.int64))
        verdict = np.zeros(len(first), np.uint8)
        for b, s in _sliced(runs.anchor[first], self.buckets):
            verdict[s] = np.frombuffer(answers[b], np.uint8)
        return runs, first, weight, which, verdict

    def _open_windows(self, chunk: Chunk, runs: Runs, first: np.ndarray, weight: np.ndarray, verdict: np.ndarray):
        """Windows that are asked for, by key and identifier, with their weights, and the runs and
        places they stand for. The key is of anchor and identifier, and with the identifier it tells
        the anchor; only equal windows meet, whatever the number of windows with one anchor."""
        asked = np.flatnonzero(verdict & (OPEN | NEEDED))
        run, start, ids = window_ids(chunk.texts, runs.take(first[asked]), self.rule)
        key = mix(runs.anchor[first[asked]][run], ids) if len(run) else np.zeros(0, U)
        order, head = _group(key, ids)
        value = weight[asked][run][order] if len(run) else np.zeros(0, np.int64)
        if not len(head):
            total = value
        elif self.rule.earlier:
            total = np.minimum.reduceat(value, head)
        else:
            total = np.minimum(np.add.reduceat(np.minimum(value, 2), head), 2)
        return asked[run] if len(run) else run, start, order, head, key[order][head], ids[order][head], total

    def send_windows(self, table: pa.Table, got: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _messages([])
        chunk, number = self._chunk(table), table.column("_chunk")[0].as_py()
        buckets, _, bodies = _received(got)
        answers = dict(zip(buckets, bodies, strict=True))
        live = answers.pop(self._own(number))
        runs, first, weight, _, verdict = self._verdicts(chunk, answers, live)
        _, _, _, _, key, ids, total = self._open_windows(chunk, runs, first, weight, verdict)
        out = [(b, number, _body(key[s], ids[s], total[s])) for b, s in _sliced(key, self.buckets)]
        return _messages([*out, (self._own(number), number, len(live).to_bytes(8, "big") + live + verdict.tobytes())])

    def covered(self, table: pa.Table, got: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """For each row of a chunk: whether each of its symbols is covered."""
        chunk, number = self._chunk(table), table.column("_chunk")[0].as_py()
        buckets, _, bodies = _received(got)
        answers = dict(zip(buckets, bodies, strict=True))
        own = answers.pop(self._own(number))
        size = 8 + int.from_bytes(own[:8], "big")
        keys, _, anchor_of = chunk.anchors()
        kept = np.unpackbits(np.frombuffer(own[8:size], np.uint8), count=len(keys)).astype(bool)
        runs, first, weight, which = chunk.classes(np.flatnonzero(kept[anchor_of]) if len(keys) else np.zeros(0, np.int64))
        verdict = np.frombuffer(own[size:], np.uint8)
        whole = (verdict[which] & WHOLE).astype(bool)
        if self.rule.earlier:  # later texts of the chunk have the whole run from an earlier one
            whole |= chunk.owner[runs.text] > weight[which]
        text, start, stop = [runs.text[whole]], [runs.start[whole]], [(runs.start + runs.count)[whole]]

        klass, place, order, head, key, _, total = self._open_windows(chunk, runs, first, weight, verdict)
        hit = np.zeros(len(head), np.uint8)
        for b, s in _sliced(key, self.buckets):
            hit[s] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=s.stop - s.start)
        of = _members(order, head)
        if len(of):
            repeated = hit[of].astype(bool)
            if self.rule.earlier:
                repeated |= weight[klass] > total[of]
            repeated &= (verdict[klass] & OPEN).astype(bool)
            # The runs of an open class that are not settled: all of them, or those of its first text.
            todo = np.flatnonzero((verdict[which] & OPEN).astype(bool) & ~whole)
            by = np.argsort(klass, kind="stable")
            low, high = (np.searchsorted(klass[by], which[todo], side) for side in ("left", "right"))
            mine, run = by[_ranges(low, high - low)], np.repeat(todo, high - low)
            mine, run = mine[repeated[mine]], run[repeated[mine]]
            moved = place[mine] - runs.start[first[which[run]]] + runs.start[run]
            text.append(runs.text[run])
            start.append(moved)
            stop.append(moved + 1)
        text, start, stop = (np.concatenate(x) for x in (text, start, stop))
        by = np.argsort(text, kind="stable")
        cuts = np.searchsorted(text[by], np.arange(len(chunk.texts) + 1))
        for k, row in enumerate(chunk.rows):
            mine = by[cuts[k] : cuts[k + 1]]
            change = np.zeros(len(chunk.texts[k]) + 1, np.int32)
            np.add.at(change, start[mine], 1)
            np.add.at(change, stop[mine] + self.rule.window - 1, -1)
            yield row, np.cumsum(change[:-1], dtype=np.int32) > 0

    # -- the buckets' side ------------------------------------------------------------------

    def judge(self, table: pa.Table, verdicts: Callable[[list[bytes]], list[bytes]]) -> pa.Table:
        buckets, chunks, bodies = _received(table)
        if buckets[0] < 0:
            return table
        return _messages(list(zip(buckets, chunks, verdicts(bodies), strict=True)))

    def judge_anchors(self, bodies: list[bytes]) -> list[bytes]:
        sizes = [len(x) // 7 for x in bodies]
        keys = np.zeros((sum(sizes), 8), np.uint8)
        keys[:, :6] = np.concatenate([np.frombuffer(x, np.uint8, 6 * n).reshape(n, 6) for x, n in zip(bodies, sizes, strict=True)])
        twice = np.concatenate([np.frombuffer(x, np.uint8, offset=6 * n) for x, n in zip(bodies, sizes, strict=True)])
        order, head = _group(keys.view("<u8").ravel())
        number = np.diff(np.append(head, len(order)))
        shared = (number > 1) | (np.add.reduceat(twice[order].astype(np.int64), head) > 0)
        live = np.zeros(len(order), bool)
        live[order] = np.repeat(shared, number)
        return [np.packbits(x).tobytes() for x in np.split(live, np.cumsum(sizes)[:-1])]

    def _columns(self, bodies: list[bytes]) -> tuple[list[int], list[np.ndarray]]:
        sizes = [len(x) // 24 for x in bodies]
        rows = [np.frombuffer(x, U).reshape(3, n) for x, n in zip(bodies, sizes, strict=True)]
        return sizes, list(np.concatenate(rows, axis=1))

    def judge_runs(self, bodies: list[bytes]) -> list[bytes]:
        sizes, (anchor, content, weight) = self._columns(bodies)
        weight = weight.view(np.int64)
        order, head = _group(anchor, content)
        number = np.diff(np.append(head, len(order)))
        same = anchor[order][head]
        begin = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
        many = np.diff(np.append(begin, len(head)))
        if self.rule.earlier:
            least = np.minimum.reduceat(weight[order], head)
            lowest = np.repeat(np.minimum.reduceat(least, begin), many)
            unsettled = least > lowest  # another context, and a smaller id has the anchor
            verdict = np.where(weight[order] > np.repeat(least, number), WHOLE, 0).astype(np.uint8)
            # The text with the smallest id stands for its run.
            stands = weight[order] == np.repeat(least, number)
        else:
            total = np.add.reduceat(weight[order], head)
            unsettled = (total == 1) & (np.repeat(many, many) > 1)
            verdict = np.where(np.repeat(total, number) > 1, WHOLE, 0).astype(np.uint8)
            stands = np.zeros(len(order), bool)
            stands[head] = True  # a run seen twice lends its windows once, at the weight it has there
        open_anchor = np.repeat(np.logical_or.reduceat(unsettled, begin), many)
        verdict |= np.where(np.repeat(unsettled, number) & stands, OPEN, 0).astype(np.uint8)
        verdict |= np.where(np.repeat(open_anchor, number) & stands, NEEDED, 0).astype(np.uint8)
        out = np.zeros(len(order), np.uint8)
        out[order] = verdict
        return [x.tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]

    def judge_windows(self, bodies: list[bytes]) -> list[bytes]:
        sizes, (key, ids, weight) = self._columns(bodies)
        weight = weight.view(np.int64)
        order, head = _group(key, ids)
        number = np.diff(np.append(head, len(order)))
        if self.rule.earlier:
            hit = weight[order] > np.repeat(np.minimum.reduceat(weight[order], head), number)
        else:
            hit = np.repeat(np.add.reduceat(weight[order], head) > 1, number)
        out = np.zeros(len(order), bool)
        out[order] = hit
        return [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]


def covered_texts(
    docs: DataFrame, rule: Rule, id_column: str, text: str, schema: str, finish: Callable[[list, list, Iterator], pa.Table]
) -> DataFrame:
    """Runs the rounds over ``docs`` and ``finish`` on each chunk.

    ``finish`` gets the ids and texts of a chunk's rows and, for each row, its number and which
    symbols are covered, and makes the result's rows. All rounds read one and the same shuffle of
    the texts. Rows are dealt by id and input partition, so that even rows of one id do not meet in
    one chunk.
    """
    total = text_bytes(docs, text)
    chunks, buckets = pieces(total, CHUNK_BYTES), pieces(total, BUCKET_BYTES)
    search = Search(rule, buckets)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_column), F.spark_partition_id()), F.lit(chunks)).alias("_chunk"),
        F.col(id_column).cast("long").alias("_id"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"),
    )

    def judged(messages: DataFrame, verdicts: Callable) -> DataFrame:
        return messages.groupBy("bucket").applyInArrow(lambda t: search.judge(t, verdicts), MESSAGE)

    def next_round(answers: DataFrame, send: Callable, out: str) -> DataFrame:
        return rows.groupBy("_chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda t, got: send(t, got), out)

    def last(table: pa.Table, got: pa.Table) -> pa.Table:
        ids, texts = table.column("_id").to_pylist(), table.column("_text").to_pylist()
        return finish(ids, texts, search.covered(table, got) if ids else iter(()))

    anchors = judged(rows.groupBy("_chunk").applyInArrow(lambda t: search.send_anchors(t), MESSAGE), search.judge_anchors)
    runs = judged(next_round(anchors, search.send_runs, MESSAGE), search.judge_runs)
    windows = judged(next_round(runs, search.send_windows, MESSAGE), search.judge_windows)
    return next_round(windows, last, schema)


def spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal covered stretches."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *values]), pa.int64()))
