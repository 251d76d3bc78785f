"""Language identification with spans for mixed text.

A text's letters are cut into words. The script of a word narrows the languages it can be in, those
seen with that script in training; letter trigrams give a log likelihood of the word in each of
them; and the Viterbi algorithm labels the words of a text so that the sum of likelihoods, less a
penalty for each switch of language, is largest. Runs of one label are the text's spans.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# First and last code point of the ranges of common scripts.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("arabic", 0xFB50, 0xFEFC), ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F), ("lao", 0xE80, 0xEFF),
    ("tibetan", 0xF00, 0xFFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x323AF),
]
NAMES = sorted({name for name, _, _ in SCRIPTS})

#: Labelled rows per language that the model is fitted on, at most.
SAMPLE = 1000
#: Hash buckets of trigrams, what an unseen one counts, and the penalty for a switch in nats.
BUCKETS, SMOOTHING, SWITCH = 1 << 16, 0.05, 15.0
#: A language is possible in a script that holds at least this share of its letters.
LEAST_SHARE = 0.01
#: Characters looked at together, characters of texts that are labelled together, words of a block,
#: and values of ways through blocks that are held together.
PIECE, GROUP, BLOCK, CELLS = 1 << 20, 12 << 20, 1024, 1 << 22
#: Where a long text may be cut: white space and marks that end a sentence without it.
GAP = re.compile(r"[\s。，、！？]")
UNKNOWN = "und"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: 0, 1 for a mark, 2 for a letter; and its script, 0 for any other."""
    kind = np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], dtype=np.uint8)
    script = np.zeros(0x110000, dtype=np.uint8)
    for name, first, last in SCRIPTS:
        script[first : last + 1] = NAMES.index(name) + 1
    return kind, script


@dataclass
class Words:
    """Words of several texts: the text, number of letters, script; and of each letter its trigram
    bucket, with the place where each word's letters begin."""

    text: np.ndarray
    size: np.ndarray
    script: np.ndarray
    trigram: np.ndarray
    begin: np.ndarray


def words_of(texts: list[str]) -> Words:
    """Words are runs of letters and marks with at least one letter; case is ignored."""
    kind, script = _tables()
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])[: len(code)]
    inside = kind[code] > 0
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    at = np.flatnonzero(inside)
    begin = np.searchsorted(at, first)
    letters = np.add.reduceat((kind[code[at]] == 2).astype(np.int64), begin) if len(first) else np.zeros(0, np.int64)
    mixed = code.astype(np.uint64) * inside
    before = np.concatenate([[0], mixed[:-1]]).astype(np.uint64)
    after = np.concatenate([mixed[1:], [0]]).astype(np.uint64)
    h = (before[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (mixed[at] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after[at] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return Words(owner[first], letters, script[code[first]], (h >> np.uint64(48)).astype(np.int64) % BUCKETS, begin)


@dataclass(frozen=True)
class Model:
    """``languages`` in code point order; log likelihoods by trigram bucket; possible languages by
    script."""

    languages: tuple[str, ...]
    likelihood: np.ndarray
    possible: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """A row per word: its log likelihood in each language; a script that no language was seen
        in tells nothing."""
        if not len(words.begin):
            return np.zeros((0, len(self.languages)), np.float32)
        sums = np.add.reduceat(self.likelihood[words.trigram], words.begin, axis=0)
        sums[~self.possible[words.script]] -= 1e4
        return sums


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", id_column: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` rows per language, those with the smallest digest of their id.

    Rows without a language or a text are not used. Counts are summed by Spark; the driver gets one
    number per language and bucket or script.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(id_column).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    first = lambda df: df.withColumn("n", F.row_number().over(by)).where(F.col("n") <= sample).drop("n")
    # Twice the sample by the digest first, so that a frequent language is not ranked in one task;
    # the counts are one row per language, as the model is.
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 32)) * F.col("rows") < F.lit((1 << 32) * 2.0 * sample)
    thinned = rows.select("id", "lang").join(F.broadcast(counts), "lang").where(drawn).select("id", "lang")
    chosen = first(thinned).distinct().withColumnRenamed("lang", "chosen_lang").withColumnRenamed("id", "chosen")
    same = F.col("id").eqNullSafe(F.col("chosen")) & (F.col("lang") == F.col("chosen_lang"))
    texts = first(rows.join(F.broadcast(chosen), same, "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist())
            bodies = batch.column(1).to_pylist()
            for name in sorted(set(langs)):
                for own in _grouped([p for i in np.flatnonzero(langs == name) for p in _cut(bodies[i], PIECE)], PIECE):
                    words = words_of(own)
                    counts = np.bincount(words.trigram, minlength=BUCKETS)
                    scripts = np.bincount(words.script, weights=words.size, minlength=len(NAMES) + 1)
                    both = np.concatenate([counts, scripts.astype(np.int64)])
                    seen = np.flatnonzero(both)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen)), pa.array(seen, pa.int32()), pa.array(both[seen], pa.int64())], names=["lang", "cell", "n"])

    rows = texts.select("lang", "text").mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    languages = tuple(sorted({r.lang for r in rows}))
    table = np.zeros((BUCKETS + len(NAMES) + 1, len(languages)))
    for r in rows:
        table[r.cell, languages.index(r.lang)] = r.n
    counts, scripts = table[:BUCKETS], table[BUCKETS:]
    likelihood = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
    possible = scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=0), 1)
    possible[~possible.any(axis=1)] = True
    return Model(languages, likelihood, possible)


def _grouped(texts: list[str], size: int) -> Iterator[list[str]]:
    """Lists of texts of about ``size`` characters; a longer text is alone in its list."""
    held, total = [], 0
    for t in texts:
        if held and total + len(t) > size:
            yield held
            held, total = [], 0
        held.append(t)
        total += len(t)
    if held:
        yield held


def _cut(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces that end behind the first gap after ``size`` characters, so that no word
    is cut."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + size)
        stop = gap.end() if gap else len(text)
        yield text[at:stop]
        at = stop


def _advance(scores: np.ndarray, begin: np.ndarray, count: np.ndarray, value: np.ndarray, switch: float, back: Steps | None = None) -> np.ndarray:
    """Best values behind the last word of every block, from the ones before its first word.

    Block k has the ``count[k]`` words from ``begin[k]`` on. All blocks advance together, one word at
    a time, the ones with most words first. The last axis of ``value`` is the label. ``back`` gets
    what is needed to find the way back.
    """
    order = np.argsort(-count, kind="stable")
    begin, count, value = begin[order], count[order], value[order]
    longest = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(longest), side="left")
    for t in range(longest):
        own, at = value[: active[t]], begin[: active[t]] + t
        jump = own.max(axis=-1, keepdims=True) - switch
        if back is not None:
            back.stays[at], back.origin[at] = own >= jump, own.argmax(axis=-1)
        score = scores[at] if value.ndim == 2 else scores[at][:, None]
        value[: active[t]] = np.maximum(own, jump) + score
    after = np.empty_like(value)
    after[order] = value
    return after


@dataclass
class Steps:
    """The way back through the words of several texts, each cut into blocks: whether a label is
    kept from the word before, and the label that a switch comes from."""

    begin: np.ndarray
    count: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    stays: np.ndarray
    origin: np.ndarray

    def retreat(self, chosen: np.ndarray, state: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """Labels before the first words of the blocks ``chosen``, from rows of labels of their last
        words; ``label`` gets those of all words."""
        order = np.argsort(-self.count[chosen], kind="stable")
        begin, count, state = self.begin[chosen][order], self.count[chosen][order], state[order]
        longest = int(count[0]) if len(count) else 0
        active = np.searchsorted(-count, -np.arange(longest), side="left")
        for t in range(longest - 1, -1, -1):
            own, at = state[: active[t]], begin[: active[t]] + t
            if label is not None:
                label[at] = own[:, 0]
            state[: active[t]] = np.where(self.stays[at[:, None], own], own, self.origin[at][:, None])
        before = np.empty_like(state)
        before[order] = state
        return before

    def labels(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels of all words, and of the word before each text, from that of each text's last word."""
        width = self.stays.shape[1]
        end = last[self.owner]
        later = np.flatnonzero(self.place > 0)
        comes_from = self.retreat(later, np.tile(np.arange(width), (len(later), 1)))
        for k, origin in zip(later[::-1], comes_from[::-1], strict=True):
            end[k - 1] = origin[end[k]]
        label = np.zeros(len(self.stays), np.int16)
        before = self.retreat(np.arange(len(end)), end[:, None], label)[:, 0]
        first = self.place == 0
        start = last.copy()
        start[self.owner[first]] = before[first]
        return label, start


def trace(scores: np.ndarray, begin: np.ndarray, count: np.ndarray, switch: float, value: np.ndarray) -> tuple[Steps, np.ndarray]:
    """The best ways through the words of several texts and their values at the end, from the
    ``value`` of each text and label before its first word.

    Texts are cut into blocks of ``BLOCK`` words, so that a long one takes as many steps as a block:
    what a block adds on the way from each label to each other is found for all blocks together, and
    values then cross the borders one block after the other.
    """
    blocks = -(-count // BLOCK)
    owner = np.repeat(np.arange(len(count)), blocks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts, sizes = begin[owner] + place * BLOCK, np.minimum(BLOCK, count[owner] - place * BLOCK)
    entry = value[owner]
    goes_on = np.flatnonzero(place + 1 < blocks[owner])
    width = scores.shape[1]
    unit = np.where(np.eye(width, dtype=bool), 0.0, -np.inf)
    # As many blocks together as fit a bounded table of values from each label to each other.
    for some in np.array_split(goes_on, max(1, -(-len(goes_on) * width * width // CELLS))):
        ways = _advance(scores, starts[some], sizes[some], np.tile(unit, (len(some), 1, 1)), switch)
        for k, way in zip(some, ways, strict=True):
            entry[k + 1] = (entry[k][:, None] + way).max(axis=0)
    steps = Steps(starts, sizes, owner, place, np.ones(scores.shape, bool), np.zeros(len(scores), np.int16))
    ends = _advance(scores, starts, sizes, entry, switch, steps)
    after = value.copy()
    final = place + 1 == blocks[owner]
    after[owner[final]] = ends[final]
    return steps, after


def viterbi(scores: np.ndarray, begin: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word; text k has the ``count[k]`` words from ``begin[k]`` on."""
    steps, value = trace(scores, begin, count, switch, np.zeros((len(count), scores.shape[1])))
    return steps.labels(value.argmax(axis=1))[0]


def _scored(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, number of letters and scores of every word of ``texts``."""
    parts, base = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(model.languages)), np.float32))], 0
    for own in _grouped(texts, PIECE):
        for part in ([p] for p in _cut(own[0], PIECE)) if len(own) == 1 else [own]:
            words = words_of(part)
            kept = words.size > 0
            parts.append((words.text[kept] + base, words.size[kept], model.scores(words)[kept]))
        base += len(own)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def label_texts(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, number of letters and text of every word of ``texts``.

    A text beyond ``GROUP`` characters is read in parts: values cross from part to part, and what is
    kept of a part is its way back, a byte for each word and language.
    """
    parts = [[p] for p in _cut(texts[0], GROUP)] if len(texts) == 1 else [texts]
    value = np.zeros((len(texts), len(model.languages)))
    held = []
    for part in parts:
        owner, size, scores = _scored(part, model)
        count = np.bincount(owner, minlength=len(texts))
        steps, value = trace(scores, np.cumsum(count) - count, count, switch, value)
        held.append((steps, size, owner))
    last = value.argmax(axis=1)
    found = []
    while held:
        steps, size, owner = held.pop()
        label, last = steps.labels(last)
        found.append((label, size, owner))
    none = (np.zeros(0, np.int16), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(none, *found[::-1], strict=True))


def identify(docs: DataFrame, model: Model, keys: list[str], text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` and ``spans`` for every row of ``docs``.

    ``lang_pred`` is the language with most letters (ties: the first in code point order) and
    ``score`` its share of them; ``spans`` are the runs of one language as ``lang, start, stop`` in
    words. A null text, one without a letter, and any text if the model has no language, is ``und``
    with score 0 and no span. Other columns are not read.
    """
    schema = docs.select(*keys).schema.add("lang_pred", "string").add("score", "double")
    schema = schema.add("spans", ArrayType(StructType().add("lang", "string").add("start", "long").add("stop", "long")))
    names = np.array(model.languages, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(len(keys)).to_pylist()]
            at = 0
            for own in _grouped(texts, GROUP):
                part = batch.slice(at, len(own))
                at += len(own)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keys))], *_results(own, model, names, switch)], names=schema.fieldNames())

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


def _results(texts: list[str], model: Model, names: np.ndarray, switch: float) -> list[pa.Array]:
    if len(names):
        label, size, owner = label_texts(texts, model, switch)
    else:
        label, size, owner = (np.zeros(0, np.int64) for _ in range(3))
    width = max(1, len(names))
    letters = np.bincount(owner * width + label, weights=size, minlength=len(texts) * width).reshape(-1, width)
    best, total = letters.argmax(axis=1), letters.sum(axis=1)
    known = total > 0
    lang = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    score = np.where(known, letters.max(axis=1) / np.maximum(total, 1), 0.0)
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])])) if len(owner) else np.zeros(0, np.int64)
    tail = np.append(head[1:], len(owner)) if len(owner) else head
    count = np.bincount(owner, minlength=len(texts))
    base = (np.cumsum(count) - count)[owner[head]]
    held = np.bincount(owner[head], minlength=len(texts))
    offsets = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
    spans = pa.StructArray.from_arrays(
        [pa.array([names[i] for i in label[head]], pa.string()), pa.array(head - base, pa.int64()), pa.array(tail - base, pa.int64())], names=["lang", "start", "stop"]
    )
    return [pa.array(lang, pa.string()), pa.array(score), pa.ListArray.from_arrays(offsets, spans)]
