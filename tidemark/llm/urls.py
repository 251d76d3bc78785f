"""URL rules by a Bloom filter cascade.

A list of keys is held as Bloom filters in levels: the first encodes the listed keys, the second
those keys of the corpus that wrongly pass the first, the third the listed ones that pass the
second, and so on until none is left. For every key of the corpus the first level that does not
have it says exactly whether it is listed, with no join over the pages. The key universe is what
all pages could be listed by: each ending of a host with each beginning of the path that has the
length of a rule's path.

A level's bits per key follow the ratio of the keys that it must tell from those it encodes, so that
about as many pass it wrongly as the rules' list is long, however large the corpus: all levels
together take ``BITS_PER_KEY`` to some 60 bits for each rule, which is less than the list of rules
itself, a parameter that the caller's driver already holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.session import stored

#: Bits per key at least: about one key in a hundred passes such a level wrongly.
BITS_PER_KEY = 10


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A to Z lower-cased) and path; both empty for null or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All rules, as text, that could fit: endings of the host at a dot, with the path's beginnings
    of ``lengths`` characters."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    endings = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))
    heads = F.filter(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]), lambda x: x.isNotNull())
    return F.flatten(F.transform(endings, lambda e: F.transform(heads, lambda h: F.concat(e, h))))


def bits_per_key(encoded: int, others: int) -> int:
    """Bits that let about as many of the ``others`` pass as keys are encoded, or a hundredth."""
    return max(BITS_PER_KEY, math.ceil(math.log2(max(others, 1) / max(encoded, 1)) / math.log(2)) if others > encoded else 0)


def _place(key: Column, level: int, digest: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), digest), F.lit(bits))


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    digests: int
    words: tuple[int, ...]

    def passes(self, key: Column) -> Column:
        """Whether all bits of a key are set; the first that is not ends the search."""
        words = F.lit(np.array(self.words, dtype=np.int64))

        def is_set(digest: Column) -> Column:
            place = _place(key, self.number, digest, self.bits)
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            return F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

        return F.forall(_digests(self.digests), is_set)


def _digests(count: int) -> Column:
    return F.array(*[F.lit(i) for i in range(count)])


def level_of(keys: DataFrame, number: int, count: int, others: int) -> Level:
    """The filter over the ``count`` rows of ``keys(key)`` that ``others`` are told from; its bits are
    gathered as one row per 64 of them."""
    each = bits_per_key(count, others)
    bits, digests = 64 * -(-max(count * each, 1) // 64), max(1, round(each * math.log(2)))
    places = keys.select("key", F.explode(_digests(digests)).alias("digest")).select(_place(F.col("key"), number, F.col("digest"), bits).alias("place"))
    word = F.shiftright("place", 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    rows = places.groupBy(word).agg(F.bit_or(bit).alias("value")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row.word] = row.value
    return Level(number, bits, digests, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.passes(key), answer).otherwise(F.lit(level.number % 2 == 1))
        return answer


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade for ``listed(key)`` over ``universe(key)``, both without repeats."""
    levels: list[Level] = []
    encoded, other = listed, universe.join(listed, "key", "left_anti")
    count, others = listed.count(), universe.count()
    while count:
        level = level_of(encoded, len(levels), count, others)
        levels.append(level)
        encoded, other = stored(other.where(level.passes(F.col("key"))), "passing"), encoded
        count, others = encoded.count(), count
    return Cascade(tuple(levels))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` in place of columns so named.

    ``rules``: (verdict, host and path, like ``example.net/en/``); of rules given twice the first
    one counts. A rule fits its host and all subdomains if the path starts with the rule's; the
    longest one wins (ties: the one last in code point order). Without a rule the verdict is
    ``default``. Null urls, and such without ``://``, have an empty host and path.
    """
    spark = pages.sparkSession
    verdict_of = {rule: verdict for verdict, rule in reversed(rules)}
    lengths = sorted({len(split_rule(r)[1]) for r in verdict_of}) or [0]
    host, path = host_and_path(F.col(url))
    parted = pages.withColumns({"host": host, "path": path})
    keys = keys_of(F.col("host"), F.col("path"), lengths)
    universe = stored(parted.select(F.explode(keys).alias("key")).distinct(), "universe")
    hits = []
    for verdict in sorted(set(verdict_of.values())):
        listed = spark.createDataFrame([(r,) for r, v in verdict_of.items() if v == verdict], "key string")
        hits.append(_fitting(keys, verdict, cascade(listed, universe)))
    none = F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    judged = parted.withColumn("_best", F.array_max(F.concat(*hits)) if hits else none)
    return judged.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}).drop("_best")


def _fitting(keys: Column, verdict: str, levels: Cascade) -> Column:
    listed = F.filter(keys, lambda key: levels.listed(key))
    return F.transform(listed, lambda key: F.struct(F.length(key).alias("n"), key.alias("rule"), F.lit(verdict).alias("verdict")))
