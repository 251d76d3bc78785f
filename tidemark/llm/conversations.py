"""Repair of conversations: the cheapest edits that give roles the order ``(s?(ua)+)?``.

Edits keep, rerole or delete a row or insert an empty one. A row's role matters by its initial, so
what came before a row is one of four states: nothing, ``s``, ``u`` or ``a`` last. Conversations are
cut along their order by range partitions, so that one of any length lies in several blocks of
bounded size, and Hirschberg's division runs on two levels. Between blocks, the least costs from
every state to every state are put together backward: each block learns what it costs to go on from
each state at its end. Inside a block, :func:`walk` lets a forward vector of four costs meet a
backward one in the middle, keeps the states that an optimal path crosses there, finds the crossing
whose edits come first in ASCII order, and goes on in both halves: no table of all rows and states is
ever held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, pieces
from tidemark.session import stored

# Costs of edits, and the role that may follow each state, by state.
DELETE, INSERT, REROLE, UNFINISHED = 4, 3, 3, 3
FOLLOWING = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: What it costs to end in each state: the rows to insert until a state that may end.
ENDING = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Rows of a block that are solved at once, by a table.
LEAF = 64
#: UTF-8 bytes of text in a block.
BLOCK = 16 << 20

#: A row: the initial of its role, or None if it has to go, what keeping it costs, how many rows it is.
Row = tuple[str | None, int, int]
Costs = tuple[int, ...]


class Repaired(NamedTuple):
    #: A row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, blocks.
    summary: DataFrame
    #: A row per block: conv_id, part (in order), blocks (of the conversation), roles, texts.
    blocks: DataFrame


def rows_of(roles: list[str], faults: list[int], copies: list[int]) -> list[Row]:
    """Rows in order; the copies of a row that follow it are one run of rows to delete."""
    rows: list[Row] = []
    for role, fault, n in zip(roles, faults, copies, strict=True):
        if fault in (BLANK, DUPLICATE):
            rows.append((None, 0, n))
            continue
        rows.append((role[:1], UNFINISHED if fault == TRUNCATED else 0, 1))
        if n > 1:
            rows.append((None, 0, n - 1))
    return rows


def after(row: Row, costs: Costs) -> Costs:
    """Least costs to each state behind ``row``, from those ahead of it; insertions come first."""
    begun, asked = costs[0], min(costs[2], min(costs[0], costs[1], costs[3]) + INSERT)
    ahead = (begun, costs[1], asked, min(costs[3], asked + INSERT))
    initial, price, n = row
    if initial is None:
        return tuple(c + DELETE * n for c in ahead)
    found = [c + DELETE for c in ahead]
    keeps = KEEPS.get(initial, {})
    for state, cost in enumerate(ahead):
        if state in keeps:
            found[keeps[state]] = min(found[keeps[state]], cost + price)
        to = FOLLOWING[state]
        found[to] = min(found[to], cost + price + REROLE)
    return tuple(found)


def _without_insertion(row: Row, to_go: Costs) -> Costs:
    initial, price, n = row
    if initial is None:
        return tuple(c + DELETE * n for c in to_go)
    keeps = KEEPS.get(initial, {})
    return tuple(
        min(
            to_go[state] + DELETE,
            to_go[keeps[state]] + price if state in keeps else NEVER,
            to_go[FOLLOWING[state]] + price + REROLE,
        )
        for state in range(4)
    )


def ahead_of(row: Row, to_go: Costs) -> Costs:
    """Least costs to go from each state ahead of ``row``, from those behind it."""
    own = _without_insertion(row, to_go)
    asked, answered = min(own[2], own[3] + INSERT), min(own[3], own[2] + INSERT)
    return (min(own[0], asked + INSERT), min(own[1], asked + INSERT), asked, answered)


def walk(rows: list[Row], low: int, high: int, state: int, to_go: Costs, edits: list[str]) -> int:
    """Adds the ASCII-least of the cheapest edits of ``rows[low:high]`` to ``edits``; the state behind.

    ``to_go`` are the costs of what follows. No edits of some rows are the beginning of other edits
    of the same rows, as each row has one letter of its own and insertions come ahead of rows, so the
    least edits of a half are the beginning of the least of the whole.
    """
    if high - low > LEAF:
        middle = (low + high) // 2
        backward = to_go
        for i in range(high - 1, middle - 1, -1):
            backward = ahead_of(rows[i], backward)
        forward = tuple(0 if s == state else NEVER for s in range(4))
        for i in range(low, middle):
            forward = after(rows[i], forward)
        least = min(f + b for f, b in zip(forward, backward, strict=True))
        crossings = tuple(b if f + b == least else NEVER for f, b in zip(forward, backward, strict=True))
        state = walk(rows, low, middle, state, crossings, edits)
        return walk(rows, middle, high, state, to_go, edits)
    table = [to_go]
    for i in range(high - 1, low - 1, -1):
        table.append(ahead_of(rows[i], table[-1]))
    for i in range(low, high):
        (initial, price, n), here, behind = rows[i], table[high - i], table[high - i - 1]
        while behind[state] + DELETE * n != here[state] and here[FOLLOWING[state]] + INSERT == here[state]:
            edits.append("I")
            state = FOLLOWING[state]
        if behind[state] + DELETE * n == here[state]:
            edits.append("D" * n)
            continue
        kept = KEEPS.get(initial or "", {}).get(state)
        if kept is not None and behind[kept] + price == here[state]:
            edits.append("K")
            state = kept
        else:
            edits.append("R")
            state = FOLLOWING[state]
    return state


def transfer(rows: list[Row], states: range = range(4)) -> list[int]:
    """Least costs from each of ``states`` to each state behind ``rows``, row by row; NEVER for others."""
    found = [NEVER] * 16
    for start in states:
        costs: Costs = tuple(0 if s == start else NEVER for s in range(4))
        for row in rows:
            costs = after(row, costs)
        found[4 * start : 4 * start + 4] = [min(c, NEVER) for c in costs]
    return found


def edited(roles: list[str], texts: list[str], faults: list[int], copies: list[int], audit: str, state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits ``audit``, which begin in ``state``."""
    out: tuple[list[str], list[str]] = ([], [])
    place, used = 0, 0
    for edit in audit:
        if edit == "I":
            state = FOLLOWING[state]
            out[0].append(ROLES[state])
            out[1].append("")
            continue
        if edit != "D":
            state = FOLLOWING[state] if edit == "R" else KEEPS[roles[place][:1]][state]
            out[0].append(ROLES[state] if edit == "R" else roles[place])
            out[1].append(texts[place])
        used += 1
        if used == copies[place]:
            place, used = place + 1, 0
    return out


def faulty(text: Column) -> Column:
    """BLANK or TRUNCATED by the text alone, else FINE."""
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    ended = text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return F.when(blank, BLANK).when(~ended, TRUNCATED).otherwise(FINE)


_BLOCK_FIELDS = (
    "part int, roles array<string>, texts array<string>, turns array<long>, faults array<int>, copies array<long>, "
    "transfer array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string"
)


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a sorted partition, in order."""
    part = TaskContext.get().partitionId()
    held: list[list] = []
    key, seen = None, 0

    def block(partial: bool) -> dict:
        turns, roles, texts, faults, copies = (list(c) for c in zip(*held, strict=True))
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        illegal += sum(n - 1 for n in copies)  # no initial may follow itself
        count = {f: sum(n for g, n in zip(faults, copies, strict=True) if g == f) for f in (BLANK, DUPLICATE)}
        count[DUPLICATE] += sum(n - 1 for f, n in zip(faults, copies, strict=True) if f in (FINE, TRUNCATED))
        units = rows_of(roles, faults, copies)
        return {
            "conv_id": key,
            "part": part,
            "roles": roles,
            "texts": texts,
            "turns": turns,
            "faults": faults,
            "copies": copies,
            "transfer": transfer(units, range(4) if partial else range(1)),
            "blank": count[BLANK],
            "duplicate": count[DUPLICATE],
            "truncated": faults.count(TRUNCATED),
            "illegal": illegal,
            "first": initials[0],
            "last": initials[-1],
        }

    out: list[dict] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv, turn, role, text, fault, n in zip(*columns, strict=True):
            if held and conv != key:
                out.append(block(partial=seen == 0))
                seen, held = seen + 1, []
            key = conv
            held.append([turn, role, text, fault, n])
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    if held:
        yield pa.RecordBatch.from_pylist([block(partial=True)], schema)


def in_blocks(turns: DataFrame) -> DataFrame:
    """Blocks of conversations: every conversation in one, or in several parts that follow in order."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    same = ["conv_id", "turn", "role", "text"]
    units = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    units = units.withColumn("digest", F.md5(F.concat("role", F.lit("\n"), "text"))).withColumn("place", F.struct(F.col("turn").isNotNull(), "turn"))
    firsts = (
        units.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("said"))
        .agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
    )
    fault = F.when(faulty(F.col("text")) == BLANK, BLANK).when(F.col("earliest") < F.col("place"), DUPLICATE).otherwise(faulty(F.col("text")))
    flagged = units.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("said")), "left")
    size = turns.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("begins").asc(), F.col("digest").asc()]
    sorted_units = (
        flagged.select("conv_id", "turn", "role", "text", fault.cast("int").alias("fault"), "copies", "digest", F.substring("text", 1, 64).alias("begins"))
        .repartitionByRange(pieces(size, BLOCK), *order)
        .sortWithinPartitions(*order)
        .select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", "copies")
    )
    id_type = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {_BLOCK_FIELDS}"
    arrow = arrow_schema(schema)
    return sorted_units.mapInArrow(lambda batches: _blocks(batches, arrow), schema)


def _meet(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Costs to go behind every block of a conversation, backward over its blocks; its counts."""
    for batch in batches:
        out = []
        for key, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            to_go, behind = ENDING, []
            for block in reversed(blocks):
                behind.append(list(to_go))
                m = block["transfer"]
                to_go = tuple(min(NEVER, *(m[4 * s + t] + to_go[t] for t in range(4))) for s in range(4))
            borders = list(zip(blocks, blocks[1:], strict=False))
            known = [b for b in blocks if b["low"] is not None]
            shared = sum(a["high"] is not None and a["high"] == b["low"] for a, b in borders)
            gaps = known[-1]["high"] - known[0]["low"] + 1 - sum(b["distinct"] for b in known) + shared if known else 0
            illegal = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in borders)
            out.append(
                {
                    "conv_id": key,
                    "gaps": gaps,
                    **{c: sum(b[c] for b in blocks) for c in ("blank", "duplicate", "truncated")},
                    "illegal": sum(b["illegal"] for b in blocks) + illegal,
                    "cost": to_go[0],
                    "parts": [{"part": b["part"], "to_go": v, "leads": i == 0} for i, (b, v) in enumerate(zip(blocks, reversed(behind), strict=True))],
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema)


def _solve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The least edits of every block from each state in which it may begin, and the state behind."""
    for batch in batches:
        out = []
        for key, part, roles, faults, copies, to_go, leads in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = rows_of(roles, faults, copies)
            audits, exits = [""] * 4, [-1] * 4
            for state in (0,) if leads else range(4):
                edits: list[str] = []
                exits[state] = walk(rows, 0, len(rows), state, tuple(to_go), edits)
                audits[state] = "".join(edits)
            out.append({"conv_id": key, "part": part, "audits": audits, "exits": exits})
        yield pa.RecordBatch.from_pylist(out, schema)


def _choose(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The edits of every block, from the state in which the block before it ends."""
    for batch in batches:
        out = []
        for key, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            state, parts = 0, []
            for block in blocks:
                parts.append({"part": block["part"], "state": state, "audit": block["audits"][state]})
                state = block["exits"][state]
            parts[-1]["audit"] += "I" * (ENDING[state] // INSERT)
            out.append({"conv_id": key, "audit": "".join(p["audit"] for p in parts), "blocks": len(parts), "parts": parts})
        yield pa.RecordBatch.from_pylist(out, schema)


def _rebuild(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, part, blocks, *edits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            roles, texts = edited(*edits)
            out.append({"conv_id": key, "part": part, "blocks": blocks, "roles": roles, "texts": texts})
        yield pa.RecordBatch.from_pylist(out, schema)


def _mapped(df: DataFrame, function, ddl: str) -> DataFrame:
    arrow = arrow_schema(ddl)
    return df.mapInArrow(lambda batches: function(batches, arrow), ddl)


def repair(turns: DataFrame) -> Repaired:
    """Repairs conversations given as rows (conv_id, turn, role, text); other columns are not read.

    Rows go by turn, nulls first; equal turns by role, then by the first 64 characters and the digest
    of the text. A null role or text is one space; rows without conv_id are one conversation. The first
    fault of a row counts: blank, duplicate (its role and text came earlier), truncated (its last
    character other than white space ends no sentence). Equal rows are one row and duplicates behind
    it. An empty table gives no rows; a conversation of any length is solved in blocks of ``BLOCK``
    bytes.
    """
    key = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}"
    blocks = stored(in_blocks(turns), "conversations")
    known = F.filter("turns", lambda t: t.isNotNull())
    border = F.struct(
        "part", "transfer", "blank", "duplicate", "truncated", "illegal", "first", "last",
        F.array_min("turns").alias("low"), F.array_max("turns").alias("high"), F.size(F.array_distinct(known)).cast("long").alias("distinct"),
    )
    listed = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(border)).alias("blocks"))
    met = _mapped(
        listed,
        _meet,
        f"{key}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, parts array<struct<part:int,to_go:array<bigint>,leads:boolean>>",
    )
    met = stored(met, "crossings")
    borders = met.select(F.col("conv_id").alias("of"), F.inline("parts")).withColumnRenamed("part", "at")
    here = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))
    open_blocks = blocks.select("conv_id", "part", "roles", "faults", "copies").join(borders, here)
    solved = _mapped(
        open_blocks.select("conv_id", "part", "roles", "faults", "copies", "to_go", "leads"),
        _solve,
        f"{key}, part int, audits array<string>, exits array<int>",
    )
    ways = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "audits", "exits"))).alias("blocks"))
    chosen = stored(
        _mapped(ways, _choose, f"{key}, audit string, blocks int, parts array<struct<part:int,state:int,audit:string>>"),
        "edits",
    )
    edits = chosen.select(F.col("conv_id").alias("of"), "blocks", F.inline("parts")).withColumnRenamed("part", "at")
    rebuilt = _mapped(
        blocks.join(edits, here).select("conv_id", "part", "blocks", "roles", "texts", "faults", "copies", "audit", "state"),
        _rebuild,
        f"{key}, part int, blocks int, roles array<string>, texts array<string>",
    )
    outcome = chosen.select(F.col("conv_id").alias("of"), "audit", "blocks")
    summary = met.drop("parts").join(outcome, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return Repaired(summary, rebuilt)


def messages(blocks: DataFrame) -> DataFrame:
    """(conv_id, part, place, role, text): the repaired rows; part and place are their order."""
    pairs = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    rows = blocks.select("conv_id", "part", F.posexplode(pairs).alias("place", "row"))
    return rows.select("conv_id", "part", "place", "row.*")


def _stream_digest(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation; those of several blocks stream by, never held together."""
    key, own, begun, open_one = None, hashlib.sha256(), False, False
    for batch in batches:
        out = []
        for conv, whole, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_one and (conv != key or whole):
                out.append({"conv_id": key, "repaired_sha256": own.hexdigest()})
                own, begun, open_one = hashlib.sha256(), False, False
            if whole:
                out.append({"conv_id": conv, "repaired_sha256": whole})
                continue
            key, open_one = conv, True
            if lines is not None:
                own.update(b"\n" * begun + lines.encode())
                begun = True
        yield pa.RecordBatch.from_pylist(out, schema)
    if open_one:
        yield pa.RecordBatch.from_pylist([{"conv_id": key, "repaired_sha256": own.hexdigest()}], schema)


def digests(blocks: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of the lines ``role:text``, joined by line feeds.

    A conversation of one block is hashed where it is; only the lines of longer ones are shuffled.
    """
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    cut = F.col("blocks") > 1
    rows = blocks.select(
        "conv_id",
        "part",
        F.when(~cut, F.sha2(lines, 256)).alias("whole"),
        F.when(cut & (F.size("roles") > 0), lines).alias("lines"),
    )
    return _mapped(
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "whole", "lines"),
        _stream_digest,
        f"conv_id {blocks.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string",
    )
