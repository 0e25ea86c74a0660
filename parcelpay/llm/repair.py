"""Repair of conversation structure by depth-first branch and bound.

Turns are kept, given another role, deleted or inserted so that the initials of the roles read `(s?(ua)+)?`, at least
cost; equal costs go to the audit (the edits' initials) that comes first in ASCII. Conversations are cut into blocks of
turns. Each block is searched on its own for every pair of a first and a last state of that pattern, and a second
search joins the blocks, so no task needs to hold a long conversation's turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.llm.common import SPACES

#: States of the pattern: nothing yet, after the system turn, after a user, after an assistant; the ends that are legal.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (EMPTY, ASSISTANT)
#: Where an initial leads from each state.
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The initial that an inserted turn or a new role has in each state, and the state after it.
NEXT = {EMPTY: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
LEGAL = {"su", "ua", "au"}
#: Faults of a turn.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Turns of a block.
BLOCK = 512
INF = 1 << 60

Turn = tuple[str, int]  # initial and fault


def moves(turn: Turn | None, state: int) -> list[tuple[str, int, int]]:
    """Edit, its cost and the state after it, in ASCII order; without a turn, only an insertion is left."""
    if turn is None:
        return [(INSERT, COST[INSERT], NEXT[state][1])]
    initial, fault = turn
    found = [(DELETE, COST[DELETE], state), (INSERT, COST[INSERT], NEXT[state][1])]
    if fault in (SOUND, TRUNCATED):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        if (state, initial) in STEP:
            found.append((KEEP, COST[KEEP] + extra, STEP[state, initial]))
        found.append((REROLE, COST[REROLE] + extra, NEXT[state][1]))
    return found


def suffix_bounds(turns: list[Turn], ends: tuple[int, ...], closing: bool) -> list[list[int]]:
    """Lower bounds of the cost from each place and state to one of `ends`, with at most two insertions in a gap.

    `closing` allows insertions after the last turn.
    """
    last = [0 if s in ends else INF for s in range(4)]
    if closing:
        _relax(last)
    bounds = [last]
    for turn in reversed(turns):
        here = [min((c + bounds[-1][t] for e, c, t in moves(turn, s) if e != INSERT), default=INF) for s in range(4)]
        _relax(here)
        bounds.append(here)
    bounds.reverse()
    return bounds


def _relax(costs: list[int]) -> None:
    for _ in range(2):
        for s in range(4):
            costs[s] = min(costs[s], COST[INSERT] + costs[NEXT[s][1]])


def search(turns: list[Turn], start: int, ends: tuple[int, ...], closing: bool) -> tuple[int, str, int] | None:
    """The least (cost, audit) from `start` to one of `ends`, and the state reached; None where there is no way.

    An explicit stack holds open prefixes, the most promising on top. A prefix goes when its cost and the suffix's lower
    bound exceed the incumbent, when at equal cost its audit is already behind the incumbent's, or when the table of its
    node (place and state) holds a prefix at least as good. What is left at the end is optimal.

    Prefixes of one node and equal cost are never proper prefixes of each other, since a longer one has paid for more
    insertions; so the lesser audit stays the lesser with any suffix.
    """
    bounds = suffix_bounds(turns, ends, closing)
    n, best = len(turns), None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        least = cost + bounds[place][state]
        if least >= INF:
            continue
        if best is not None and (least > best[0] or (least == best[0] and audit > best[1][: len(audit)])):
            continue
        known = seen.get((place, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[place, state] = (cost, audit)
        if place == n:
            if state in ends and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, state)
            if not closing:
                continue
        open_ = []
        for edit, price, after in moves(turns[place] if place < n else None, state):
            there = place if edit == INSERT else place + 1
            open_.append((cost + price + bounds[there][after], edit, (there, after, cost + price, audit + edit)))
        open_.sort(key=lambda o: o[:2], reverse=True)
        stack.extend(node for _, _, node in open_)
    return best


def routes(turns: list[Turn], whole: bool) -> list[tuple[int, int, int, str]]:
    """First state, last state, cost and audit: of the whole conversation, or of each pair that a block can join."""
    if whole:
        found = search(turns, EMPTY, FINAL, True)
        return [(EMPTY, found[2], found[0], found[1])]
    pairs = ((s, search(turns, s, (e,), False)) for s in range(4) for e in range(4))
    return [(s, found[2], found[0], found[1]) for s, found in pairs if found]


def joined(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of a conversation from the routes of its blocks, by the same bounds from the end and a walk along
    the routes that can still be optimal: pieces of one first state differ before either ends, so the least one is right."""
    bounds = [suffix_bounds([], FINAL, True)[0]]
    for block in reversed(blocks):
        here = [INF] * 4
        for s, e, cost, _ in block:
            here[s] = min(here[s], cost + bounds[-1][e])
        bounds.append(here)
    bounds.reverse()
    state, total, pieces = EMPTY, bounds[0][EMPTY], []
    for block, here, after in zip(blocks, bounds, bounds[1:]):
        audit, state = min((a, e) for s, e, c, a in block if s == state and c + after[e] == here[state])
        pieces.append(audit)
    pieces.append(search([], state, FINAL, True)[1])
    return total, "".join(pieces)


@dataclass
class Chunk:
    """What is known of a conversation's consecutive turns."""

    turns: list[Turn]
    gaps: int = 0
    illegal: int = 0
    first_turn: int | None = None
    last_turn: int | None = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.turns and self.turns[-1][0] + initial not in LEGAL:
            self.illegal += 1
        if turn is not None:
            if self.last_turn is not None and turn > self.last_turn:
                self.gaps += turn - self.last_turn - 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.turns.append((initial, fault))


_CHUNK = (
    "conv string, turn long, role string, digest string, part long, first string, last string, first_turn long, last_turn long, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, "
    "routes array<struct<a:int,b:int,cost:long,audit:string>>"
)
_ROUTES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_CHUNK_ARROW = pa.schema(
    [("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()), ("part", pa.int64()),
     ("first", pa.string()), ("last", pa.string()),
     *[(c, pa.int64()) for c in ("first_turn", "last_turn", "gaps", "blank", "duplicate", "truncated", "illegal")], ("routes", _ROUTES)]
)


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def _emit(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def solve_blocks(block: int):
    """A function over turns in order that gives one row per block: its faults and its routes.

    A conversation whose rows neither start nor end a partition is whole; one that does may go on in the next.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        conv, key, chunk, whole, part = None, None, Chunk([]), False, 0

        def close(complete: bool) -> None:
            nonlocal part
            part += 1
            count = [0] * 4
            for _, fault in chunk.turns:
                count[fault] += 1
            out.append(
                dict(
                    conv=conv, turn=key[0], role=key[1], digest=key[2], part=part, first=chunk.turns[0][0], last=chunk.turns[-1][0],
                    first_turn=chunk.first_turn, last_turn=chunk.last_turn, gaps=chunk.gaps, blank=count[BLANK],
                    duplicate=count[DUPLICATE], truncated=count[TRUNCATED], illegal=chunk.illegal,
                    routes=[dict(zip(("a", "b", "cost", "audit"), r)) for r in routes(chunk.turns, complete)],
                )
            )

        for c, turn, role, digest, fault, again, copies in _rows(batches, ["conv", "turn", "role", "digest", "fault", "again", "copies"]):
            if c != conv:
                if conv is not None:
                    close(whole)
                whole, conv, key, chunk = conv is not None, c, (turn, role, digest), Chunk([])
            for copy in range(copies):
                if len(chunk.turns) == block:
                    close(False)
                    whole, key, chunk = False, (turn, role, digest), Chunk([])
                repeat = fault != BLANK and (again or copy > 0)
                chunk.add(turn, role[:1], DUPLICATE if repeat else fault)
            if len(out) >= 64:
                yield _emit(out, _CHUNK_ARROW)
                out.clear()
        if conv is not None:
            close(False)
        if out:
            yield _emit(out, _CHUNK_ARROW)

    return walk


_PLAN = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PLAN_ARROW = pa.schema([("conv", pa.string()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order."""
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal")
    columns = ["conv", "first", "last", "first_turn", "last_turn", *sums, "routes"]
    now: dict | None = None
    last, last_turn, blocks = "", None, []

    def close() -> dict:
        if len(blocks) == 1 and len(blocks[0]) == 1 and blocks[0][0][1] in FINAL:
            cost, audit = blocks[0][0][2:]
        else:
            cost, audit = joined(blocks)
        return dict(now, cost=cost, audit=audit)

    out: list[dict] = []
    for conv, first, tail, first_turn, tail_turn, *counts, found in _rows(batches, columns):
        if now is None or conv != now["conv"]:
            if now is not None:
                out.append(close())
            now, last, last_turn, blocks = dict(zip(("conv", *sums), (conv, *[0] * len(sums)))), None, None, []
        if last is not None and last + first not in LEGAL:
            now["illegal"] += 1
        if first_turn is not None and last_turn is not None and first_turn > last_turn:
            now["gaps"] += first_turn - last_turn - 1
        for name, count in zip(sums, counts):
            now[name] += count
        last, last_turn = tail, tail_turn if tail_turn is not None else last_turn
        blocks.append([(r["a"], r["b"], r["cost"], r["audit"]) for r in found])
        if len(out) >= 256:
            yield _emit(out, _PLAN_ARROW)
            out.clear()
    if now is not None:
        out.append(close())
    if out:
        yield _emit(out, _PLAN_ARROW)


def conversation_key(conv_id: Column) -> Column:
    """An id of any type as a text that is never null."""
    shown = conv_id.cast("string")
    return F.when(shown.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), shown))


def turns_of(rows: DataFrame) -> DataFrame:
    """The columns that a repair needs: `conv` (the id's key; rows of null id are one conversation), `turn`, `role` and
    `text`, with one space for a null role or text, and `digest`, which tells turns of different role or text apart.
    Other columns of `rows` are not looked at."""
    rows = rows.select(
        conversation_key(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256))


def in_order(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns or ("conv", "turn", "role", "digest")]


def repair_plans(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """`conv`, the faults, and the least `cost` and its `audit` of every conversation that `turns_of` shows.

    Turns follow each other by turn (nulls first), then by role and digest; equal turns are interchangeable. The first
    fault of a turn counts: blank (no word), duplicate (role and text seen earlier), truncated (the last character that
    isn't a space is not one of `.!?`). Equal turns are counted before any of them move, a duplicate is told by the
    conversation's first turn of its digest, and turns are dealt by ranges of their order, so that a long conversation is
    spread over many tasks; only one row per block of turns comes together again.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault")
    )
    narrow = turns.select("conv", "turn", "role", "digest", fault).groupBy("conv", "turn", "role", "digest", "fault")
    narrow = narrow.agg(F.count(F.lit(1)).alias("copies"))
    # nulls first: a struct orders them so
    firsts = narrow.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places"))
    firsts = firsts.filter("places > 1").drop("places")
    marked = narrow.join(firsts, ["conv", "digest"], "left")
    again = F.col("first").isNotNull() & ~F.col("first")["turn"].eqNullSafe(F.col("turn"))
    dealt = marked.select("conv", "turn", "role", "digest", "fault", again.alias("again"), F.col("copies").cast("long"))
    dealt = dealt.repartitionByRange(*in_order()).sortWithinPartitions(*in_order())
    blocks = dealt.mapInArrow(solve_blocks(block), _CHUNK)
    return blocks.repartition("conv").sortWithinPartitions(*in_order("conv", "turn", "role", "digest", "part")).mapInArrow(join_blocks, _PLAN)


_TURN = "conv string, place long, edit string, role string, text string"
_TURN_ARROW = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns of each conversation from its audit, which comes first, and its turns in order."""
    out: list[dict] = []
    conv, audit, at, state, place = None, "", 0, EMPTY, 0

    def put(edit: str, role: str, text: str) -> None:
        nonlocal place
        out.append(dict(conv=conv, place=place, edit=edit, role=role, text=text))
        place += 1

    def insertions() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            initial, state = NEXT[state]
            put(INSERT, ROLE[initial], "")
            at += 1

    for kind, c, plan, role, text in _rows(batches, ["kind", "conv", "audit", "role", "text"]):
        if kind == 0:
            conv, audit, at, state, place = c, plan, 0, EMPTY, 0
            insertions()
        else:
            edit = audit[at]
            at += 1
            if edit == KEEP:
                state = STEP[state, role[:1]]
                put(KEEP, role, text)
            elif edit == REROLE:
                initial, state = NEXT[state]
                put(REROLE, ROLE[initial], text)
            insertions()
        if len(out) >= 256:
            yield _emit(out, _TURN_ARROW)
            out.clear()
    if out:
        yield _emit(out, _TURN_ARROW)


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """`conv`, `place` (0, 1, 2 …), `edit`, `role` and `text` of the turns that the audits of `plans` leave.

    Rows come in order, a conversation's one after the other in one partition; turns stream through, none are collected.
    """
    none = F.lit(None)
    steps = plans.select(
        "conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), none.cast("string").alias("text"), "audit",
    )
    rows = turns.select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", none.cast("string").alias("audit"))
    order = in_order("conv", "kind", "turn", "role", "digest")
    together = steps.union(rows).repartition("conv").sortWithinPartitions(*order)
    return together.mapInArrow(_edited, _TURN)
