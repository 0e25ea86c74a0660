"""Repair of conversations against an exhaustive search and a plain version of the whole query."""

from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256

import pytest

from parcelpay.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
#: The pattern's states by what has been read, spelled out: (state, initial) -> state.
READ = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
DONE = ("", "a")


def cheapest(turns: list[tuple[str, str | None]]) -> tuple[int, str]:
    """Least cost and audit over all edits, by trying every way of at most three insertions in a gap."""
    best: tuple[int, str] | None = None

    def go(i: int, state: str, cost: int, audit: str, inserted: int) -> None:
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns) and state in DONE and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if i < len(turns):
            initial, fault = turns[i]
            go(i + 1, state, cost + 2, audit + "D", 0)
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                if (state, initial) in READ:
                    go(i + 1, READ[state, initial], cost + more, audit + "K", 0)
                for role in "ua":
                    if (state, role) in READ:
                        go(i + 1, READ[state, role], cost + more + 1, audit + "R", 0)
        if inserted < 3:
            for role in "ua":
                if (state, role) in READ:
                    go(i, READ[state, role], cost + 5, audit + "I", inserted + 1)

    go(0, "", 0, "", 0)
    return best


FAULTS = [None, None, None, "blank", "duplicate", "truncated"]
CODE = {None: repair.SOUND, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.TRUNCATED}


@pytest.mark.parametrize("seed", range(4))
def test_search_is_optimal_whole_and_in_blocks(seed):
    rng = random.Random(seed)
    for _ in range(300):
        turns = [(rng.choice("suuaa x"), rng.choice(FAULTS)) for _ in range(rng.randint(0, 7))]
        want = cheapest(turns)
        coded = [(i, CODE[f]) for i, f in turns]
        assert repair.search(coded, repair.EMPTY, repair.FINAL, True)[:2] == want
        if turns:
            cuts = sorted({0, len(turns), rng.randint(0, len(turns)), rng.randint(0, len(turns))})
            parts = [coded[a:b] for a, b in zip(cuts, cuts[1:])]
            assert repair.joined([repair.routes(p, False) for p in parts]) == want


def test_bounds_never_exceed_the_cost():
    rng = random.Random(8)
    for _ in range(100):
        coded = [(rng.choice("sua"), rng.randrange(4)) for _ in range(30)]
        found = repair.search(coded, repair.EMPTY, repair.FINAL, True)
        assert repair.suffix_bounds(coded, repair.FINAL, True)[0][repair.EMPTY] <= found[0]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(rows) -> dict:
    hurt = damage(rows)
    found = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in hurt if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(f"{len(r[2].encode())}:{r[2]}:{r[3]}".encode()).hexdigest()))
        seen, turns = set(), []
        for _, _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            turns.append((role[:1], fault))
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = repair.search([(i, CODE[f]) for i, f in turns], repair.EMPTY, repair.FINAL, True)[:2]
        if len(turns) <= 7:
            assert (cost, audit) == cheapest(turns)
        state, lines, rest = "", [], iter(own)
        for edit in audit:
            row = None if edit == "I" else next(rest)
            if edit == "D":
                continue
            initial = row[2][0] if edit == "K" else "a" if state == "u" else "u"
            role = row[2] if edit == "K" else {"u": "user", "a": "assistant"}[initial]
            lines.append(f"{role}:{row[3] if row else ''}")
            state = READ[state, initial]
        assert state in DONE
        faults = [f for _, f in turns]
        found[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return found


def unusual() -> list[tuple]:
    rng = random.Random(2)
    texts = ["Yes.", "no", "", " \n", "What? ", "a\nb!", None, "ünï.", "x" * 100_000 + "."]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant"]), rng.choice(texts) if rng.random() < 0.4 else f"turn {t} of {c}.")
            for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "Hello."), (None, None, "assistant", "Hi."), (None, 3, None, None)]
    rows += [(70, None, "user", "A."), (70, None, "user", "A."), (70, 5, "assistant", "B."), (70, 5, "tool", "C."), (70, 9, "", "D.")]
    rows += [(71, 1, "user", "same"), (71, 2, "assistant", "Same."), (71, 2, "assistant", "Same."), (71, -4, "user", "same")]
    rows += [(80, t, "user" if t % 2 == 0 else "assistant", "again." if t % 5 == 0 else f"{t}.") for t in range(3000)]
    rows += [(81, 1, "user", "copy.")] * 1500 + [(81, 2, "assistant", "done.")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return unusual()


def test_query_equals_the_plain_version(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", fault int, conv string")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_conversation_repair(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == plain(rows)


@pytest.mark.parametrize("block, partitions", [(1, 2), (3, 5), (repair.BLOCK, 7)])
def test_blocks_of_any_size_give_the_same_plans(spark, conf, rows, block, partitions):
    conf("spark.sql.shuffle.partitions", str(partitions))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    turns = repair.turns_of(queries.damaged(spark.createDataFrame(rows, SCHEMA)))
    plans = repair.repair_plans(turns, block).collect()
    key = {"" if c is None else f"={c}": v for c, v in plain(rows).items()}
    assert {r.conv: tuple(r[1:]) for r in plans} == {c: key[c][:7] for c in (r.conv for r in plans)}
    assert len(plans) == len({r.conv for r in plans})


def test_repaired_turns_fit_the_pattern(spark, rows):
    turns = repair.turns_of(spark.createDataFrame(rows, SCHEMA))
    out = repair.repaired_turns(turns, repair.repair_plans(turns)).collect()
    by_conv: dict[str, list] = {}
    for r in sorted(out, key=lambda r: (r.conv, r.place)):
        by_conv.setdefault(r.conv, []).append(r)
    for kept in by_conv.values():
        assert [r.place for r in kept] == list(range(len(kept)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_repair(spark, str(tmp_path)).count() == 0
