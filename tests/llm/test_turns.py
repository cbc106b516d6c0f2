"""Conversation repair: auctions against shortest paths over all edits, long conversations by segments, edge cases."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests_sql import same_rows
from vecshelf.llm import turns
from vecshelf.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.01"
KEPT = {"": "su", "s": "u", "u": "a", "a": "u"}
MADE = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Least (cost, audit, text) of the edits of (role, text, fault), by Dijkstra over costs and strings."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(out)
        made = {"u": "user", "a": "assistant"}[MADE[last]]
        heapq.heappush(heap, (cost + 3, audit + "I", i, MADE[last], (*out, f"{made}:")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 * (fault == "truncated")
        if role[:1] and role[:1] in KEPT[last]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, MADE[last], (*out, f"{made}:{text}")))


def brute(rows):
    """All result rows of (conv_id, turn, role, text), as the contract states them."""
    found = {}
    for conv, turn, role, text in rows:
        held = found.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = {}
    for conv, held in found.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = {t for t, _, _ in held if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        seen, faulty = set(), []
        for _, role, text in held:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        initials = [r[:1] for r, _, _ in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = cheapest(faulty)
        counts = [sum(f == k for _, _, f in faulty) for k in ("blank", "duplicate", "truncated")]
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def same(df, rows):
    found = df.collect()
    wanted = brute(rows)
    assert len(found) == len(wanted)
    for r in found:
        assert tuple(r)[1:] == wanted[r.conv_id], r.conv_id


@pytest.mark.parametrize("segment", [3, 64])
def test_edits_against_all_paths(monkeypatch, segment):
    monkeypatch.setattr(turns, "SEGMENT", segment)
    rng = random.Random(5)
    names = {turns.FINE: "", turns.CUT: "truncated", turns.COPY: "duplicate", turns.BLANK: "blank"}
    for _ in range(400):
        rows = [(rng.choice("suuaa "), "x", rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(14))]
        letters, states = turns.edited([(r if r != " " else "", f) for r, _, f in rows])
        state = turns.START
        for (r, _, _), word, at in zip(rows, letters, states):
            assert at == state
            state = turns._state_after(at, word, r)
        audit = "".join(letters) + turns._completion(state)
        assert audit == cheapest([(r, x, names[f]) for r, x, f in rows])[1]


def test_prices_are_dual():
    """No price exceeds an arc and the price behind it, and the start's is the cost of the cheapest path."""
    rng = random.Random(6)
    for _ in range(50):
        rows = [(rng.choice("sua"), rng.randrange(4)) for _ in range(20)]
        lattice = turns.Lattice(rows, turns.ENDS)
        lattice.auction(turns.START)
        p = lattice.prices
        for i, table in enumerate(lattice.turns):
            for q, arcs in enumerate(table):
                assert all(p[4 * i + q] <= cost + p[4 * (i + step) + to] for _, step, to, cost in arcs)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(queries()["op13_turn_repair"](spark, SF), rows)


def test_query_against_sql(spark, sql):
    same_rows(queries()["op13_turn_repair"](spark, SF), sql, oracle_sql()["op13_turn_repair"])


def test_edges(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (1, 1, "user", ""), (1, None, "assistant", "Yes."),
        (2, 5, "user", "a" * 200_000), (2, 5, "user", "a" * 200_000), (2, 5, "assistant", "b."), (3, 1, "", " \t"),
        (4, 9, "system", "Be.\x85"), (4, 2, "tool", "x!"), (4, 2, "tool", "x!"), (5, 1, "system", "Only."),
    ]
    rows += [(100 + i, t, role, "Text.") for i in range(40) for t, role in enumerate(["user", "assistant"] * 2)]
    clashing = spark.createDataFrame([(*r, "k", 7, "z") for r in rows],
                                     "conv_id long, turn long, role string, text string, key string, pos int, state string")
    same(turns.repairs(clashing), rows)
    assert turns.repairs(clashing.limit(0)).collect() == []


def test_long_conversations_by_segments(spark):
    """One conversation holds most turns; cut into segments it gets the same edits as read whole."""
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(7, t, rng.choice(roles), rng.choice(["A.", "B!", "cut", "", f"t {t}."])) for t in range(700)]
    rows += [(c, t, rng.choice(roles), f"x {c} {t}.") for c in range(20) for t in range(5) if c != 7] + [(8, 6, "user", "z.")] * 50
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = turns.repairs(table, long=30)
    same(found, rows)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, turns.repairs(table).collect()))


def test_repaired_turns_are_legal(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    fixed = {}
    for r in turns.repaired(turns.edits(turns.damaged(table))).orderBy("key", "place").collect():
        fixed[r.key] = fixed.get(r.key, "") + r.role[0]
    assert fixed and all(re.fullmatch("(s?(ua)+)?", x) for x in fixed.values())
