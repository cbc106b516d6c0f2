"""Repair of conversation structure by an auction for shortest paths.

Edits of a conversation are paths over a lattice: a node is (turns consumed, last role kept), an arc an edit with a
whole-number cost. The auction keeps a price for each node and one path from the start: where the
path's end is dearer than its price, the price rises and the path is contracted; else the path is
extended by the cheapest arc. When it reaches the end, prices are dual to the costs: every
cheapest path runs over tight arcs only, and the least string of edits is traced along them.

Conversations of up to LONG turns are repaired whole. Longer ones are cut into segments, whose costs
from state to state come from auctions of their own; only four numbers a segment pass along
the conversation, to and fro, and segments are traced apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import small_side, tidy
from vecshelf.operators.ordering import with_position
from vecshelf.session import durable

SEGMENT = 64  # turns whose lattice is searched at once
LONG = 20_000  # turns of a conversation that one task reads at once
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
BIG = 1 << 60  # the price of what cannot reach the end
# States: nothing kept yet, system, user, assistant kept last. Conversations end in the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = [0, 2 * INSERT, INSERT, 0]  # what completes a conversation that stops in a state
_NEXT = (USER, USER, ASSISTANT, USER)  # where a rerole or an insert leads
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_ROLES = {USER: "user", ASSISTANT: "assistant"}
FINE, CUT, COPY, BLANK = range(4)  # faults: none, truncated, duplicate, blank


def _arcs(initial: str, fault: int, state: int) -> tuple:
    """Arcs of a turn from a state, in the order of their letters: letter, turns consumed, state, cost."""
    found = [("D", 1, state, DELETE), ("I", 0, _NEXT[state], INSERT)]
    if fault in (FINE, CUT):
        more = TRUNCATED if fault == CUT else 0
        if initial in _KEPT[state]:
            found.append(("K", 1, _KEPT[state][initial], KEEP + more))
        found.append(("R", 1, _NEXT[state], REROLE + more))
    return tuple(found)


_ARCS = {(i, f): [_arcs(i, f, q) for q in range(4)] for i in ("s", "u", "a", "") for f in range(4)}
_LEAST = {key: min(cost for arcs in table for _, step, _, cost in arcs if step) for key, table in _ARCS.items()}


class Lattice:
    """Prices over the edits of some turns, given what each state costs after the last one."""

    def __init__(self, turns: list[tuple[str, int]], ends: list[int]):
        self.turns = [_ARCS[t] for t in turns]
        self.n = len(turns)
        # Lower bounds of the way to the end: a price may not exceed any arc's cost and the price behind it.
        reach = [e < BIG for e in ends]
        bound = min(ends)
        self.prices = list(ends)
        for key, table in zip(reversed(turns), reversed(self.turns)):
            bound += _LEAST[key]
            reach = [any(reach[to] for _, step, to, _ in arcs if step) for arcs in table]
            for state in (ASSISTANT, USER, SYSTEM, START, ASSISTANT, USER):  # then by inserts
                reach[state] = reach[state] or reach[_NEXT[state]]
            self.prices[:0] = [bound if r else BIG for r in reach]

    def auction(self, entry: int) -> int:
        """Raise prices until a path of tight arcs leads from `entry` to the end; its cost."""
        prices, path, last = self.prices, [entry], 4 * self.n
        while path[-1] < last:
            node = path[-1]
            base, state = node & ~3, node & 3
            best, place = BIG, -1
            for _, step, to, cost in self.turns[node >> 2][state]:
                at = base + 4 * step + to
                if cost + prices[at] < best:
                    best, place = cost + prices[at], at
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
                elif best >= BIG:
                    break
            elif best >= BIG:
                break
            else:
                path.append(place)
        return prices[entry]

    def trace(self, entry: int) -> tuple[list[str], list[int]]:
        """The least string of edits over tight arcs that lead to the end: letters of each turn, states between turns."""
        prices = self.prices
        ends = [[True] * 4]  # from which nodes tight arcs lead to the end
        for i in range(self.n - 1, -1, -1):
            here, after = prices[4 * i : 4 * i + 4], prices[4 * i + 4 : 4 * i + 8]
            good = [
                any(step and ends[-1][to] and here[q] == cost + after[to] < BIG for _, step, to, cost in self.turns[i][q])
                for q in range(4)
            ]
            for q in (USER, ASSISTANT, SYSTEM, START, USER):
                good[q] = good[q] or (good[_NEXT[q]] and here[q] == INSERT + here[_NEXT[q]])
            ends.append(good)
        ends.reverse()
        letters, states, state = [], [entry], entry
        for i in range(self.n):
            word, step = "", 0
            while not step:
                price = prices[4 * i + state]
                for letter, step, to, cost in self.turns[i][state]:
                    if ends[i + step][to] and price == cost + prices[4 * (i + step) + to]:
                        word, state = word + letter, to
                        break
            letters.append(word)
            states.append(state)
        return letters, states


def crossings(turns: list[tuple[str, int]]) -> list[int]:
    """What a segment costs from each state to each state, 16 numbers; BIG where there is no way."""
    table = [BIG] * 16
    for to in range(4):
        lattice = Lattice(turns, [0 if q == to else BIG for q in range(4)])
        for entry in range(4):  # prices of one auction are a start for the next
            if lattice.prices[entry] < BIG:
                table[4 * entry + to] = lattice.auction(entry)
    return table


def before(table: list[int], ends: list[int]) -> list[int]:
    """What each state costs before a segment, given what each costs after it."""
    return [min(BIG, *(table[4 * q + to] + ends[to] for to in range(4))) for q in range(4)]


def edited(turns: list[tuple[str, int]]) -> tuple[list[str], list[int]]:
    """The letters of each turn of a whole conversation and the state before it."""
    parts = [turns[i : i + SEGMENT] for i in range(0, len(turns), SEGMENT)]
    ends = [ENDS]
    for part in reversed(parts[1:]):
        ends.append(before(crossings(part), ends[-1]))
    letters, states = [], [START]
    for part, after in zip(parts, reversed(ends)):
        lattice = Lattice(part, after)
        lattice.auction(states[-1])
        words, passed = lattice.trace(states[-1])
        letters += words
        states += passed[1:]
    return letters, states[:-1]


def damaged(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns after damage by crc32 of `id:turn` modulo 20, equal ones as one row with their number.

    Columns: key (the id as text after '=', '' for null), turn, role, text, copies, dropped, initial (s, u, a or
    empty) and fault (FINE, CUT or BLANK; copies are told later). Nulls of role and text, and in the hashed text,
    count as one space; a null turn stays null. Dropped turns have null role and text.
    """
    name, place = F.col(id).cast("string"), F.col(turn).cast("string")
    kind = F.crc32(F.concat_ws(":", F.coalesce(name, F.lit(" ")), F.coalesce(place, F.lit(" ")))) % 20
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),
        F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, "user").when(kind != 0, F.coalesce(F.col(role).cast("string"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit(" ")), "[.!?]", ""))
        .when(kind != 0, F.coalesce(F.col(text).cast("string"), F.lit(" "))).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    rows = rows.groupBy("key", "turn", "role", "text").agg(F.sum("times").cast("long").alias("copies"))
    initial = F.substring("role", 1, 1)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return rows.select(
        "*",
        F.col("role").isNull().alias("dropped"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"),
        F.when(blank, BLANK).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), FINE).otherwise(CUT).alias("fault"),
    )


_ORDER = ["key", "turn", "role", "text"]  # nulls first
_EDIT = ["key", "pos", "turn", "role", "text", "copies", "dropped", "initial", "fault", "letters", "state"]
_EDITS = (
    "key string, pos long, turn long, role string, text string, copies long, dropped boolean, initial string, "
    "fault int, letters string, state int"
)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def edits(rows: DataFrame, long: int = LONG) -> DataFrame:
    """`rows` of `damaged` with pos (order within the conversation), letters (edits before and of the turn), state
    (what was kept before it) and fault COPY where role and text were seen earlier. A written table.

    Of equal turns that stand together the later ones are always deleted; `letters` is that of the first.
    Turns of one number are ordered by role and text. Conversations of over `long` turns take `_long_edits`.
    """
    rows = durable(rows)
    sizes = rows.groupBy("key").count().where(F.col("count") > long).select("key")
    large = durable(sizes)
    if large.isEmpty():
        return durable(_short_edits(rows))
    large = small_side(large)
    return durable(
        _short_edits(rows.join(large, "key", "left_anti")).unionByName(_long_edits(rows.join(large, "key", "left_semi")))
    )


def _short_edits(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = [], []
        for row in _stream(batches):
            if held and held[0][0] != row[0]:
                out += _conversation(held)
                held = []
                if len(out) > 1000:
                    yield _batch(out, _EDIT, kinds)
                    out = []
            held.append(row)
        if held:
            out += _conversation(held)
        if out:
            yield _batch(out, _EDIT, kinds)

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int32(),
             pa.string(), pa.int32()]
    ordered = rows.select("key", "turn", "role", "text", "copies", "dropped", "initial", "fault")
    return ordered.repartition("key").sortWithinPartitions(*_ORDER).mapInArrow(tidy(run), _EDITS)


def _conversation(rows: list[tuple]) -> list[tuple]:
    kept = [r for r in rows if not r[5]]
    seen, turns = set(), []
    for _, _, role, text, _, _, initial, fault in kept:
        if fault != BLANK:
            known = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            fault = COPY if known in seen else fault
            seen.add(known)
        turns.append((initial, fault))
    letters, states = edited(turns)
    found = [(r[0], i, *r[1:6], *turn, word, state) for i, (r, turn, word, state) in enumerate(zip(kept, turns, letters, states))]
    return found + [(r[0], -1, *r[1:7], r[7], "", START) for r in rows if r[5]]


def _long_edits(rows: DataFrame) -> DataFrame:
    """Edits of conversations that no task should hold, by segments.

    Along a conversation only summaries pass: 16 numbers of each segment against its order, then one state in it.
    """
    none = (F.lit("").alias("letters"), F.lit(START).alias("state"))
    dropped = rows.where("dropped").select("*", F.lit(-1).cast("long").alias("pos"), *none).select(*_EDIT)
    placed, _ = with_position(rows.where("not dropped"), *map(F.col, _ORDER))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = placed.where(F.col("fault") != BLANK).groupBy("key", same).agg(F.min("pos").alias("pos"))
    fault = F.when((F.col("fault") == BLANK) | F.col("first"), F.col("fault")).otherwise(COPY)
    segments = (
        placed.select("key", "pos", "initial", "fault")
        .join(firsts.select("pos", F.lit(True).alias("first")), "pos", "left")
        .groupBy("key", F.floor(F.col("pos") / SEGMENT).alias("segment"))  # at most SEGMENT rows a group
        .agg(F.array_sort(F.collect_list(F.struct("pos", "initial", fault.alias("fault")))).alias("turns"))
    )

    def turns_of(turns: list[dict]) -> list[tuple[str, int]]:
        return [(t["initial"], t["fault"]) for t in turns]

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [crossings(turns_of(turns)) for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tables, pa.list_(pa.int64()))], names=["key", "segment", "turns", "table"]
            )

    made = "key string, segment long, turns array<struct<pos: long, initial: string, fault: int>>"
    crossed = durable(segments.mapInArrow(tidy(cross), f"{made}, table array<long>"))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ends = None, ENDS
        for batch in batches:
            out = []
            for key, segment, table in _stream([batch]):
                ends = ends if key == last else ENDS
                out.append((key, segment, ends))
                last, ends = key, before(table, ends)
            if out:
                yield _batch(out, ["key", "segment", "after"], [pa.string(), pa.int64(), pa.list_(pa.int64())])

    after = (
        crossed.select("key", "segment", "table").repartition("key").sortWithinPartitions("key", F.desc("segment"))
        .mapInArrow(tidy(back), "key string, segment long, after array<long>")
    )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, segment, turns, ends in _stream([batch]):
                lattice, words, states = Lattice(turns_of(turns), ends), [], []
                for entry in range(4):
                    lattice.auction(entry)
                    found, passed = lattice.trace(entry)
                    words.append(found)
                    states.append(passed)
                out.append((key, segment, [t["pos"] for t in turns], [t["fault"] for t in turns], words, states))
            if out:
                texts, numbers = pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.int32()))
                yield _batch(
                    out, ["key", "segment", "pos", "fault", "letters", "states"],
                    [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), texts, numbers],
                )

    traced = durable(
        crossed.select("key", "segment", "turns").join(after, ["key", "segment"]).mapInArrow(
            tidy(trace),
            "key string, segment long, pos array<long>, fault array<int>, letters array<array<string>>, states array<array<int>>",
        )
    )

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, START
        for batch in batches:
            out = []
            for key, segment, exits in _stream([batch]):
                state = state if key == last else START
                out.append((key, segment, state))
                last, state = key, exits[state]
            if out:
                yield _batch(out, ["key", "segment", "entry"], [pa.string(), pa.int64(), pa.int32()])

    exits = F.transform("states", lambda s: F.element_at(s, -1))
    entries = (
        traced.select("key", "segment", exits.alias("exits")).repartition("key").sortWithinPartitions("key", "segment")
        .mapInArrow(tidy(forth), "key string, segment long, entry int")
    )
    chosen = traced.join(entries, ["key", "segment"]).select(
        F.explode(F.arrays_zip(
            "pos", "fault", F.get("letters", F.col("entry")).alias("letters"),
            F.slice(F.get("states", F.col("entry")), 1, F.size("pos")).alias("state"),
        )).alias("e")
    ).select("e.*")
    return placed.drop("fault").join(chosen, "pos").select(*_EDIT).unionByName(dropped)


def lines(role: str, text: str, letters: str, state: int) -> list[tuple[str, str]]:
    """Role and text of what the edits of a turn leave: inserted turns, then the turn unless deleted."""
    found = []
    for letter in letters:
        if letter == "K":
            found.append((role, text))
        elif letter != "D":
            state = _NEXT[state]
            found.append((_ROLES[state], "" if letter == "I" else text))
    return found


def _completion(state: int) -> str:
    return "I" * (ENDS[state] // INSERT)


def _state_after(state: int, letters: str, initial: str) -> int:
    for letter in letters:
        state = _KEPT[state][initial] if letter == "K" else state if letter == "D" else _NEXT[state]
    return state


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of `edits` in order, and after each conversation one without a turn that completes it."""
    last, state = None, START
    for row in _stream(batches):
        key, pos, turn, role, text, copies, dropped, initial, fault, letters, entry = row
        if last is not None and key != last:
            yield last, None, None, None, None, 0, True, "", FINE, _completion(state), state
        if key != last:
            last, state = key, START
        if not dropped:
            state = _state_after(entry, letters, initial)
        yield row
    if last is not None:
        yield last, None, None, None, None, 0, True, "", FINE, _completion(state), state


def _in_order(found: DataFrame) -> DataFrame:
    return found.select(*_EDIT).repartition("key").sortWithinPartitions("key", "pos")


def repaired(found: DataFrame) -> DataFrame:
    """The conversations after repair, from `edits`: key, place (from 0), role, text. Deleted turns are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, place = [], None, 0
        for key, _, _, role, text, _, _, _, _, letters, state in _walk(batches):
            place = place if key == last else 0
            last = key
            for line in lines(role, text, letters, state):
                out.append((key, place, *line))
                place += 1
            if len(out) > 1000:
                yield _batch(out, names, kinds)
                out = []
        if out:
            yield _batch(out, names, kinds)

    names, kinds = ["key", "place", "role", "text"], [pa.string(), pa.int64(), pa.string(), pa.string()]
    return _in_order(found).mapInArrow(tidy(run), "key string, place long, role string, text string")


def audited(found: DataFrame) -> DataFrame:
    """One row per conversation of `edits`: key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns stream by in order, so that a task holds a batch and the audit of one conversation.
    """
    names = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last = [], None
        for key, _, turn, role, text, copies, dropped, initial, fault, letters, state in _walk(batches):
            if key != last:
                last, faults, illegal, cost, audit = key, [0] * 4, 0, 0, []
                digest, started, before_, span, seen = hashlib.sha256(), False, None, None, 0
            audit.append(letters)
            cost += sum(INSERT if x == "I" else DELETE if x == "D" else REROLE if x == "R" else KEEP for x in letters)
            for line in lines(role, text, letters, state):
                digest.update(f"{chr(10) * started}{line[0]}:{line[1]}".encode())
                started = True
            if not dropped:
                cost += TRUNCATED * (fault == CUT and letters[-1] != "D") + DELETE * (copies - 1)
                audit.append("D" * (copies - 1))
                faults[fault] += 1
                faults[BLANK if fault == BLANK else COPY] += copies - 1
                illegal += copies - 1 + (before_ is not None and before_ + initial not in legal)
                before_ = initial
                if turn is not None:
                    seen += span is None or span[1] != turn
                    span = (turn if span is None else span[0], turn)
            elif copies == 0:  # the end of the conversation
                gaps = 0 if span is None else span[1] - span[0] + 1 - seen
                text_out = "".join(audit)
                out.append((key, gaps, faults[BLANK], faults[COPY], faults[CUT], illegal, cost, text_out, digest.hexdigest()))
                if len(out) >= 1000:
                    yield _batch(out, names, kinds)
                    out = []
        if out:
            yield _batch(out, names, kinds)

    schema = ", ".join(f"{n} {'string' if k == pa.string() else 'long'}" for n, k in zip(names, kinds))
    return _in_order(found).mapInArrow(tidy(run), schema)


def repairs(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            long: int = LONG) -> DataFrame:
    """One row per conversation, those without a turn left too: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    The null id is a conversation of its own. Turns are taken by number, null ones first, those of one number by role and
    text; equal rows all count. Long texts are read whole. Other columns are not read. An empty table gives an empty
    result.
    """
    found = audited(edits(damaged(conversations, id, turn, role, text), long))
    kind = conversations.schema[id].dataType
    name = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30).cast(kind))
    return found.select(name.alias("conv_id"), *[c for c in found.columns if c != "key"])
