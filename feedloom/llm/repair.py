"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Legal initials are ``(s?(ua)+)?``, four states: nothing yet, after the system, after a user, after an assistant. A
row is kept (0), reroled to the user or assistant due (1) or deleted (2, the only way for blank and duplicate
rows); an empty turn of the user or assistant due can be inserted (5); a truncated row that stays costs 5 more. Of the
cheapest edits those count whose letters (D, I, K, R) are least in ASCII order.

The search is Hirschberg's: a vector of four costs runs forward to the middle of the conversation, one runs backward to
it, the state where their sum is least is crossed, and both halves are solved the same way; no table of rows by states
is kept. Beside its cost the forward vector carries the rank of each state's least letters: two ways to different
states both end with a row's letter, so neither is the beginning of the other and the rank alone settles ties.

Texts stay out of the search. Rows are sorted by conversation and turn over ranges, so that a conversation
of any length is spread over tasks, and become one byte each; a task that solves a conversation holds as many bytes as its
audit has letters. The repaired text is hashed in one sorted pass, a row at a time; SHA-256 of a single conversation
cannot be divided.

Defined results: nulls in role and text are one space; a null turn comes first; rows of one turn are ordered by role
and md5 of the text; null ``conv_id`` is one conversation; equal rows repeat; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import run_batches, stored

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
INITIALS = "sua"
BLOCK = 1 << 16  # codes in a row of the sorted pass
REMEMBERED = 1 << 16  # short conversations whose audit a task remembers
INF = 1 << 40

# State after the user or assistant that is due, and after a kept row by its initial.
DUE = (2, 2, 3, 2)
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
# Cost and letters of the turns to insert behind the last row.
END_COST = (0, 10, 5, 0)
END_LETTERS = ("", "II", "I", "")


def _moves(code: int) -> list[tuple[int, int, int, str]]:
    """The best way from each state to each other over one row: ``from, to, cost, letters``.

    Insertions stand before a row that stays, never before a deletion: D sorts before I at the same cost.
    """
    initial, fault = code % 4, code // 4
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        ways = [(start, 2, "D")]
        if fault not in (BLANK, DUPLICATE):
            late = 5 if fault == TRUNCATED else 0
            state = start
            for inserted in range(3):
                before = 5 * inserted + late
                if initial in KEPT[state]:
                    ways.append((KEPT[state][initial], before, "I" * inserted + "K"))
                ways.append((DUE[state], before + 1, "I" * inserted + "R"))
                state = DUE[state]
        for to, cost, letters in ways:
            best[start, to] = min(best.get((start, to), (INF, "")), (cost, letters))
    return [(start, to, *way) for (start, to), way in sorted(best.items())]


MOVES = [_moves(code) for code in range(16)]


@functools.lru_cache(1 << 16)
def _forward(vector: tuple, code: int) -> tuple:
    """(cost, rank) of the four states one row later; costs count from the least, so vectors recur."""
    found: list[tuple | None] = [None] * 4
    for start, to, cost, letters in MOVES[code]:
        before, rank = vector[start]
        if before < INF:
            way = (before + cost, rank, letters)
            if found[to] is None or way < found[to]:
                found[to] = way
    least = min(way[0] for way in found if way)
    order = sorted(way[1:] for way in found if way)
    return tuple((way[0] - least, order.index(way[1:])) if way else (INF, 4) for way in found)


@functools.lru_cache(1 << 16)
def _backward(vector: tuple, code: int) -> tuple:
    """Cost to go from the four states one row earlier."""
    found = [INF] * 4
    for start, to, cost, _ in MOVES[code]:
        if vector[to] < INF:
            found[start] = min(found[start], cost + vector[to])
    least = min(found)
    return tuple(cost - least if cost < INF else INF for cost in found)


def _at(state: int) -> tuple:
    return tuple(0 if s == state else INF for s in range(4))


def audit(codes: bytes) -> str:
    """The letters of the edits for the rows of a conversation."""
    letters: list[str] = []
    state = 0
    # Halves still to solve, first ones on top: from row, to row, cost to go behind the last of them.
    todo = [(0, len(codes), END_COST)]
    while todo:
        low, high, behind = todo.pop()
        if high - low == 1:
            _, way, state = min(
                (cost + behind[to], way, to)
                for start, to, cost, way in MOVES[codes[low]]
                if start == state and behind[to] < INF
            )
            letters.append(way)
        elif high > low:
            middle = (low + high) // 2
            ahead = tuple((0, 0) if s == state else (INF, 4) for s in range(4))
            for at in range(low, middle):
                ahead = _forward(ahead, codes[at])
            rest = behind
            for at in range(high - 1, middle - 1, -1):
                rest = _backward(rest, codes[at])
            crossing = min(
                (ahead[s][0] + rest[s], ahead[s][1], s) for s in range(4) if ahead[s][0] < INF and rest[s] < INF
            )[2]
            todo.append((middle, high, behind))
            todo.append((low, middle, _at(crossing)))
    return "".join(letters) + END_LETTERS[state]


def audit_cost(codes: bytes, letters: str) -> int:
    """What the edits cost, with the truncated rows that stay."""
    rows = letters.replace("I", "")
    late = sum(code // 4 == TRUNCATED and letter != "D" for code, letter in zip(codes, rows))
    return letters.count("R") + 2 * letters.count("D") + 5 * letters.count("I") + 5 * late


def illegal_pairs(codes: bytes) -> int:
    """Neighbouring rows whose initials are not su, ua or au."""
    first, second = (bytes(code % 4 for code in part) for part in (codes[:-1], codes[1:]))
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(first, second))


def repaired(rows, letters: str) -> Iterator[tuple[str, str]]:
    """``role, text`` of the turns that the edits give, from the rows' roles and texts in order."""
    state = 0
    rows = iter(rows)
    due = lambda: "assistant" if state == 2 else "user"
    for letter in letters:
        if letter == "I":
            yield due(), ""
            state = DUE[state]
            continue
        role, text = next(rows)
        if letter == "D":
            continue
        if letter == "R":
            role, state = due(), DUE[state]
        else:
            state = KEPT[state][INITIALS.index(role[:1])]
        yield role, text


# --- rows in Spark ---


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by a checksum of their place; 0 copies are a dropped row."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    by = F.crc32(F.concat_ws(":", *words).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(by == 4, "user").otherwise(role).alias("role"),
        F.when(by == 1, "").when(by == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(by == 0, 0).when(by == 3, 2).otherwise(1).alias("copies"),
    )


def as_given(conversations: DataFrame) -> DataFrame:
    """The same shape without damage."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select("conv_id", "turn", role, text, F.lit(1).alias("copies"))


def _digest(text: str) -> Column:
    return F.unhex(F.md5(text))


def _code() -> Column:
    """Initial and fault of a row in one number, duplicates left out."""
    stripped = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    fault = F.when(stripped == "", BLANK).when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return place + 4 * fault


ORDER = ("conv_id", "turn", "role", "digest")
BLOCKS = (
    "conv_id long, turn long, role string, digest binary, part long, first long, last long, turns long, codes binary"
)


def _blocks(batches):
    """Sorted cells to runs of codes: a run lies in one conversation and holds ``BLOCK`` codes at most.

    A cell is preceded by a mark if no earlier one has its role and text. ``first``, ``last`` and ``turns`` are of
    the run's turns that are not null.
    """
    names = ("conv_id", "turn", "role", "digest", "part", "first", "last", "turns", "codes")
    held: dict | None = None
    marked = None
    for batch in batches:
        rows: dict[str, list] = {name: [] for name in names}
        for *place, mark, code, copies in zip(*(batch[c] for c in (*ORDER, "mark", "code", "copies"))):
            if mark == 0:
                marked = place
                continue
            # A blank row is blank first, and a duplicate else.
            repeat = code if code // 4 == BLANK else code % 4 + 4 * DUPLICATE
            part, new = 0, marked == place
            while copies or part == 0:
                if held is None or held["conv_id"] != place[0] or len(held["codes"]) >= BLOCK:
                    _put(held, rows)
                    held = dict(zip(names, (*place, part, None, None, 0, bytearray())))
                part += 1
                if not copies:
                    break
                if place[1] is not None and place[1] != held["last"]:
                    held["first"] = place[1] if held["turns"] == 0 else held["first"]
                    held["last"] = place[1]
                    held["turns"] += 1
                if new:
                    held["codes"].append(code)
                    copies, new = copies - 1, False
                now = min(copies, BLOCK - len(held["codes"]))
                held["codes"].extend(bytes([repeat]) * now)
                copies -= now
        yield rows
    rows = {name: [] for name in names}
    _put(held, rows)
    yield rows


def _put(held: dict | None, rows: dict[str, list]) -> None:
    if held is not None:
        for name, value in held.items():
            rows[name].append(bytes(value) if name == "codes" else value)


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _solve(batches):
    memory: dict[bytes, tuple] = {}
    for batch in batches:
        rows = {name: [] for name in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")}
        for conv, blocks in zip(batch["conv_id"], batch["blocks"]):
            codes = b"".join(block["codes"] for block in blocks)
            found = memory.get(codes)
            if found is None:
                letters = audit(codes)
                faults = bytes(code // 4 for code in codes)
                found = (
                    *(faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)),
                    illegal_pairs(codes), audit_cost(codes, letters), letters,
                )
                if len(codes) <= 64:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    memory[codes] = found
            # Every run counts its turns; one that goes on in the next run counts once.
            gaps, low, last = 0, None, None
            for block in blocks:
                if block["turns"]:
                    first = block["first"]
                    gaps -= block["turns"] - (first == last)
                    low = first if low is None else low
                    last = block["last"]
            gaps = gaps + last - low + 1 if low is not None else 0
            for name, value in zip(rows, (conv, gaps, *found)):
                rows[name].append(value)
        yield rows


def _hashes(batches):
    """Sorted rows, each conversation's audit first, to hashes of the repaired turns."""
    state = None  # conversation, hash so far, its audit, place in it, state, whether a turn was written

    def step(letter, role, text):
        nonlocal state
        at = state["at"]
        due = "assistant" if at == 2 else "user"
        if letter == "I":
            role, text = due, ""
            state["at"] = DUE[at]
        elif letter == "R":
            role = due
            state["at"] = DUE[at]
        else:
            state["at"] = KEPT[at][INITIALS.index(role[:1])]
        line = f"{role}:{text}"
        state["sha"].update((("\n" + line) if state["any"] else line).encode())
        state["any"] = True

    def inserts():
        while state["audit"][state["place"] : state["place"] + 1] == "I":
            state["place"] += 1
            step("I", "", "")

    for batch in batches:
        rows: dict[str, list] = {"conv_id": [], "repaired_sha256": []}

        def finish():
            inserts()
            rows["conv_id"].append(state["conv"])
            rows["repaired_sha256"].append(state["sha"].hexdigest())

        for conv, mark, role, text, copies in zip(*(batch[c] for c in ("conv_id", "mark", "role", "text", "copies"))):
            if mark == 0:
                if state is not None:
                    finish()
                state = {"conv": conv, "sha": hashlib.sha256(), "audit": text, "place": 0, "at": 0, "any": False}
                continue
            for _ in range(copies):
                inserts()
                letter = state["audit"][state["place"]]
                state["place"] += 1
                if letter != "D":
                    step(letter, role, text)
        yield rows
    if state is not None:
        rows = {"conv_id": [], "repaired_sha256": []}
        finish()
        yield rows


def repair(rows: DataFrame) -> DataFrame:
    """Audits, counts of faults and the hash of the repaired turns, one row per ``conv_id``.

    ``rows`` are ``conv_id, turn, role, text, copies``; conversations whose rows have no copies are empty ones.
    """

    def no(kind: str) -> Column:
        return F.lit(None).cast(kind)

    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", F.col("copies").cast("long"),
        _digest("text").alias("digest"),
    )
    cells = stored(
        rows.groupBy(*ORDER, _code().alias("code")).agg(F.sum("copies").alias("copies")), "cells"
    )
    # The place of the first row with its role and text; a null turn comes first in a struct, too.
    firsts = (
        cells.where("copies > 0")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"))
        .select("conv_id", "first.turn", "role", "digest", F.lit(0).alias("mark"), no("int").alias("code"), no("long").alias("copies"))
    )
    # Mark and cell have one place, so both reach the same task.
    marked = cells.withColumn("mark", F.lit(1)).unionByName(firsts)
    ranged = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, "mark")
    blocks = run_batches(ranged, _blocks, BLOCKS)
    one = F.struct("turn", "role", "digest", "part", "first", "last", "turns", "codes")
    lists = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("blocks"))
    found = stored(run_batches(lists, _solve, RESULT), "audits")
    audits = found.select(
        "conv_id", no("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
        F.lit(0).cast("long").alias("copies"), no("binary").alias("digest"), F.lit(0).alias("mark"),
    )
    turns = rows.where("copies > 0").withColumn("mark", F.lit(1))
    stream = turns.unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "mark", "turn", "role", "digest")
    hashes = run_batches(stream.select("conv_id", "mark", "role", "text", "copies"), _hashes, "conv_id long, repaired_sha256 string")
    return found.join(hashes.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
