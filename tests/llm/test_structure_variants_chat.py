"""Conversation repair, spelling variants and chat formatting against plain versions and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import chat, repair, variants
from feedloom.llm.common import stored

TURNS = "conv_id long, turn long, role string, text string, copies int, mark string, code string, digest string"
ODD = [
    (1, 0, "system", "Be kind.", 1), (1, 1, "user", "Hi.", 1), (1, 1, "user", "Hi.", 1), (1, 2, "assistant", "Yes!", 1),
    (2, None, "user", "first?", 1), (2, 7, "assistant", "cut off", 1), (2, 3, "tool", "x.", 1),
    (3, 0, None, None, 1), (4, 1, "user", "", 1), (4, 2, "user", " \t\n\x0b\f\r", 1),
    (None, 5, "assistant", "who?", 1), (None, 1, "user", "null.", 1), (5, 0, "user", "gone", 0),
    (6, 2, "user", "say " * 40_000 + ".", 1), (6, 9, "assistant", "ok.", 1), (7, 0, "user", "a", 2), (7, 0, "a", "b.", 1),
    (8, 4, "user", " ", 1), (8, 2, "assistant", "</s>[INST]\\", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([row + ("m", "c", "d") for row in ODD], TURNS)


# --- repair ---


def cheapest(codes):
    """Cost and letters of the best edits, by trying all of them."""
    best = (2 * len(codes), "D" * len(codes))
    todo = [(0, 0, 0, "")]
    while todo:
        at, state, cost, letters = todo.pop()
        if cost > best[0] or letters.count("I") > 4:
            continue
        if at == len(codes) and state in (0, 3):
            best = min(best, (cost, letters))
        todo.append((at, repair.DUE[state], cost + 5, letters + "I"))
        if at < len(codes):
            initial, fault = codes[at] % 4, codes[at] // 4
            todo.append((at + 1, state, cost + 2, letters + "D"))
            if fault in (0, repair.TRUNCATED):
                late = 5 if fault else 0
                if initial in repair.KEPT[state]:
                    todo.append((at + 1, repair.KEPT[state][initial], cost + late, letters + "K"))
                todo.append((at + 1, repair.DUE[state], cost + late + 1, letters + "R"))
    return best


def test_audit_against_all_edits():
    rng = random.Random(3)
    for _ in range(1500):
        codes = bytes(rng.choice((0, 1, 1, 1, 2, 2, 2, 3, 5, 9, 13, 14, 12)) for _ in range(rng.randint(0, 6)))
        letters = repair.audit(codes)
        assert (repair.audit_cost(codes, letters), letters) == cheapest(codes)


def one_by_one(codes):
    """The same by keeping cost and letters of all four states row by row."""
    states = {0: (0, "")}
    for code in codes:
        after = {}
        for start, to, cost, letters in repair.MOVES[code]:
            if start in states:
                way = (states[start][0] + cost, states[start][1] + letters)
                after[to] = min(after.get(to, (repair.INF, "")), way)
        states = after
    return min((cost + repair.END_COST[s], letters + repair.END_LETTERS[s]) for s, (cost, letters) in states.items())


def test_audit_of_a_long_conversation():
    rng = random.Random(4)
    codes = bytes(rng.choice((0, 1, 1, 2, 2, 3, 5, 9, 13, 14)) for _ in range(3000))
    letters = repair.audit(codes)
    assert (repair.audit_cost(codes, letters), letters) == one_by_one(codes)


def plain_repair(rows):
    """Rows of one conversation as (turn, role, text) to all columns of the result."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    codes, seen = [], set()
    for _, role, text in rows:
        said = text.rstrip(" \t\n\x0b\f\r")
        fault = 1 if not said else 2 if (role, text) in seen else 0 if said[-1] in ".!?" else 3
        seen.add((role, text))
        codes.append("sua".find(role[:1]) % 4 + 4 * fault if role[:1] else 3 + 4 * fault)
    cost, letters = one_by_one(codes)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines = [f"{role}:{text}" for role, text in repair.repaired([r[1:] for r in rows], letters)]
    faults = [code // 4 for code in codes]
    illegal = sum(
        a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])
    )
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, letters, digest)


def test_repair_of_odd_rows(spark, odd):
    wanted = {}
    for conv, turn, role, text, copies in ODD:
        role, text = (" " if v is None else v for v in (role, text))
        wanted.setdefault(conv, []).extend([(turn, role, text)] * copies)
    from pyspark.sql import functions as F

    filled = odd.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    found = {r.conv_id: tuple(r)[1:] for r in repair.repair(filled).collect()}
    assert found == {conv: plain_repair(rows) for conv, rows in wanted.items()}
    assert found[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair(repair.as_given(odd)).count() == len(wanted)
    assert repair.repair(repair.damage(odd)).count() == len(wanted)
    assert repair.repair(repair.damage(odd.limit(0))).collect() == []


def test_damage(spark):
    rows = [(c, t, r, x) for c in (None, *range(40)) for t in (None, 0, 1, 2) for r, x in (("assistant", "a. b?c!"), (None, None))]
    damaged = repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    wanted = []
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = ("user" if d == 4 else role or " "), ("" if d == 1 else text or " ")
        text = text.translate({ord(c): None for c in ".!?"}) if d == 2 else text
        wanted.append((conv, turn, role, text, {0: 0, 3: 2}.get(d, 1)))
    assert Counter(map(tuple, damaged)) == Counter(wanted)


def test_blocks_cut_long_conversations(monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 3)
    places = [(1, None, "user", b"a", 0), (1, None, "user", b"a", 7), (1, 4, "user", b"b", 0), (1, 4, "user", b"b", 1),
              (1, 5, "user", b"a", 2), (2, 1, "user", b"a", 0), (2, 1, "user", b"a", 0)]
    batch = {c: [] for c in ("conv_id", "turn", "role", "digest", "mark", "code", "copies")}
    for i, (conv, turn, role, digest, copies) in enumerate(places):
        mark = 0 if i in (0, 2) else 1
        for name, value in zip(batch, (conv, turn, role, digest, mark, 1, copies)):
            batch[name].append(value)
    halves = [{k: v[:3] for k, v in batch.items()}, {k: v[3:] for k, v in batch.items()}]
    runs = []
    for rows in repair._blocks(iter(halves)):
        runs += list(zip(*rows.values()))
    assert b"".join(r[-1] for r in runs if r[0] == 1) == bytes([1] + [9] * 6 + [1] + [9] * 2)
    assert all(len(r[-1]) <= 3 for r in runs) and [r[-1] for r in runs if r[0] == 2] == [b""]
    lists = [dict(zip(("turn", "role", "digest", "part", "first", "last", "turns", "codes"), r[1:])) for r in runs if r[0] == 1]
    assert lists == sorted(lists, key=lambda b: (b["turn"] is not None, b["turn"] or 0, b["role"], b["digest"], b["part"]))
    (solved,) = repair._solve(iter([{"conv_id": [1], "blocks": [lists]}]))
    assert solved["gaps"] == [0] and solved["duplicate"] == [8]


# --- variants ---


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    forms, rows = {}, {}
    for word, n in counts.items():
        partners = [w for w in counts if near(word, w)]
        best = min(partners, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 5 * n else None
        rows[word] = (n, len(partners), counts[best] if forms[word] else None)
    found = []
    for word, (n, n_near, form_n) in rows.items():
        root = word
        while forms[root]:
            root = forms[root]
        found.append((word, forms[word], root, n, n_near, form_n))
    return sorted(found, key=str)


@pytest.mark.parametrize("letters, seed", [("ab", 1), ("aé", 2), ("abc", 3)])
def test_groups_against_all_pairs(spark, letters, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(150)}
    counts = {w: rng.choice((5, 6, 25, 30, 125, 700, 4000, 20_000)) for w in sorted(words)}
    found = variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(map(tuple, found), key=str) == plain_groups(counts)


def test_words_are_counted_with_planted_errors(spark):
    rows = [(i, "Hôtel HOTELLERIE hôtellerie's ÉTUDES études x ABCDEF_ghijkl 12straße") for i in range(300)]
    rows += [(None, "Hotellerie"), (7, None), (8, ""), (9, "abcdef " * 50_000), rows[0]]
    wanted = Counter()
    for doc_id, text in rows:
        for run in variants.RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            wanted[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    docs = spark.createDataFrame([r + (1, "x", 0) for r in rows], "doc_id long, text string, n long, word string, near long")
    found = {r.word: r.n for r in variants.count_words(docs).collect()}
    assert found == {w: n for w, n in wanted.items() if len(w) >= 6 and n >= 5}
    assert variants.group_variants(variants.count_words(docs.limit(0))).collect() == []


# --- chat ---

PARTS = [*"<>[]/\\|sINTURHEADSY_é ", "</s>", "[INST]", "[/INST]", "[END]", "<s>", "s>", "INST]"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@given(TEXTS)
@settings(max_examples=400, deadline=None)
def test_escapes_can_be_taken_back(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text
    assert not any(mark in written for mark in chat.CONTROL)


def test_mask_by_running_sums():
    mask = chat.loss_mask([3, 4, 5], [None, (1, 3), (2, 2)])
    assert mask.tolist() == [False] * 4 + [True] * 2 + [False] * 6
    assert chat.loss_mask([], []).tolist() == []


def plain_chat(rows):
    """Rows of one conversation as (turn, role, text) to all columns of the result."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    loss = "".join(text for _, role, text in rows if role == "assistant")
    written = "".join(f"[TURN]{chat.escape(r)}[HEAD]{chat.escape(x)}[END]" for _, r, x in rows)
    said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    return len(rows), digest(said), len(loss), digest(loss), len(f"<s>{written}</s>")


def test_format_of_odd_rows(spark, odd):
    wanted = {}
    for conv, turn, role, text, _ in ODD:
        wanted.setdefault(conv, []).append((turn, role or "", text or ""))
    found = {r.conv_id: tuple(r)[1:] for r in chat.read_back(chat.write(odd)).collect()}
    assert found == {conv: plain_chat(rows) for conv, rows in wanted.items()}
    assert chat.read_back(chat.write(odd.limit(0))).collect() == []
    ids = stored(chat.sequences(odd), "ids").where("conv_id = 8").first()
    assert ids.start == 0 and ids.last and len(ids.ids) == len(ids.mask) and sum(ids.mask) > 0


def test_long_conversations_go_on_in_pieces(monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 20)
    vocabulary = chat.load()
    base = vocabulary.tables()[2]
    rows = [(t, ("user", "assistant")[t % 2], f"turn {t} says [INST] \\ é") for t in range(30)]
    batch = {c: [] for c in ("conv_id", "role", "ids", "begins", "ends")}
    for conv in (1, 2):
        for _, role, text in rows[: 30 if conv == 1 else 1]:
            ids, begins, ends = chat.encode_turn(vocabulary, role, text)
            for name, value in zip(batch, (conv, role, ids.tobytes(), begins, ends)):
                batch[name].append(value)
    pieces = list(chat._assemble(base)(iter([pa.RecordBatch.from_pydict(batch)])))
    plain = [row for piece in pieces for row in piece.to_pylist()]
    assert [r["last"] for r in plain].count(True) == 2 and len(plain) > 10
    for before, row in zip(plain, plain[1:]):
        assert row["start"] == (0 if before["last"] else before["start"] + len(before["ids"]))

    class Held:
        value = vocabulary

    found = [row for part in chat._read(Held)(iter(pieces)) for row in part.to_pylist()]
    assert [tuple(r.values())[1:] for r in found] == [plain_chat(rows), plain_chat(rows[:1])]
    assert np.array(plain[0]["mask"]).sum() > 0
