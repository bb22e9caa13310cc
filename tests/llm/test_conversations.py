"""Conversation repair against a brute-force search over all edits."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest

from sigweave.llm import conversations as c
from sigweave.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(pattern: str) -> tuple[int, str]:
    """Least (cost, letters) over every string of edits of bounded length."""
    best = None

    def legal(roles: str) -> bool:
        body = roles[1:] if roles[:1] == "s" else roles
        return not roles or (len(body) > 0 and body == "ua" * (len(body) // 2))

    def go(i: int, cost: int, letters: str, roles: str, inserts: int) -> None:
        nonlocal best
        if best is not None and (cost, "") > (best[0], ""):
            return
        if i == len(pattern):
            if legal(roles) and (best is None or (cost, letters) < best):
                best = (cost, letters)
        else:
            row = pattern[i]
            go(i + 1, cost + 4, letters + "D", roles, 0)
            if row != "x":
                more = 3 if row.isupper() or row == "+" else 0
                go(i + 1, cost + more, letters + "K", roles + row.lower(), 0)
                for role in "ua":
                    go(i + 1, cost + more + 3, letters + "R", roles + role, 0)
        if inserts < 2:
            for role in "ua":
                go(i, cost + 3, letters + "I", roles + role, inserts + 1)

    go(0, 0, "", "", 0)
    return best


def test_edits_equal_brute_force():
    for n in range(4):
        for rows in itertools.product("suaSA+-x", repeat=n):
            pattern = "".join(rows)
            assert c.cheapest(pattern) == brute(pattern), pattern
    rng = random.Random(5)
    for _ in range(60):
        pattern = "".join(rng.choice("suaxUA-") for _ in range(5))
        assert c.cheapest(pattern) == brute(pattern), pattern


def test_a_hash_collision_is_noticed(monkeypatch):
    patterns = ["uuaxsu", "aaUxua", "ssuuaa", "xxuAxu"]
    right = [c.cheapest(p) for p in patterns]
    monkeypatch.setattr(c, "_MODULUS", 3)
    assert [c.cheapest(p) for p in patterns] == right


def plain(rows: list[tuple]) -> dict:
    """Digest of every conversation, row by row in Python; rows are (conv, turn, role, text, gone)."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = [(t, " " if r is None else r, " " if x is None else x) for v, t, r, x, gone in rows if v == conv and not gone]
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, pattern, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            body = text.rstrip(c.SPACES)
            fault = (
                "blank" if not body
                else "duplicate" if (role, text) in seen
                else "truncated" if body[-1] not in ".!?"
                else None
            )
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
            cut = {"s": "S", "u": "U", "a": "A", "-": "+"}
            pattern += "x" if fault in ("blank", "duplicate") else cut[initial] if fault else initial
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in c.LEGAL for a, b in itertools.pairwise(kept))
        cost, audit = c.cheapest(pattern)
        lines, _ = c.replay([(r, t) for _, r, t in kept], audit)
        joined = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (
            gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256(joined.encode()).hexdigest(),
        )
    return out


COLUMNS = [
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
]


def made(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", None, "Well?  ", "same.", "x" * 300 + ".", "a|b", "é ü."]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(1, 9) if conv else 60):
            rows.append(
                (
                    conv,
                    rng.choice([turn, turn, turn, turn, None, turn + 2]),
                    rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                    rng.choice([*texts, f"t{turn}.", f"t{turn}."]),
                    rng.random() < 0.1,
                )
            )
    return rows + rows[5:9]


@pytest.mark.parametrize("slice_rows", [4096, 3])
def test_repair_equals_a_plain_pass(spark, monkeypatch, slice_rows):
    """Also for a conversation of many slices, nulls, ties, repeated rows and absent rows."""
    monkeypatch.setattr(c, "SLICE_ROWS", slice_rows)
    rows = made(40, slice_rows) + [(77, 1, "user", "gone", True), (78, None, None, None, False)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", gone boolean, h long")
    found = {r.conv_id: tuple(r[x] for x in COLUMNS) for r in c.repair(df, absent=df["gone"]).collect()}
    assert found == plain(rows)
    assert found[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_messages_are_what_the_hash_is_of(spark, monkeypatch):
    monkeypatch.setattr(c, "SLICE_ROWS", 5)
    rows = [r[:4] for r in made(15, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    hashes = {r.conv_id: r.repaired_sha256 for r in c.repair(df).collect()}
    texts: dict = {}
    for r in sorted(c.messages(df).collect(), key=lambda r: (r.part, r.slice, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, digest in hashes.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == digest


def test_hot_conversation_is_split(spark, monkeypatch):
    """One conversation holds most rows: its rows lie in many slices and come out whole."""
    monkeypatch.setattr(c, "SLICE_ROWS", 100)
    rows = [(1, i, ("user", "assistant")[i % 3 == 1], f"text {i}.") for i in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, SCHEMA)
    slices = c._sliced(df, None, with_lines=False)
    sizes = [r.n for r in slices.collect()]
    assert len(sizes) > 30 and max(sizes) <= 100
    found = {r.conv_id: r for r in c.repair(df).collect()}
    assert found[2].audit == "KK"
    expected = plain([(*r, False) for r in rows])
    assert tuple(found[1][x] for x in COLUMNS) == expected[1]


def test_empty_table_and_very_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair(empty).count() == 0 and c.messages(empty).count() == 0
    long = "word " * 400_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "Yes.")]
    found = c.repair(spark.createDataFrame(rows, SCHEMA)).first()
    assert found.audit == "KK"
    whole = f"user:{long}\nassistant:Yes."
    assert found.repaired_sha256 == hashlib.sha256(whole.encode()).hexdigest()


def test_registered_query_equals_sql(spark, sf_dir, duck):
    rows = queries.QUERIES["op13_conversation_repair"](spark, sf_dir)
    columns = sorted(rows.columns)
    twin = duck.execute(queries.CHECKS["op13_conversation_repair"]).fetchdf()[columns]
    assert sorted(map(tuple, rows.select(columns).collect()), key=repr) == sorted(
        (tuple(r) for r in twin.itertuples(index=False)), key=repr
    )
