"""Conversation repair against a search over all edits, row by row."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest

from sparkmart.llm import conversation_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\v\f\r"


def damaged(rows):
    """Rows of each conversation after the damage, in order."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        rule = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if rule == 0:
            continue
        if rule == 1:
            text = ""
        elif rule == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif rule == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if rule == 3 else 1)
    for kept in convs.values():
        kept.sort(
            key=lambda r: (
                r[0] is not None,
                r[0] or 0,
                r[1],
                hashlib.sha256(r[2].encode()).hexdigest(),
            )
        )
    return convs


def expected(rows):
    out = []
    for conv, kept in damaged(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            stripped = text.strip(BLANKS)
            fault = None
            if not stripped:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif stripped[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faults.append(fault)

        @cache
        def best(i, state, inserted=0, kept=kept, faults=faults):
            """(cost, audit, turns) of the cheapest way to the end; at most 2 inserts in a row."""
            found = []
            if i == len(kept) and state in "0a":
                found.append((0, "", ()))
            wanted = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
            name = {"u": "user", "a": "assistant"}[wanted]

            def add(letter, cost, after, turn):
                found.append(
                    (cost + after[0], letter + after[1], ((turn,) if turn else ()) + after[2])
                )

            if inserted < 2:
                add("I", 3, best(i, wanted, inserted + 1), f"{name}:")
            if i < len(kept):
                _, role, text = kept[i]
                more = 3 if faults[i] == "truncated" else 0
                add("D", 4, best(i + 1, state), None)
                if faults[i] not in ("blank", "duplicate"):
                    add("R", 3 + more, best(i + 1, wanted), f"{name}:{text}")
                    if role[:1] == wanted or (state == "0" and role[:1] == "s"):
                        add("K", more, best(i + 1, role[:1]), f"{role}:{text}")
            return min(found, default=(10**9, "~", ()))

        cost, audit, turns = best(0, "0")
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for _, role, _ in kept]
        pairs = [a + b for a, b in zip(initials, initials[1:], strict=False)]
        out.append(
            (
                conv,
                gaps,
                *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(turns).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", " ", "", None, "One. Two", "a?\n", "é…", ".", "Hm?"]
    rows = []
    for conv in range(n):
        turns = list(range(rng.randrange(9)))
        for turn in turns:
            turn = rng.choice([turn, turn, turn, turn, turn * 3, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_equals_search_over_all_edits(spark):
    rows = conversations(3, 600)
    assert got(conversation_repair.repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "Hi."),
        (None, None, "user", "Hi."),
        (5, None, None, "x."),
        (5, -7, "assistant", "x."),
        (5, 9, "system", "x." * 100_000),
        *[(6, 2, "user", "Same.")] * 5,
        *[(6, 2, "assistant", "Same.")] * 2,
        (6, 3, "user", "Same."),
    ]
    # Conversations of which every row is dropped.
    gone = [n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0][:2]
    rows += [(n, 0, "user", "Hello.") for n in gone]
    frame = spark.createDataFrame(rows, SCHEMA)
    more = frame.selectExpr("*", "'x' as phase", "1 as copies", "2 as code", "'y' as digest")
    found = got(conversation_repair.repair(more))
    assert found == expected(rows)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [r for r in found if r[0] in gone] == [(n, *nothing) for n in gone]
    assert got(conversation_repair.repair(frame.limit(0))) == []


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_change_nothing(monkeypatch, block):
    rng = np.random.default_rng(block)
    samples = [rng.integers(0, 4, n) | rng.choice([0, 0, 0, 4, 8], n) for n in range(40)]
    whole = [conversation_repair.least_audit(s.astype(np.uint8)) for s in samples]
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    for codes, (cost, parts) in zip(samples, whole, strict=True):
        again, cut = conversation_repair.least_audit(codes.astype(np.uint8))
        assert (again, b"".join(cut)) == (cost, b"".join(parts))


def test_ranks_order_audits():
    """Ranks order the least audits of all nodes, as sorting the strings does."""
    rng = np.random.default_rng(1)
    codes = (rng.integers(0, 4, 60) | rng.choice([0, 0, 4, 8], 60)).astype(np.uint8)
    costs = conversation_repair._steps(codes, np.array([0, 6, 3, 0]))
    letter, leads = conversation_repair._arcs(codes, costs)
    for done in (len(letter) - 4, len(letter) - 1):
        letter[done], leads[done] = 0, done
    all_ranks, pointers = conversation_repair.ranks(letter, leads)

    def audit(node):
        out = ""
        while letter[node]:
            out += chr(letter[node])
            node = leads[node]
        return out

    audits = [audit(n) for n in range(len(letter))]
    order = {a: k for k, a in enumerate(sorted(set(audits)))}
    assert all_ranks[-1].tolist() == [order[a] for a in audits]
    for k, pointer in enumerate(pointers):
        assert all(audits[p] == a[2**k :] for p, a in zip(pointer, audits, strict=True))


def test_registered_query_equals_search(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(queries.queries()["op12_repair"](spark, sf_dir)) == expected(rows)
