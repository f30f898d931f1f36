"""Conversation repair against all lists of edits, and on odd rows."""

import hashlib
import heapq
import random
import re

import pytest

from orrery.llm import repair as R
from tests.llm.util import frame


def cheapest(symbols):
    """Least (cost, letters) by uniform cost over plain lists of edits; the
    roles are checked against the pattern itself."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, roles = heapq.heappop(heap)
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters
        if (i, roles) in seen or len(roles) > len(symbols) + 3 or not re.fullmatch("s?(ua)*u?", roles):
            continue
        seen.add((i, roles))
        for role in "ua":
            heapq.heappush(heap, (cost + 2, letters + "I", i, roles + role))
        if i < len(symbols):
            c = symbols[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, roles))
            if c != ".":
                cut = int(c.isupper())
                heapq.heappush(heap, (cost + cut, letters + "K", i + 1, roles + c.lower()))
                for role in "ua":
                    heapq.heappush(heap, (cost + cut + 2, letters + "R", i + 1, roles + role))


@pytest.mark.parametrize("seed", range(3))
def test_search_finds_the_first_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(250):
        symbols = "".join(rng.choice("ssuuuaaaxSUAX..") for _ in range(rng.randrange(8)))
        assert R.search(symbols) == cheapest(symbols), symbols


def test_long_conversations_give_the_same(monkeypatch):
    rng = random.Random(7)
    for _ in range(60):
        symbols = "".join(rng.choice("suuuaaaxSUAX..") for _ in range(rng.randrange(30)))
        monkeypatch.setattr(R, "LONG", 64)
        plain = R.search(symbols)
        monkeypatch.setattr(R, "LONG", -1)
        assert R.search(symbols) == plain
    cost, letters = R.search("uaUx." * 20_000)
    assert cost == 20_000 * 6 and letters.count("D") == 20_000


def test_forced_costs_never_exceed_the_exact_ones():
    rng = random.Random(8)
    for _ in range(200):
        symbols = "".join(rng.choice("suaxSUAX.") for _ in range(rng.randrange(20)))
        forced, exact = R.forced_costs(symbols), R.exact_costs(symbols)
        assert all(forced[i] <= exact[i, s] for i, s in exact)


def by_hand(rows):
    """The answer for one conversation's rows (turn, role, text), nulls as one space."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    symbols, faults, seen = "", [0, 0, 0], set()
    for _, role, text in rows:
        body = text.strip(R.BLANKS)
        k = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if k is not None:
            faults[k] += 1
        c = role[:1] if role[:1] in ("s", "u", "a") else "x"
        symbols += "." if k in (0, 1) else c.upper() if k == 2 else c
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = cheapest(symbols)
    out, i, state = [], 0, 0
    for letter in audit:
        if letter == "K":
            out.append(rows[i][1:])
            state = {"s": 1, "u": 2, "a": 3}[rows[i][1][0]]
        elif letter != "D":
            state = 3 if state == 2 else 2
            out.append(("user" if state == 2 else "assistant", rows[i][2] if letter == "R" else ""))
        i += letter != "I"
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, *faults,
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, out)


def test_rows_and_odd_rows(spark):
    rng, convs = random.Random(11), {}
    for i in range(60):
        convs[i] = [(rng.choice([None, 1, 2, 3, 5, 8]), rng.choice(["user", "assistant", "system", "tool", "", None, "uma"]),
                     rng.choice(["Yes.", "No", None, "", " \t\x0b\n", "what? ", "é.\n", ". . x"])) for _ in range(rng.randrange(1, 7))]
    convs[None] = [(1, "user", "a."), (2, "assistant", "b."), (2, "assistant", "b.")]
    convs[100] = [(1, "user", "long " * 300_000 + "."), (2, "assistant", "b")]
    rows = [(i, *r, "kind", 1) for i, rs in convs.items() for r in rs]
    rng.shuffle(rows)
    table = frame(spark, rows, "conv_id long, turn long, role string, text string, audit string, kind int")
    plan, repaired = R.repair_conversations(table)
    got, lines = {r.conv_id: r for r in plan.collect()}, {}
    for r in sorted(repaired.collect(), key=lambda r: (r.conv_id or -1, r.nth)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    sums = {r.conv_id: r.sha256 for r in R.digests(repaired).collect()}
    assert set(got) == set(convs)
    for i, rs in convs.items():
        want, r = by_hand(rs), got[i]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, lines.get(i, [])) == want, i
        if want[-1]:
            assert sums[i] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in want[-1]).encode()).hexdigest()
    plan, repaired = R.repair_conversations(table.limit(0), damage=True)
    assert plan.collect() == [] and repaired.collect() == []


def test_damage_keeps_every_conversation(spark):
    rows = [(i, t, "user" if t % 2 else "assistant", f"text {t}. Is it? Yes!") for i in range(200) for t in range(i % 3 + 1)]
    table = frame(spark, rows, "conv_id long, turn long, role string, text string")
    plan, repaired = R.repair_conversations(table, damage=True)
    got = plan.collect()
    assert sorted(r.conv_id for r in got) == list(range(200))
    gone = [r for r in got if not r.n_rows]
    assert gone and all((r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (0, 0, 0, 0, 0, 0, "") for r in gone)
    assert repaired.where(repaired.conv_id.isin([r.conv_id for r in gone])).collect() == []
