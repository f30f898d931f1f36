"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, by turn (nulls first; equal turns by role, then by the
SHA-256 of the text), are edited into one whose role initials read
``(s?(ua)+)?``: Keep a row at no cost, Rerole it to user or assistant for 2,
Delete it for 3, Insert an empty user or assistant row anywhere for 2. The
first fault of a row counts: blank (no character but 0x09-0x0D and 0x20),
duplicate (role and text seen earlier in the conversation), truncated (the last
such character is none of ``.!?``). Blank and duplicate rows must be deleted, a
truncated row that stays costs 1 more. The answer is the cheapest list of
edits, of equally cheap ones the first by ASCII order of the edits' initials.

Search: depth first, edits in ASCII order D, I, K, R, under a cost bound that
starts at the costs that the faults force and rises to the least cost that a
failed search has left open. A transposition table keeps for each failed state
(rows read, pattern state) the cost that is known to be needed from there, which
later bounds start from. The first accepting path is then the answer. Where a
conversation has more than ``LONG`` rows the costs needed are first worked out
from its end, so that one bound suffices and the time stays in proportion.

Spark flags the rows (JVM expressions and a window). One job streams rows of
one symbol each, sorted in their partition, through the search; a second one
streams the texts, after the row with the edits, into the repaired rows. A task
holds a byte for each row of the conversation at hand, as the answer does, and
never its texts.

Nulls are one space: a null text is blank, a null role has initial space (which
no pattern has), a null conv_id is one conversation. A conversation without
rows after damage has no edits. Repeated rows are duplicates; extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import saved

LONG = 64
#: Pattern states: nothing yet, after s, after u, after a. An inserted or
#: reroled row leads on: from any but "after u" it is a user, else an assistant.
NEXT = (2, 2, 3, 2)
ACCEPTS = (True, False, False, True)
KEEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
DROP, EMPTY, UNMARK, REPEAT, USER = range(5)
BLANKS = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60


def edits(symbol: str, state: int):
    """(letter, cost, next state, rows read) of the edits before a row, in
    ASCII order. Symbols: ``.`` must go; s, u, a, x by initial, capital if
    truncated; empty after the last row."""
    if symbol:
        yield "D", 3, state, 1
    yield "I", 2, NEXT[state], 0
    if symbol and symbol != ".":
        more, kept = int(symbol.isupper()), KEEPS.get(symbol.lower(), (None,) * 4)[state]
        if kept is not None:
            yield "K", more, kept, 1
        yield "R", 2 + more, NEXT[state], 1


def forced_costs(symbols: str) -> list[int]:
    """Least cost of the rows from each on: of their faults alone."""
    out = [0]
    for c in reversed(symbols):
        out.append(out[-1] + (3 if c == "." else int(c.isupper())))
    return out[::-1]


def exact_costs(symbols: str) -> dict:
    """(rows read, state) -> cost needed from there, worked out from the end."""
    n, out = len(symbols), {}
    for i in range(n, -1, -1):
        symbol = symbols[i:i + 1]
        now = [min([c + out[i + 1, s] for _, c, s, read in edits(symbol, state) if read], default=0 if not symbol and ACCEPTS[state] else _NEVER)
               for state in range(4)]
        for _ in range(2):  # inserts in a row: more than two lead back
            now = [min(x, 2 + now[NEXT[state]]) for state, x in enumerate(now)]
        out.update({(i, state): x for state, x in enumerate(now)})
    return out


def search(symbols: str) -> tuple[int, str]:
    """Cost and letters of the first cheapest list of edits."""
    n = len(symbols)
    forced = forced_costs(symbols)
    needed = exact_costs(symbols) if n > LONG else {}
    bound = needed.get((0, 0), forced[0])
    while True:
        # a frame: rows read, state, what the bound leaves, edits to try, least cost seen, cost and letter leading here
        path = [[0, 0, bound, edits(symbols[:1], 0), _NEVER, 0, ""]]
        while path:
            top = path[-1]
            i, state, left = top[:3]
            if i == n and ACCEPTS[state]:
                return bound - left, "".join(f[6] for f in path)
            for letter, cost, then, read in top[3]:
                at = (i + read, then)
                least = needed.get(at, forced[i + read])
                if cost + least <= left:
                    path.append([*at, left - cost, edits(symbols[i + read:i + read + 1], then), _NEVER, cost, letter])
                    break
                top[4] = min(top[4], cost + least)
            else:  # failed: remember what it takes
                needed[i, state] = top[4]
                path.pop()
                if path:
                    path[-1][4] = min(path[-1][4], top[5] + top[4])
        bound = needed[0, 0]


def rows_after_damage(conversations: DataFrame, damage: bool) -> DataFrame:
    """conv_id, turn, alive, role, text, nth copy. A dropped row stays as one
    that is not alive, so that its conversation is not forgotten."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])
    if not damage:
        return c.select("conv_id", "turn", F.lit(True).alias("alive"), "role", "text", F.lit(1).alias("copy"))
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    kind = F.col("kind")
    return c.withColumn("kind", F.crc32(key) % 20).select(
        "conv_id", "turn", (kind != DROP).alias("alive"), F.when(kind == USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(DROP, EMPTY), "").when(kind == UNMARK, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


def _flagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, initial, fault (blank, duplicate, truncated or
    none; dropped for rows not alive) and the text's digest, in order within
    partitions that hold whole conversations."""
    body = F.rtrim("text", F.lit(BLANKS))
    small = rows.select("conv_id", "turn", "alive", "role", F.sha2("text", 256).alias("digest"), "copy",
                        F.when(~F.col("alive"), "dropped").when(body == "", "blank")
                        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated").alias("own"))
    earlier = Window.partitionBy("conv_id", "alive", "role", "digest").orderBy("turn", "copy")
    again = (F.row_number().over(earlier) > 1) & (F.col("own").isNull() | (F.col("own") == "truncated"))
    return small.repartition("conv_id").withColumn("again", again).select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("again"), "duplicate").otherwise(F.coalesce("own", F.lit(""))).alias("fault")) \
        .sortWithinPartitions("conv_id", "turn", "role", "digest")


_PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def plan_repairs(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """conv_id, n_rows, gaps (turns missing between the least and the largest),
    blank, duplicate, truncated, illegal (neighbouring initials other than su,
    ua, au), cost, audit: one row per conversation."""
    def run(batches):
        import pyarrow as pa

        found = functools.lru_cache(1 << 16)(search)
        legal = ("su", "ua", "au")
        kinds = {"blank": 0, "duplicate": 1, "truncated": 2}
        out, now, started = [], None, False

        def finish():
            symbols = "".join(now["symbols"])
            cost, audit = (found if len(symbols) <= LONG else search)(symbols)
            gaps = now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0
            out.append((now["id"], len(symbols), gaps, *now["faults"], now["illegal"], cost, audit))

        def batch():
            kind = [pa.int64()] * 8 + [pa.string()]
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kind, strict=True)],
                                              ["conv_id", "n_rows", *_PLAN, "audit"])
            out.clear()
            return rows

        for b in batches:
            for i, turn, initial, fault in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not started or i != now["id"]:
                    if started:
                        finish()
                    started = True
                    now = {"id": i, "symbols": [], "first": 0, "last": None, "turns": 0, "faults": [0, 0, 0], "illegal": 0, "before": None}
                if fault == "dropped":
                    continue
                if turn is not None and turn != now["last"]:
                    now["first"] = now["first"] if now["turns"] else turn
                    now["last"], now["turns"] = turn, now["turns"] + 1
                if now["before"] is not None and now["before"] + initial not in legal:
                    now["illegal"] += 1
                now["before"] = initial
                if fault:
                    now["faults"][kinds[fault]] += 1
                symbol = initial if initial in KEEPS else "x"
                now["symbols"].append("." if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
            if len(out) > 1000:
                yield batch()
        if started:
            finish()
        if out:
            yield batch()

    return _flagged(rows_after_damage(conversations, damage)).select("conv_id", "turn", "initial", "fault") \
        .mapInArrow(run, "conv_id long, n_rows long, " + ", ".join(f"{c} long" for c in _PLAN) + ", audit string")


def repaired_rows(conversations: DataFrame, plan: DataFrame, damage: bool = False) -> DataFrame:
    """conv_id, nth (from 1), role, text of the repaired conversations, in order
    within partitions that hold whole conversations."""
    rows = rows_after_damage(conversations, damage).where("alive").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
    first = plan.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit("").alias("digest"), F.col("audit").alias("text"))
    whole = first.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")

    def run(batches):
        import pyarrow as pa

        out, size = [], 0
        conv, letters, at, nth, state = None, "", 0, 0, 0

        def add(i, role, text):
            nonlocal nth, state, size
            nth += 1
            # only the first row can be another than user and assistant in turn
            state = KEEPS[role[:1]][state] if role is not None else NEXT[state]
            out.append((i, nth, role if role is not None else "user" if state == 2 else "assistant", text))
            size += len(text) + 32

        def inserts():
            nonlocal at
            while letters[at:at + 1] == "I":
                at += 1
                add(conv, None, "")

        def batch():
            nonlocal size
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()),
                                                                                strict=True)], ["conv_id", "nth", "role", "text"])
            out.clear()
            size = 0
            return rows

        for b in batches:
            for i, kind, role, text in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not kind:
                    conv, letters, at, nth, state = i, text, 0, 0, 0
                    inserts()
                    continue
                letter = letters[at]
                at += 1
                if letter != "D":
                    add(i, role if letter == "K" else None, text)
                inserts()
                if size > 4 << 20:
                    yield batch()
            if out:
                yield batch()

    return whole.select("conv_id", "kind", "role", "text").mapInArrow(run, "conv_id long, nth long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines joined by newlines.
    Rows must come in order within partitions, as from ``repaired_rows``."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        conv, h, started, out = None, None, False, []

        def batch():
            ids, hashes = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes)], ["conv_id", "sha256"])

        for b in batches:
            for i, role, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if not started or i != conv:
                    if started:
                        out.append((conv, h.hexdigest()))
                    conv, h, started = i, hashlib.sha256(), True
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            if len(out) > 1000:
                yield batch()
        if started:
            out.append((conv, h.hexdigest()))
        if out:
            yield batch()

    return repaired.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, sha256 string")


def repair_conversations(conversations: DataFrame, damage: bool = False) -> tuple[DataFrame, DataFrame]:
    """The plan of each conversation (written once) and the repaired rows."""
    plan = saved(plan_repairs(conversations, damage))
    return plan, repaired_rows(conversations, plan, damage)
