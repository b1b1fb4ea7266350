"""Conversation repair against a dynamic programme over rows, for conversations of one segment and of many."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tapeloom.llm import repair as rp
from tapeloom.llm.sql import ORACLES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, audit string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows):
    """What the contract asks of one conversation's damaged rows, by the least (cost, audit) of every row and state."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    follows, named = {0: 2, 1: 2, 3: 2, 2: 3}, {2: "user", 3: "assistant"}

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for q, (c, a, lines) in list(states.items()):
                new = (c + 5, a + "I", (*lines, named[follows[q]] + ":"))
                if follows[q] not in states or new < states[follows[q]]:
                    states[follows[q]] = new
        return states

    states = inserted({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = defaultdict(list)
        for q, (c, a, lines) in states.items():
            new[q].append((c + 2, a + "D", lines))
            if fault in ("b", "d"):
                continue
            more = 5 if fault else 0
            if (q, role[:1]) in step:
                new[step[q, role[:1]]].append((c + more, a + "K", (*lines, f"{role}:{text}")))
            new[follows[q]].append((c + 1 + more, a + "R", (*lines, f"{named[follows[q]]}:{text}")))
        states = inserted({q: min(v) for q, v in new.items()})
    cost, audit, lines = min(states[q] for q in (0, 3) if q in states)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r[:4])
    return {conv: cheapest(damaged(of)) for conv, of in by.items()}


def found(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def rough(seed, conversations=12, least=0, most=40):
    rng = random.Random(seed)
    words = ["Yes.", "no", "Why?", "", " ", "go on!", "so\n", "été .\t"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    return [
        (rng.choice([c, c, c, None]), rng.choice([None, *range(30)]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice([None, *words]), "x")
        for c in range(conversations)
        for _ in range(rng.randrange(least, most))
    ]


def test_query_equals_programme_and_sql(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = found(rp.repair(rp.damage(table)))
    assert got == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    with duckdb.connect() as duck:
        duck.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
        assert {r[0]: r[1:] for r in duck.execute(ORACLES["op13_repair"]).fetchall()} == got


@pytest.mark.parametrize(("rows", "fan"), [(256, 32), (1, 2), (2, 3), (5, 2)])
def test_segments_give_the_same(spark, monkeypatch, rows, fan):
    monkeypatch.setattr(rp, "ROWS", rows)
    monkeypatch.setattr(rp, "FAN", fan)
    table = rough(rows)
    assert found(rp.repair(rp.damage(spark.createDataFrame(table, SCHEMA).repartition(3)))) == expected(table)


def test_sql_on_nulls_and_ties(spark):
    table = rough(77, 20, 0, 12)
    with duckdb.connect() as duck:
        duck.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
        duck.executemany("insert into conversations values (?, ?, ?, ?)", [r[:4] for r in table])
        assert {r[0]: r[1:] for r in duck.execute(ORACLES["op13_repair"]).fetchall()} == expected(table)


def test_one_long_conversation_lies_in_many_segments(spark):
    table = [(7, t, ("user", "assistant")[t % 2], f"t {t}.", None) for t in range(3000)] + [(8, 1, "user", "same.", None)] * 2000 + [(9, 0, "user", "w " * 400_000, None)]
    got = found(rp.repair(rp.damage(spark.createDataFrame(table, SCHEMA))))
    assert got == expected(table)


def test_nothing_left_and_no_rows(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(5, dropped, "user", "Hi.", None)], SCHEMA)
    assert found(rp.repair(rp.damage(one))) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert rp.repair(rp.damage(one.limit(0))).count() == 0


def test_spans_join_to_the_whole():
    rng = random.Random(9)
    for _ in range(60):
        n = rng.randrange(1, 14)
        initials = [rng.choice("uas x") for _ in range(n)]
        faults = [rng.choice(["", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        cut = sorted({0, n, *(rng.randrange(n + 1) for _ in range(3))})
        parts = [rp.spans(initials[a:b], faults[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
        both = rp.joined(parts)
        assert min(both[0, q] for q in rp.ACCEPTED if (0, q) in both) == rp.spans(initials, faults, whole=True)[0, 0]
