"""Conversation repair against a brute-force search over all edit sequences of least cost."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from kpiloom.llm import conversation_repair as cr
from kpiloom.llm.queries import damaged, op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def best(rows):
    """(cost, audit, repaired rows) by Dijkstra's search over (cost, audit): states are (row, last initials)."""
    seen = set()
    heap = [(0, "", 0, "", ())]
    faults = [r[2] for r in rows]
    while heap:
        cost, audit, i, given, out = heapq.heappop(heap)
        state = given[-1:] if given != "" else ""
        if i == len(rows) and legal(given):
            return cost, audit, out
        if (i, state) in seen:
            continue
        seen.add((i, state))
        ok = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for x, name in (("u", "user"), ("a", "assistant")):
            if x in ok:
                heapq.heappush(heap, (cost + 5, audit + "I", i, given + x, out + ((name, ""),)))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, given, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in ok:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, given + role[0], out + ((role, text),)))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if x in ok:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, given + x, out + ((name, text),)))
    raise AssertionError


def brute(rows):
    """conv -> gaps, blank, duplicate, truncated, illegal, cost, audit, digest for damaged rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, judged = set(), []
        for _, _, role, text in mine:
            fault = None
            if not re.search(r"[^\x20\x09-\x0D]", text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        cost, audit, fixed = best(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, *[sum(j[2] == f for j in judged) for f in ("blank", "duplicate", "truncated")],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def conversations(n, longest, seed):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        kind = r.random()
        roles = ["user", "assistant"] if kind < .4 else ["system", "user", "assistant", "tool", "", None] if kind < .8 else ["tool"]
        texts = ["Yes.", "No!", "so", "", " \n", "Why?\t ", "well, é", None] if r.random() < .7 else ["Fine.", "Good.", "Right!", *[f"Say {i}." for i in range(30)]]
        for turn in range(r.randint(1, longest)):
            rows.append((conv if conv else None, r.choice([turn, turn, turn, turn * 2, None]), r.choice(roles), r.choice(texts)))
            if r.random() < .1:
                rows.append(rows[-1])
    r.shuffle(rows)
    return rows


def result(summary, turns):
    sha = {x.conv: x.sha for x in cr.fingerprints(turns).collect()}
    return {x.conv_id: (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, sha.get(x.conv, EMPTY)) for x in summary.collect()}


@pytest.mark.parametrize("chunk,passes", [(4096, 6), (5, 6), (3, 0), (1, 1)])
def test_repairs_are_the_cheapest(spark, chunk, passes):
    rows = conversations(60, 14, 3)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", conv string, sha int")
    want = brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert result(*cr.repair(df, chunk, passes)) == want


def test_one_long_conversation(spark):
    """Rows that never converge: costs go through every chunk."""
    rows = [(7, i, "tool" if i % 11 else "user", f"Number {i}.") for i in range(300)] + [(8, i, "user", "Same.") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(*cr.repair(df, 16, 2)) == brute(rows)


def test_fix_up_stops_at_constants():
    r = np.random.default_rng(0)
    codes = r.integers(0, 12, (200, 30))
    old, new = (np.tile(cr.END, (200, 1)) + r.integers(0, 9, (200, 4)) for _ in range(2))
    first = cr.backward(codes, old)[:, 0]
    assert (cr.fix_up(codes, new, old, first) == cr.backward(codes, new)[:, 0]).all()


def test_query_and_damage(spark, tmp_path):
    rows = conversations(200, 6, 5)
    path = tmp_path / "conversations.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(path))
    broken = damage(rows)
    key = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
    assert sorted((tuple(x) for x in damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=key) == sorted(broken, key=key)
    want = brute(broken)
    got = op11_conversation_repair(spark, str(tmp_path)).collect()
    assert len(got) == len({r[0] for r in rows})
    for x in got:
        assert tuple(x)[1:] == want.get(x.conv_id, (0, 0, 0, 0, 0, 0, "", EMPTY))


def test_empty_table(spark):
    summary, turns = cr.repair(spark.createDataFrame([], SCHEMA))
    assert summary.count() == 0 and turns.count() == 0 and cr.fingerprints(turns).count() == 0
