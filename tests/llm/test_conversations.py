"""Conversation repair against a search over all edits, SQL, and its own turns."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import conversations as conv
from brindle.llm import queries
from brindle.llm.oracle import OP12

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(turns):
    """(cost, audit, repaired) by Dijkstra over (turns read, roles so far); roles matter by their last and whether there is any."""
    def allowed(said, r):
        last = said[-1][0][0] if said else ""
        return r in {"": "su", "s": "u", "u": "a", "a": "u"}.get(last, "")

    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, said = heapq.heappop(heap)
        key = (at, said[-1][0][0] if said else "")
        if key in done:
            continue
        done.add(key)
        if at == len(turns) and PATTERN.fullmatch("".join(r[0] for r, _ in said)):
            return cost, audit, said
        for role in ("user", "assistant"):
            if allowed(said, role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", at, (*said, (role, ""))))
        if at < len(turns):
            role, text, fault = turns[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, said))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role and allowed(said, role[0]):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, (*said, (role, text))))
                for other in ("user", "assistant"):
                    if allowed(said, other[0]):
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, (*said, (other, text))))


def by_force(rows):
    """The report of each conversation of (conv_id, turn, role, text) rows, before damage."""
    groups, out = defaultdict(list), {}
    for c, t, role, text in rows:
        groups[c]
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[c] += [] if kind == 0 else [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, faults = set(), [], defaultdict(int)
        for _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            turns.append((role, text, fault))
        known = [t for t, *_ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = cheapest(turns)
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return out


def odd_rows():
    random.seed(5)
    rows = []
    for c in range(150):
        for t in range(random.randrange(0, 9)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = random.choice(["Well.", "No end", " \n", "Well.", None, "", "Why? \t", f"Own {c} {t}!", "été œuvre. 日本。"])
            rows.append((c, random.choice([t, t, t + 3, None]), role, text))
    rows += [(None, t, "user" if t % 2 else "assistant", f"Said {t}.") for t in range(30)] + [(900, None, "user", "Hi."), (900, None, "user", "Hi."), (901, 1, "system", "Only a system.")]
    return rows + [(1000, t, "user" if t % 3 else "assistant", f"Long {t}." + "x" * (t % 2)) for t in range(700)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string").repartition(3)
    return rows.withColumns({"is_turn": F.lit("a"), "audit": F.lit(1), "place": F.lit(None).cast("int")})


def report(df):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_by_force(odd):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in odd.collect()]
    got, want = report(conv.repair_report(conv.damage(odd), odd)), by_force(rows)
    assert got == want
    assert {"D", "I", "K", "R"} <= {e for r in want.values() for e in r[6]}


def test_turns_spell_the_digest(odd):
    damaged = conv.damage(odd)
    audits = conv.repair_audit(damaged, odd)
    turns = defaultdict(list)
    for r in conv.repaired_turns(damaged, audits).collect():
        turns[r["conv_id"]].append((r["place"], r["role"], r["text"], r["edit"]))
    for r in conv.repaired_digests(damaged, audits).collect():
        own = sorted(turns[r["conv_id"]])
        assert [p for p, *_ in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(role[0] for _, role, *_ in own))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in own).encode()).hexdigest() == r["repaired_sha256"]


def test_small_buckets_make_no_difference(monkeypatch):
    random.seed(1)
    codes = [np.array([random.choice([0, 1, 2, 3, 1 | conv.BLANK, 2 | conv.DUPLICATE, 1 | conv.CUT]) for _ in range(random.randrange(40))], dtype=np.int16) for _ in range(300)]
    want = conv.edits(codes)
    monkeypatch.setattr(conv, "BUCKET_TURNS", 8)
    assert conv.edits(codes) == want


def test_empty_table(odd):
    assert conv.repair_report(conv.damage(odd.limit(0)), odd.limit(0)).count() == 0


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT conv_id, {', '.join(NAMES)} FROM ({OP12})").fetchall()}
    got = report(queries.op12_conversations(spark, SF))
    assert got == want
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == by_force(rows)
