"""Conversation structure repair: the cheapest edits that make a conversation's roles `(s?(ua)+)?`.

A dynamic program over turns, time-major: conversations are bucketed by their number of turns, and a bucket is a tensor of
(turn, conversation). Going backwards, all conversations' costs to the end are updated for the four states of the role
pattern at once and stored; going forwards, all conversations' edits are traced at once, each step taking
the ASCII-least edit that still reaches the stored cost.

Spark deals rows by conversation and sorts them by turn; a worker streams over sorted rows. It holds a byte and
two hashes per turn of the conversations at hand, never their texts. A second pass over rows sorted alike applies the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import SPACE_CLASS, checkpoint, release_memory

#: States of the role pattern: nothing yet, after the system turn, after a user's turn, after an assistant's turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn that is inserted or given another role: a user's turn if one is due, else an assistant's.
DUE = np.array([USER, USER, ASSISTANT, USER])
FAR = 1 << 40
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: Codes of a turn: what its role's initial is, plus flags.
ROLE_S, ROLE_U, ROLE_A, OTHER = range(4)
BLANK, DUPLICATE, CUT = 4, 8, 16
#: The state after keeping a turn of role s, u or a in each state; -1 where the pattern forbids it.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
EDITS = np.frombuffer(b"DIKR", dtype=np.uint8)
#: Turns (with padding) that one bucket has in memory at most, but for conversations longer than that.
BUCKET_TURNS = 1 << 18


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage that crc32 of `conv_id:turn` settles, with a mark for the repeated ones; nulls are one space."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("__copy")).drop("__copy")


def costs_to_end(codes: np.ndarray) -> np.ndarray:
    """(turns + 1, 4, conversations): the least cost from before each turn in each state to an accepted end. `codes` is
    (turns, conversations); -1 is padding after a conversation's end."""
    turns, n = codes.shape
    cost = np.full((turns + 1, 4, n), FAR, dtype=np.int64)
    cost[turns, [START, ASSISTANT]] = 0
    _insert(cost[turns])
    for t in range(turns - 1, -1, -1):
        code, after = codes[t], cost[t + 1]
        gone = code < 0
        role, bad, extra = code & 3, (code & (BLANK | DUPLICATE)) > 0, np.where(code & CUT, TRUNCATED, 0)
        for s in range(4):
            best = after[s] + DELETE
            stay = after[DUE[s]] + REROLE + extra
            for r in (ROLE_S, ROLE_U, ROLE_A):
                if KEPT[s, r] >= 0:
                    stay = np.where(role == r, np.minimum(stay, after[KEPT[s, r]] + extra), stay)
            cost[t, s] = np.where(gone, after[s], np.where(bad, best, np.minimum(best, stay)))
        _insert(cost[t])
    return cost


def _insert(cost: np.ndarray) -> None:
    """Lets turns be inserted before what follows. A third one would bring back a state."""
    for _ in range(2):
        np.minimum(cost, cost[DUE] + INSERT, out=cost)


def trace(codes: np.ndarray, cost: np.ndarray) -> list[bytes]:
    """The edits of each conversation: of all cheapest ones the ASCII-least."""
    turns, n = codes.shape
    ends = (codes >= 0).sum(axis=0)
    at, state, every = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.arange(n)
    steps = []
    while True:
        code = np.where(at < ends, codes[np.minimum(at, turns - 1), every] if turns else -1, -1)
        now, here = cost[at, state, every], code >= 0
        following = np.minimum(at + 1, turns)
        extra = np.where(code & CUT, TRUNCATED, 0)
        fine = here & ((code & (BLANK | DUPLICATE)) == 0)
        kept = np.where(fine, KEPT[state, code & 3], -1)
        options = [
            (here & (cost[following, state, every] + DELETE == now), following, state),
            (cost[at, DUE[state], every] + INSERT == now, at, DUE[state]),
            ((kept >= 0) & (cost[following, np.maximum(kept, 0), every] + extra == now), following, kept),
            (fine & (cost[following, DUE[state], every] + REROLE + extra == now), following, DUE[state]),
        ]
        chosen = np.select([o[0] for o in options], range(4), -1)
        if (chosen < 0).all():
            break
        at, state = (np.select([chosen == i for i in range(4)], [o[k] for o in options], before) for k, before in ((1, at), (2, state)))
        steps.append(chosen)
    table = np.array(steps, dtype=np.int64).reshape(len(steps), n).T
    return [EDITS[row[row >= 0]].tobytes() for row in table]


def bucket_of(n: int) -> int:
    """Conversations of up to 1, 2, 4, 8, ... turns share a bucket."""
    return 1 << max(n - 1, 0).bit_length()


def edits(conversations: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(cost, edits) of each conversation, given by its turns' codes; bucketed by length."""
    buckets: dict[int, list[int]] = {}
    for i, c in enumerate(conversations):
        buckets.setdefault(bucket_of(len(c)), []).append(i)
    out: list = [None] * len(conversations)
    for width, members in buckets.items():
        step = max(1, BUCKET_TURNS // width)
        for part in (members[i : i + step] for i in range(0, len(members), step)):
            codes = np.full((width, len(part)), -1, dtype=np.int16)
            for j, i in enumerate(part):
                codes[: len(conversations[i]), j] = conversations[i]
            cost = costs_to_end(codes)
            for j, (i, found) in enumerate(zip(part, trace(codes, cost))):
                out[i] = (int(cost[0, START, j]), found)
    return out


class _Turns:
    """The conversation that a worker is reading: its turns' codes so far, and what its row of the report needs."""

    def __init__(self):
        self.codes, self.seen = bytearray(), set()
        self.low = self.high = self.turn = self.last = None
        self.distinct = self.illegal = 0

    def add(self, turn, role: str, fingerprint: bytes, blank: bool, cut: bool) -> None:
        initial = role[:1]
        duplicate = fingerprint in self.seen
        self.seen.add(fingerprint)
        fault = BLANK if blank else DUPLICATE if duplicate else CUT if cut else 0
        self.codes.append({"s": ROLE_S, "u": ROLE_U, "a": ROLE_A}.get(initial, OTHER) | fault)
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.turn:
            self.low, self.high, self.distinct, self.turn = turn if self.low is None else self.low, turn, self.distinct + 1, turn

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _dealt(rows: DataFrame) -> DataFrame:
    """All rows of a conversation in one partition, in order: first the row that stands for the conversation, then turns."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "is_turn", "turn", "role", "text")]
    return rows.repartition(F.col("conv_id")).sortWithinPartitions(*order)


def repair_audit(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of `conversations` (conv_id), whose rows
    are `turns` (conv_id, turn, role, text).

    Turns are taken in order of turn (nulls first), role and text. Nulls in role and text are one space; rows of a null conv_id are one
    conversation. A role's first character counts; what is none of s, u and a can't be kept. Conversations without
    rows have zeros and an empty audit. One worker streams over a conversation's turns and holds 17 bytes of each, and their costs.
    """
    kind = dict(turns.dtypes)["conv_id"]
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){SPACE_CLASS}*\z", 1)
    blank = last == ""
    named = turns.select("conv_id", F.lit(True).alias("is_turn"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    heads = conversations.select("conv_id").unionByName(turns.select("conv_id")).distinct().select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"))
    rows = _dealt(named.unionByName(heads)).select("conv_id", "is_turn", "turn", "role", "text", blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("cut"))

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        ids, open_turns, held = [], [], 0

        def flush(n: int) -> pa.RecordBatch:
            own, done = open_turns[:n], edits([np.frombuffer(bytes(t.codes), dtype=np.uint8).astype(np.int16) for t in open_turns[:n]])
            count = lambda flag: [sum(1 for c in t.codes if c & flag) for t in own]
            columns = [pa.concat_arrays(ids[:n])]
            for values in ([t.gaps() for t in own], count(BLANK), count(DUPLICATE), count(CUT), [t.illegal for t in own], [c for c, _ in done]):
                columns.append(pa.array(values, pa.int64()))
            columns.append(pa.array([a.decode() for _, a in done], pa.string()))
            del ids[:n], open_turns[:n]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        for part in parts:
            conv, c = part.column("conv_id"), {k: part.column(k).to_pylist() for k in ("is_turn", "turn", "role", "text", "blank", "cut")}
            for i, turn in enumerate(c["is_turn"]):
                if not turn:
                    ids.append(conv.slice(i, 1))
                    open_turns.append(_Turns())
                    continue
                fingerprint = xxhash.xxh3_128_digest(f"{len(c['role'][i])}:{c['role'][i]}{c['text'][i]}".encode())
                open_turns[-1].add(c["turn"][i], c["role"][i], fingerprint, c["blank"][i], c["cut"][i])
                held += 1
            for t in open_turns[:-1]:
                t.seen.clear()
            if held >= BUCKET_TURNS and len(ids) > 1:
                yield flush(len(ids) - 1)
                held = len(open_turns[-1].codes)
        if ids:
            yield flush(len(ids))
        release_memory()

    return rows.mapInArrow(stream, f"conv_id {kind}, {REPORT}")


def _edited(turns: DataFrame, audits: DataFrame, digest: bool) -> DataFrame:
    kind = dict(turns.dtypes)["conv_id"]
    named = turns.select("conv_id", F.lit(True).alias("is_turn"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    heads = audits.select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = _dealt(named.unionByName(heads))

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over conversations; of the one at hand it holds the edits, the state, and the running hash."""
        conv = audit = None
        at = state = place = 0
        sha, hashes, made = hashlib.sha256(), [], []

        def say(role: str, text: str, edit: str) -> None:
            nonlocal place
            if digest:
                sha.update((("\n" if place else "") + f"{role}:{text}").encode())
            else:
                made.append((conv, place, role, text, edit))
            place += 1

        def due() -> str:
            nonlocal state
            state = int(DUE[state])
            return "user" if state == USER else "assistant"

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                say(due(), "", "I")
                at += 1

        def close() -> None:
            if audit is not None:
                insert()
                if digest:
                    hashes.append((conv, sha.hexdigest()))

        def table() -> pa.RecordBatch:
            out, names = (hashes, ["conv_id", "repaired_sha256"]) if digest else (made, ["conv_id", "place", "role", "text", "edit"])
            kinds = [pa.string()] if digest else [pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = list(zip(*out)) if out else [()] * len(names)
            ids = columns[0]
            batch = pa.RecordBatch.from_arrays([pa.concat_arrays(ids) if ids else pa.array([], id_type), *[pa.array(x, k) for x, k in zip(columns[1:], kinds)]], names=names)
            out.clear()
            return batch

        id_type = pa.int64()
        for part in parts:
            ids, is_turn, roles, texts = part.column("conv_id"), part.column("is_turn").to_pylist(), part.column("role").to_pylist(), part.column("text").to_pylist()
            id_type = ids.type
            for i, turn in enumerate(is_turn):
                if not turn:
                    close()
                    conv, audit, at, state, place, sha = ids.slice(i, 1), texts[i], 0, START, 0, hashlib.sha256()
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = int(KEPT[state, "sua".index(roles[i][0])])
                    say(roles[i], texts[i], "K")
                elif edit == "R":
                    say(due(), texts[i], "R")
            yield table()
        close()
        yield table()
        release_memory()

    return rows.mapInArrow(apply, f"conv_id {kind}, " + ("repaired_sha256 string" if digest else "place long, role string, text string, edit string"))


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the conversations' turns after the edits of `repair_audit`; places count from 0, inserted
    turns have an empty text. Conversations of which nothing stays have no row."""
    return _edited(turns, audits, False)


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of every conversation: of its repaired turns as `role:text`, joined by newlines."""
    return _edited(turns, audits, True)


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Audit and digest of every conversation in one table; see `repair_audit`."""
    audits = checkpoint(repair_audit(turns, conversations))
    digests = repaired_digests(turns, audits).withColumnRenamed("conv_id", "__conv")
    return audits.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
