"""Repair of conversations whose turns are blank, repeated, cut off or out of order, at the least cost.

A repaired conversation has the role initials ``(s?(ua)+)?``. Edits of a turn:
Keep (0), Rerole to user or assistant (1), Delete (2; blank and repeated turns
have to go); a truncated turn that stays costs 5 more. An empty user or
assistant turn may be Inserted anywhere (5). Of all cheapest repairs the one
whose audit, the edits' initials in order, is least in ASCII is taken.

Method. Between turns a conversation is in one of four states: nothing yet,
after s, after u, after a. Nodes are (place, state, wanted end state); a cost DP
walks back from the end, and arcs on some cheapest path are kept. In a state a
letter leads to one node, so each node's least path begins with its least
optimal letter. Nodes are then ranked by the first 1, 2, 4, ... letters of
their path: the rank by 2k letters is the rank of (rank by k letters, rank by k
letters of the node k letters on), and pointers double with it. Ranks tell
which path is least, doubled pointers give its letters.

Size. Turns are dealt by range of (conv_id, turn, role, text's digest), so a
conversation of any length lies in as many tasks as it needs, and cut into
slices of bounded rows and bytes. A slice gives the cost, the audit and the
audit's rank from each state to each state, 16 of each; slices of a
conversation then meet by these numbers alone, some 200 bytes for a thousand
turns. An insertion belongs to the turn after it, so no slice's audit begins
another of the same slice, and comparing ranks slice by slice is comparing the
audits. Copies of a row are counted before anything is sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, durable

#: A slice of a conversation, and what a task solves at once, at most.
SLICE_ROWS, SLICE_BYTES, GROUP_ROWS, GROUP_BYTES = 1024, 1 << 20, 4096, 8 << 20
#: Costs: of an edit, of an insertion, of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults of a turn.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: State after keeping a turn of initial s, u, a or another, by state before; 4: not allowed.
KEEP = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
#: State after an inserted or reroled turn, by state before, and that turn's role.
NEXT = np.array([2, 2, 3, 2])
ROLES = ("user", "user", "assistant", "user")
#: Insertions that end a conversation in each state.
TAIL = (0, 2, 1, 0)
INFINITE = 1 << 40
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Repaired:
    """conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost. slices: conv_id, part, slice, audit, turns (role, text), in the order of part and slice."""

    conversations: DataFrame
    slices: DataFrame


def damage(turns: DataFrame) -> DataFrame:
    """Turns damaged by crc32('conv_id:turn') % 20; nulls count as one space, but for conv_id and turn as such."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    hurt = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def _fault(text: Column) -> Column:
    return F.when(~text.rlike(f"[^{SPACE}]"), BLANK).when(~text.rlike(rf"[.!?][{SPACE}]*\z"), CUT).otherwise(SOUND)


def flagged(turns: DataFrame) -> DataFrame:
    """Different turns: conv_id, turn, role, text, mark (the text's digest), copies, fault, later (role and text stood at an earlier turn)."""
    spaced = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    counted = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *spaced).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    marked = counted.withColumn("mark", F.md5(F.col("text").cast("binary"))).withColumn("at", F.coalesce("turn", F.lit(-(1 << 63))))
    first = marked.groupBy("conv_id", "role", "mark").agg(F.min("at").alias("first")).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    return marked.join(first.hint("merge"), same).select("conv_id", "turn", "role", "text", "mark", "copies", _fault(F.col("text")).alias("fault"), (F.col("at") > F.col("first")).alias("later"))


class Slice:
    """Turns of one conversation that follow each other, as they come in from a task's sorted rows."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.roles, self.texts, self.faults, self.turns, self.size = conv_id, [], [], [], [], 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.roles.append(role)
        self.texts.append(text if fault in (SOUND, CUT) else "")  # what has to go is not carried on
        self.faults.append(fault)
        self.turns.append(turn)
        self.size += len(role) + len(self.texts[-1])

    @property
    def full(self) -> bool:
        return len(self.roles) >= SLICE_ROWS or self.size >= SLICE_BYTES


def initial_codes(roles: list[str]) -> list[int]:
    return ["sua".find(r[:1]) % 4 if r else 3 for r in roles]


def solve(codes: list[list[int]], faults: list[list[int]]) -> list[tuple[np.ndarray, np.ndarray, list[str | None]]]:
    """For each slice the costs, ranks and audits of its cheapest repairs from each state to each (state * 4 + end state); None where there is none."""
    out: list = [None] * len(codes)
    classes: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        classes.setdefault(len(c).bit_length(), []).append(i)
    for members in classes.values():
        solved = _solve_alike([np.array(codes[i]) for i in members], [np.array(faults[i]) for i in members])
        for i, x in zip(members, solved):
            out[i] = x
    return out


def _solve_alike(codes: list[np.ndarray], faults: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, list[str | None]]]:
    n = np.array([len(c) for c in codes])
    rows = np.cumsum(n) - n
    code, fault = np.concatenate(codes), np.concatenate(faults)
    places = rows + np.arange(len(n))  # of each slice's first place; it has one more than turns
    total = int(n.sum()) + len(n)
    cost = np.full((total, 4, 4), INFINITE, np.int64)
    letter = np.zeros((total, 4, 4), np.int64)
    to = np.arange(total * 16).reshape(total, 4, 4)
    cost[places + n] = np.where(np.eye(4, dtype=bool), 0, INFINITE)
    ends, states = np.arange(4), np.arange(4)[:, None]
    for back in range(1, int(n.max()) + 1):
        live = n >= back
        here = (places + n - back)[live]
        c, f = code[(rows + n - back)[live]], fault[(rows + n - back)[live]]
        after = np.concatenate([cost[here + 1], np.full((len(here), 1, 4), INFINITE)], axis=1)
        stays = np.where((f == BLANK) | (f == DUPLICATE), INFINITE, np.where(f == CUT, TRUNCATED, 0))[:, None, None]
        kept_in = KEEP[c]
        ways = np.empty((4, len(here), 4, 4), np.int64)  # D, I, K, R
        ways[0] = DELETE + after[:, :4]
        ways[2] = stays + np.take_along_axis(after, kept_in[:, :, None].repeat(4, 2), 1)
        ways[3] = stays + REROLE + after[:, NEXT]
        best = np.minimum(np.minimum(ways[0], ways[2]), ways[3])
        for _ in range(3):
            best = np.minimum(best, INSERT + best[:, NEXT])
        ways[1] = INSERT + best[:, NEXT]
        cost[here] = best
        found = best < INFINITE
        least = np.argmax(ways == best, axis=0)  # the first of D, I, K, R on a cheapest path
        base = here[:, None, None]
        targets = np.stack([np.broadcast_to((base + 1) * 16 + states * 4 + ends, best.shape), np.broadcast_to(base * 16 + NEXT[:, None] * 4 + ends, best.shape), (base + 1) * 16 + np.minimum(kept_in, 3)[:, :, None] * 4 + ends, np.broadcast_to((base + 1) * 16 + NEXT[:, None] * 4 + ends, best.shape)])
        letter[here] = np.where(found, least + 1, 0)
        to[here] = np.where(found, np.take_along_axis(targets, least[None], 0)[0], to[here])

    # ranks by 1, 2, 4, ... letters and pointers as many letters on, until every path has ended
    rank, pointer, doubled = letter.ravel(), to.ravel(), []
    symbol = rank
    while (symbol[pointer] > 0).any():
        doubled.append(pointer)
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1].reshape(-1)
        pointer = pointer[pointer]
    starts = (places[:, None] * 16 + np.arange(16)).ravel()
    path = starts[:, None]
    for pointer in reversed(doubled):
        path = np.stack([path, pointer[path]], axis=2).reshape(len(starts), -1)
    letters = LETTERS[symbol[path]]
    lengths, reached = (letters > 0).sum(1), cost.ravel()[starts] < INFINITE
    audits = [row[:k].tobytes().decode() if ok else None for row, k, ok in zip(letters, lengths.tolist(), reached.tolist())]
    costs, ranks = cost.ravel()[starts].reshape(-1, 16), rank[starts].reshape(-1, 16)
    return [(costs[i], ranks[i], audits[16 * i : 16 * i + 16]) for i in range(len(n))]


SLICE_SCHEMA = (
    "conv_id long, part long, slice long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "low long, high long, numbers long, costs array<long>, ranks array<long>, audits array<string>, roles array<string>, texts array<string>"
)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def slices_of(ordered: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the sorted turns of one task, solved some thousand turns at a time."""
    part, number, group, held, now = TaskContext.get().partitionId(), 0, [], [0, 0], None
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("slice", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("first_initial", pa.string()), ("last_initial", pa.string()), *[(c, pa.int64()) for c in ("low", "high", "numbers")], ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])

    def solved() -> Iterator[pa.RecordBatch]:
        nonlocal number
        if group:
            rows = []
            for s, (costs, ranks, audits) in zip(group, solve([initial_codes(s.roles) for s in group], [s.faults for s in group])):
                initials = [r[:1] for r in s.roles]
                numbered = [t for t in s.turns if t is not None]
                illegal = sum(p not in LEGAL for p in zip(initials, initials[1:]))
                rows.append((s.conv_id, part, number, *[s.faults.count(k) for k in (BLANK, DUPLICATE, CUT)], illegal, initials[0], initials[-1], numbered[0] if numbered else None, numbered[-1] if numbered else None, len(set(numbered)), costs, ranks, audits, s.roles, s.texts))
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            group.clear()
            held[:] = [0, 0]

    for batch in ordered:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault", "later")]
        for conv_id, turn, role, text, copies, fault, later in zip(*columns):
            for k in range(copies):
                if now is None or now.conv_id != conv_id or now.full:
                    if now is not None:
                        group.append(now)
                        held[0], held[1] = held[0] + len(now.roles), held[1] + now.size
                        if held[0] >= GROUP_ROWS or held[1] >= GROUP_BYTES:
                            yield from solved()
                    now = Slice(conv_id)
                now.add(turn, role, text, DUPLICATE if fault != BLANK and (later or k) else fault)
    if now is not None:
        group.append(now)
    yield from solved()


def chain(slices: list[dict]) -> tuple[int, list[int], int]:
    """The cheapest repair through a conversation's slices: its cost, for each slice state * 4 + end state, and insertions at the end."""
    cost, place = [0, INFINITE, INFINITE, INFINITE], [0, 0, 0, 0]
    came = []
    for s in slices:
        options = [min((cost[a] + s["costs"][4 * a + e], place[a], s["ranks"][4 * a + e], a) for a in range(4)) for e in range(4)]
        cost = [min(o[0], INFINITE) for o in options]
        order = {k: i for i, k in enumerate(sorted({o[1:3] for o in options}))}
        place = [order[o[1:3]] for o in options]
        came.append([o[3] for o in options])
    end = min(range(4), key=lambda e: (cost[e] + INSERT * TAIL[e], place[e]))
    total, tail, picks = cost[end] + INSERT * TAIL[end], TAIL[end], []
    for back in reversed(came):
        picks.append(4 * back[end] + end)
        end = back[end]
    return total, picks[::-1], tail


def combined(slices: DataFrame) -> DataFrame:
    """A row for each conversation that has turns: what was counted, the cost, and picks (part, slice, pick, tail) for its slices."""
    names = ["part", "slice", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "low", "high", "numbers", "costs", "ranks"]
    grouped = slices.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("slices"))
    pick = pa.struct([("part", pa.int64()), ("slice", pa.int64()), ("pick", pa.int32()), ("tail", pa.int32())])
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for parts in b.column("slices").to_pylist():
                total, picks, tail = chain(parts)
                numbered = [p for p in parts if p["numbers"]]
                seams = sum(p["high"] == q["low"] for p, q in zip(numbered, numbered[1:]))
                gaps = numbered[-1]["high"] - numbered[0]["low"] + 1 - sum(p["numbers"] for p in numbered) + seams if numbered else 0
                illegal = sum(p["illegal"] for p in parts) + sum((p["last_initial"], q["first_initial"]) not in LEGAL for p, q in zip(parts, parts[1:]))
                chosen = [{"part": p["part"], "slice": p["slice"], "pick": k, "tail": 0} for p, k in zip(parts, picks)]
                chosen[-1]["tail"] = tail
                rows.append((gaps, *[sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")], illegal, total, chosen))
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.int64()] * 6 + [pa.list_(pick)])] if rows else [pa.array([], t) for t in [pa.int64()] * 6 + [pa.list_(pick)]]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *arrays], names=["conv_id", *counts, "picks"])

    return arrow_task(grouped, work, "conv_id long, " + ", ".join(f"{c} long" for c in counts) + ", picks array<struct<part:long,slice:long,pick:int,tail:int>>")


def edited(roles: list[str], texts: list[str], audit: str, state: int) -> list[dict]:
    """The turns an audit makes of those of a slice that begins in a state."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            out.append({"role": ROLES[state], "text": ""})
            state = NEXT[state]
            continue
        if letter == "K":
            out.append({"role": roles[at], "text": texts[at]})
            state = KEEP[initial_codes(roles[at : at + 1])[0], state]
        elif letter == "R":
            out.append({"role": ROLES[state], "text": texts[at]})
            state = NEXT[state]
        at += 1
    return out


def repair(turns: DataFrame) -> Repaired:
    """Repair the conversations of a table of turns: conv_id, turn, role, text; other columns are not read.

    Turns stand by turn, nulls first, then by role and the text's md5, so
    copies of a row are neighbours. A null role or text counts as one space, a
    null conv_id is a conversation of its own. A turn's first fault counts:
    blank (nothing but white space), duplicate (role and text stood before, in
    a turn of whatever fault), truncated (the last visible character is none of
    . ! ?). gaps are numbers that lack between the least and largest turn,
    illegal counts neighbours whose initials are not su, ua or au. A role of
    another initial, or of none, can't be kept. Texts of any length go through
    whole. A conversation of which nothing stays has no turns in its slices; an
    empty table has no conversations. Both results read tables written to the
    shared checkpoint folder.
    """
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("mark").asc()]
    ordered = flagged(turns).repartitionByRange(*keys).sortWithinPartitions(*keys)
    slices, _ = durable(arrow_task(ordered, slices_of, SLICE_SCHEMA), "repair-slices")
    conversations, _ = durable(combined(slices), "repair-conversations")
    picks = conversations.select(F.explode("picks").alias("p")).select(F.col("p.part").alias("of_part"), F.col("p.slice").alias("of_slice"), "p.pick", "p.tail")
    chosen = slices.join(picks, (F.col("part") == F.col("of_part")) & (F.col("slice") == F.col("of_slice"))).select("conv_id", "part", "slice", "roles", "texts", "pick", "tail", F.get("audits", F.col("pick")).alias("audit"))
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            audits, rows = [], []
            for roles, texts, pick, tail, audit in zip(*[b.column(c).to_pylist() for c in ("roles", "texts", "pick", "tail", "audit")]):
                audits.append(audit + "I" * tail)
                rows.append(edited(roles, texts, audits[-1], pick // 4))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("conv_id", "part", "slice")], pa.array(audits, pa.string()), pa.array(rows, pa.list_(turn))], names=["conv_id", "part", "slice", "audit", "turns"])

    fixed = arrow_task(chosen, work, "conv_id long, part long, slice long, audit string, turns array<struct<role:string,text:string>>")
    return Repaired(conversations.drop("picks"), fixed)


def digests(slices: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 (of role:text, newline-joined) of each conversation, its slices read in order one after the other."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "part", "slice")]
    ordered = slices.repartition("conv_id").sortWithinPartitions(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, sha, any_yet = None, [], None, False
        for b in batches:
            ids, shas, audits = [], [], []

            def end() -> None:
                ids.append(now)
                audits.append("".join(audit))
                shas.append(sha.hexdigest())

            for conv_id, piece, turns in zip(*[b.column(c).to_pylist() for c in ("conv_id", "audit", "turns")]):
                if sha is None or conv_id != now:
                    if sha is not None:
                        end()
                    now, audit, sha, any_yet = conv_id, [], hashlib.sha256(), False
                audit.append(piece)
                for t in turns:
                    sha.update((("\n" if any_yet else "") + t["role"] + ":" + t["text"]).encode())
                    any_yet = True
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(audits, pa.string()), pa.array(shas, pa.string())], names=["conv_id", "audit", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array(["".join(audit)], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["conv_id", "audit", "repaired_sha256"])

    return arrow_task(ordered.select("conv_id", "audit", "turns"), work, "conv_id long, audit string, repaired_sha256 string")
