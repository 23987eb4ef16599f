"""Repair of a conversation's structure at least cost, by layers of reachable grammar states."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import reread, shuffle_partitions

# The grammar of role initials is (s?(ua)+)?, with states 0 (nothing yet), 1 (after s), 2 (after u), 3 (after a); 0 and 3 accept.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLES = {"u": "user", "a": "assistant"}
#: What may be added at each state, by inserting a turn or giving a turn another role.
WANTED = "uuau"
DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1
#: Initials of the edits; their ASCII order breaks ties.
EDITS = "DIKR"
#: A layer is four bits, one for each state; a word holds LAYERS of them, for costs base, base + 1, and so on.
LAYERS = 16
ONES = sum(1 << 4 * k for k in range(LAYERS))
ALL = 15 * ONES
#: Row codes: role initial s, u, a or another one, plus 4 if the text is cut off; rows that must go have a code of their own.
GONE = 8
BLANK = " \t\n\v\f\r"
#: A conversation of more rows or characters is handled in pieces.
PIECE_ROWS, PIECE_CHARS = 512, 1 << 21
FAN = 64


def _before(word: int, initial: str) -> int:
    """The states, layer by layer, from which `initial` leads to a state of the word."""
    out = 0
    for state, to in NEXT.get(initial, {}).items():
        out |= (word >> to & ONES) << state
    return out


def _with_inserts(word: int) -> int:
    while (more := word | (_before(word, "u") | _before(word, "a")) << 4 * INSERT & ALL) != word:
        word = more
    return word


#: A bit of layer k: from this state the rest can be repaired within cost k. At the end, only inserts are left.
END = _with_inserts(ONES | ONES << 3)


@functools.cache
def step(word: int, code: int) -> tuple[int, int]:
    """The word before a row from the word after it, and by how much its first layer's cost is higher.

    As in matching with errors, every edit shifts the states that it leads to by its cost in layers. From any state the
    rest costs at most 8 more than from another one, so later layers are full and a word of 16 layers loses nothing.
    """
    out = word << 4 * DELETE
    if code != GONE:
        late = UNFINISHED * (code >> 2)
        out |= _before(word, "sua "[code & 3]) << 4 * late
        out |= (_before(word, "u") | _before(word, "a")) << 4 * (REROLE + late)
    out, base = _with_inserts(out & ALL), 0
    while not out & 15:
        out, base = out >> 4 | 15 << 4 * (LAYERS - 1), base + 1
    return out, base


@functools.cache
def layer(word: int, state: int) -> int:
    """The first layer that holds the state."""
    return next(k for k in range(LAYERS) if word >> 4 * k + state & 1)


@functools.cache
def edits(before: int, after: int, base: int, code: int, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits at a row, inserts before it included, and the state they lead to."""
    out = ""
    while True:
        left = layer(before, state)
        if layer(after, state) + DELETE == left + base:
            return out + "D", state
        wanted = WANTED[state]
        if layer(before, NEXT[wanted][state]) + INSERT == left:
            out, state = out + "I", NEXT[wanted][state]
            continue
        late = UNFINISHED * (code >> 2)
        kept = None if code == GONE else NEXT.get("sua "[code & 3], {}).get(state)
        if kept is not None and layer(after, kept) + late == left + base:
            return out + "K", kept
        return out + "R", NEXT[wanted][state]


@functools.cache
def last_edits(state: int) -> str:
    """The inserts after the last row."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]


def backward(codes: bytes, word: int = END) -> tuple[list[int], list[int]]:
    """The word before each row and after the last one, and by how much each row raises the base."""
    words, bases = [word], []
    for code in reversed(codes):
        word, base = step(word, code)
        words.append(word)
        bases.append(base)
    return words[::-1], bases[::-1]


def trace(codes: bytes, words: list[int], bases: list[int], state: int = 0) -> tuple[list[str], int]:
    """The edits at each row from a state on, and the state after the last row."""
    out = []
    for i, code in enumerate(codes):
        done, state = edits(words[i], words[i + 1], bases[i], code, state)
        out.append(done)
    return out, state


def rewritten(turns: list[tuple[str, str]], done: list[str], state: int, last: bool) -> list[tuple[str, str]]:
    """The turns after these edits, from a state on; `last`: with the inserts that the end needs."""
    out = []
    for (role, text), edit in zip([*turns, ("", "")] if last else turns, [*done, last_edits] if last else done):
        for e in edit(state) if callable(edit) else edit:
            wanted = WANTED[state]
            if e == "I":
                out.append((ROLES[wanted], ""))
            elif e == "R":
                out.append((ROLES[wanted], text))
            elif e == "K":
                wanted = role[0]
                out.append((role, text))
            if e != "D":
                state = NEXT[wanted][state]
    return out


@functools.cache
def profiles() -> tuple[int, ...]:
    """Every word that any rows can lead to, from the end on: what a piece must know of the rows after it is one of them."""
    known, new = [END], [END]
    while new:
        new = sorted({step(w, c)[0] for w in new for c in range(GONE + 1)} - set(known))
        known += new
    return tuple(known)


def fault(text: str, seen: bool) -> str:
    """A turn's first fault: blank, duplicate, truncated or none."""
    end = text.rstrip(BLANK)[-1:]
    return "blank" if not end else "duplicate" if seen else "" if end in ".!?" else "truncated"


def code_of(role: str, wrong: str) -> int:
    if wrong in ("blank", "duplicate"):
        return GONE
    return "sua".find(role[:1] or " ") % 4 + 4 * (wrong == "truncated")


class Facts(NamedTuple):
    """What is counted of consecutive turns; those of neighbours add up."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = ""
    last: str = ""
    low: int | None = None
    high: int | None = None
    numbers: int = 0

    @staticmethod
    def of(turns: list[tuple[str, str]], numbers: list[int | None], faults: list[str]) -> Facts:
        initials = [r[:1] for r, _ in turns]
        known = [n for n in numbers if n is not None]
        return Facts(len(turns), *(faults.count(k) for k in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     initials[0] if turns else "", initials[-1] if turns else "", min(known, default=None), max(known, default=None), len(set(known)))

    def __add__(self, other: Facts) -> Facts:
        """Of turns and those after them, by number."""
        if not self.rows or not other.rows:
            return self if self.rows else other
        between = self.last + other.first not in ("su", "ua", "au")
        low = other.low if self.low is None else self.low
        high = self.high if other.high is None else other.high
        same = self.high is not None and self.high == other.low
        return Facts(*(a + b for a, b in zip(self[:4], other[:4])), self.illegal + other.illegal + between, self.first, other.last, low, high, self.numbers + other.numbers - same)

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


FACTS = "rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, numbers long"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURN = pa.struct([("role", pa.string()), ("text", pa.string())])


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by crc32(`conv:turn`) % 20: 0 drops the row, 1 empties its text, 2 takes its full stops, question and
    exclamation marks, 3 repeats it, 4 sets the role user. Nulls count as one space, also in the checksum's text; a null
    turn stays null as a number. Dropped rows are returned too, as `live` = false, so that no conversation is lost."""

    def spaced(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spaced(text_col), ".!?", "")).otherwise(spaced(text_col))
    live = kind != 0
    return conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.when(live, F.when(kind == 4, F.lit("user")).otherwise(spaced(role_col))).alias("role"),
        F.when(live, text).alias("text"),
        live.alias("live"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )


class Repaired(NamedTuple):
    """`whole`: conversations that fit in one piece (conv_id, the counts, cost, audit, turns); `split`: the other ones
    (conv_id, counts, cost), whose audit and turns stand in `pieces` (conv_id, part, number, audit, turns), in this order."""

    whole: DataFrame
    split: DataFrame
    pieces: DataFrame


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, fan: int = FAN) -> Repaired:
    """Repair every conversation of `rows` (conv_id, turn: long, role, text, live, times; see `damaged`) at least cost.

    Rows are taken by turn, nulls first, and rows of one turn by role, then by text (by its first 64 characters and a hash).
    A row with `times` = 2 stands twice; one that is not `live` only keeps its conversation known. Conversations without
    rows have zeros and an empty audit; a null id is a conversation of its own, and an empty table gives no rows. A role
    whose initial is none of s, u and a, or that is empty, can't be kept. Extra columns are left out.

    Rows are sorted over range partitions by conversation and turn, once. A conversation inside a partition is repaired
    there; one that a partition's edge may cut, or that is longer than a piece, is put together from pieces: each piece
    says, for every state of what follows (`profiles`) and every state of what precedes, what it costs and where it
    leads; pieces are joined in a tree with `fan` children a node, which tells each its place on the way back. So no task
    holds a conversation, however long.
    """
    kind = dict(rows.dtypes)["conv_id"]
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text")]
    # Equal rows stand together but may lie in two partitions.
    dealt = rows.select("conv_id", "turn", "role", "text", "live", "times").repartitionByRange(shuffle_partitions(rows.sparkSession), *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    table = reread(dealt.mapInArrow(functools.partial(_by_conversation, most=piece_rows), f"conv_id {kind}, whole boolean, part int, number int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns array<struct<role: string, text: string>>, seen array<long>"))
    whole = table.where("whole").select("conv_id", *COUNTS, "audit", "turns")
    rest = table.where("not whole").select("conv_id", "part", "number", "turns", "seen")
    split, pieces = _joined(rest, kind, fan)
    return Repaired(whole, split, pieces)


def _by_conversation(batches: Iterator[pa.RecordBatch], most: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Sorted rows: conversations that lie inside the partition repaired, other ones in pieces."""
    part, number, first = TaskContext.get().partitionId(), 0, True
    conv, turns, seen, chars, pieces, started = None, [], [], 0, 0, False
    done: list[tuple] = []
    ids = None

    def close(more: bool) -> None:
        """End a piece; `more`: its conversation may have rows elsewhere."""
        nonlocal turns, seen, chars, number
        if more:
            done.append((conv, False, part, number, *[None] * 6, None, turns, seen))
        else:
            faults, had = [], set()
            for turn in turns:
                faults.append(fault(turn[1], turn in had))
                had.add(turn)
            codes = bytes(code_of(r, f) for (r, _), f in zip(turns, faults))
            words, bases = backward(codes)
            edits_, state = trace(codes, words, bases)
            cost = sum(bases) + layer(words[0], 0)
            new = rewritten(turns, edits_, 0, True)
            done.append((conv, True, part, number, *Facts.of(turns, seen, faults).counts(), cost, "".join(edits_) + last_edits(state), new, None))
        turns, seen, chars, number = [], [], 0, number + 1

    def sent() -> pa.RecordBatch:
        nonlocal done
        c = list(zip(*done))
        texts = [[{"role": r, "text": t} for r, t in x] for x in c[11]]
        kinds = [ids, pa.bool_(), pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.string()]
        columns = [pa.array(x, k) for x, k in zip(c[:11], kinds)] + [pa.array(texts, pa.list_(TURN)), pa.array(c[12], pa.list_(pa.int64()))]
        done = []
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "whole", "part", "number", *COUNTS, "audit", "turns", "seen"])

    for batch in batches:
        ids = batch.column(0).type
        held = 0
        for i, turn, role, text, live, times in zip(*(batch.column(c).to_pylist() for c in range(6))):
            if started and i != conv:
                close(first or pieces > 0)
                first, pieces = False, 0
            conv, started = i, True
            for _ in range(times if live else 0):
                if len(turns) == most or chars and chars + len(text) > PIECE_CHARS:
                    close(True)
                    pieces += 1
                turns.append((role, text))
                seen.append(turn)
                chars += len(text)
                held += len(text)
            if held > PIECE_CHARS and done:
                yield sent()
                held = 0
        if done:
            yield sent()
    if started:
        close(True)
        yield sent()


# --- conversations in pieces ---

WAYS = "ends array<int>, costs array<int>, states array<int>"


def _ways(codes: bytes) -> tuple[list[int], list[int], list[int]]:
    """For each profile after these rows: the profile before them, the cost between, and for each state before them the
    state after them."""
    number = {w: n for n, w in enumerate(profiles())}
    ends, costs, states = [], [], []
    for word in profiles():
        words, bases = backward(codes, word)
        ends.append(number[words[0]])
        costs.append(sum(bases))
        states += [trace(codes, words, bases, q)[1] for q in range(4)]
    return ends, costs, states


def _joined(rest: DataFrame, kind: str, fan: int) -> tuple[DataFrame, DataFrame]:
    """(split, pieces) of conversations in pieces, see `Repaired`."""
    turns = rest.select("conv_id", "part", "number", F.posexplode("turns").alias("at", "turn"))
    text = F.sha2(F.concat(F.octet_length("turn.role").cast("string"), F.lit(":"), "turn.role", "turn.text").cast("binary"), 256)
    earliest = turns.groupBy("conv_id", text.alias("said")).agg(F.min(F.struct("part", "number", "at")).alias("place"))
    fresh = earliest.groupBy("place.part", "place.number").agg(F.collect_list("place.at").alias("fresh"))  # within a piece
    rest = reread(rest.join(fresh, ["part", "number"], "left").select("conv_id", "part", "number", "turns", "seen", "fresh"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                new, pairs = set(r["fresh"] or ()), [(t["role"], t["text"]) for t in r["turns"]]
                faults = [fault(t, i not in new) for i, (_, t) in enumerate(pairs)]
                codes = bytes(code_of(role, f) for (role, _), f in zip(pairs, faults))
                row = [r["conv_id"], r["part"], r["number"], codes, *Facts.of(pairs, r["seen"], faults), *_ways(codes)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [batch.column(0).type, pa.int32(), pa.int32(), pa.binary(), *NODE])], ["conv_id", "part", "number", "codes", *NAMES])

    NODE = [*[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, *[pa.list_(pa.int32())] * 3]
    NAMES = [*Facts._fields, "ends", "costs", "states"]
    leaves = reread(rest.mapInArrow(summed, f"conv_id {kind}, part int, number int, codes binary, {FACTS}, {WAYS}"))

    def joined(key: tuple, group: pa.Table) -> pa.Table:
        """One node of neighbouring ones."""
        out = None
        for r in sorted(group.to_pylist(), key=lambda r: (r["part"], r["number"])):
            facts, ways = Facts(*(r[k] for k in Facts._fields)), (r["ends"], r["costs"], r["states"])
            if out is None:
                out = facts, ways
                continue
            facts, (ends, costs, states) = out[0] + facts, out[1]
            after = range(len(ends))
            mid = ways[0]
            out = facts, ([ends[mid[p]] for p in after], [costs[mid[p]] + ways[1][p] for p in after], [ways[2][4 * p + states[4 * mid[p] + q]] for p in after for q in range(4)])
        row = [key[0].as_py(), key[1].as_py(), 0, *out[0], *out[1]]
        return pa.table([pa.array([v], t) for v, t in zip(row, [group.column("conv_id").type, pa.int32(), pa.int32(), *NODE])], ["conv_id", "part", "number", *NAMES])

    def placed(key: tuple, group: pa.Table) -> pa.Table:
        """What comes after and before each child, from what comes after and before their parent."""
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["number"]))
        after, state, last = rows[0]["up_after"], rows[0]["up_state"], rows[0]["up_last"]
        for r in reversed(rows):
            r["after"], r["last"], after, last = after, last, r["ends"][after], False
        for r in rows:
            r["state"], state = state, r["states"][4 * r["after"] + state]
        kinds = {"conv_id": group.column("conv_id").type, "part": pa.int32(), "number": pa.int32(), "after": pa.int32(), "state": pa.int32(), "last": pa.bool_()}
        return pa.table([pa.array([r[n] for r in rows], k) for n, k in kinds.items()], list(kinds))

    top = rest.agg(F.max("part")).first()[0] or 0
    levels = [leaves.select("conv_id", "part", "number", *NAMES)]
    while True:  # nodes of one partition each, then of `fan` partitions, of fan * fan, until all partitions are in one
        levels[-1] = levels[-1].withColumn("under", F.col("part") if len(levels) == 1 else F.floor(F.col("part") / fan).cast("int"))
        levels.append(reread(levels[-1].groupBy("conv_id", "under").applyInArrow(joined, f"conv_id {kind}, part int, number int, {FACTS}, {WAYS}")))
        if top < fan ** (len(levels) - 2):
            break
    known = levels[-1].select("conv_id", "part", F.lit(0).alias("after"), F.lit(0).alias("state"), F.lit(True).alias("last"))
    for level in reversed(levels[:-1]):
        up = known.select(F.col("conv_id").alias("up_conv"), F.col("part").alias("up_part"), *(F.col(c).alias(f"up_{c}") for c in ("after", "state", "last")))
        met = level.join(up, (F.col("under") == F.col("up_part")) & F.col("conv_id").eqNullSafe(F.col("up_conv"))).drop("up_conv", "up_part")
        known = met.groupBy("conv_id", "under").applyInArrow(placed, f"conv_id {kind}, part int, number int, after int, state int, last boolean")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                words, bases = backward(r["codes"], profiles()[r["after"]])
                done, state = trace(r["codes"], words, bases, r["state"])
                new = rewritten([(t["role"], t["text"]) for t in r["turns"]], done, r["state"], r["last"])
                audit = "".join(done) + (last_edits(state) if r["last"] else "")
                row = [r["conv_id"], r["part"], r["number"], audit, [{"role": a, "text": b} for a, b in new]]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [batch.column(0).type, pa.int32(), pa.int32(), pa.string(), pa.list_(TURN)])], ["conv_id", "part", "number", "audit", "turns"])

    place = known.select("part", "number", "after", "state", "last")
    met = rest.select("conv_id", "part", "number", "turns").join(leaves.select("part", "number", "codes"), ["part", "number"]).join(place, ["part", "number"])
    pieces = met.select("conv_id", "part", "number", "turns", "codes", "after", "state", "last").mapInArrow(told, f"conv_id {kind}, part int, number int, audit string, turns array<struct<role: string, text: string>>")
    root = levels[-1]
    first = F.element_at(F.array(*[F.lit(layer(w, 0)) for w in profiles()]), F.col("ends")[0] + 1)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("numbers"), F.lit(0))
    split = root.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", (F.col("costs")[0] + first).cast("long").alias("cost"))
    return split, pieces


def lines(turns: Column) -> Column:
    """The turns as `role:text`, joined by newlines."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def sealed(pieces: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of conversations in pieces. A conversation's pieces pass through one task in their
    order, one at a time, as the digest demands; what is held is the digest's state and the audit."""
    kind = dict(pieces.dtypes)["conv_id"]
    sorted_ = pieces.select("conv_id", "part", "number", "audit", F.when(F.size("turns") > 0, lines(F.col("turns"))).alias("text")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")

    def seal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, digest, empty, ids = None, None, None, True, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], ids), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            ids = batch.column(0).type
            for at in range(batch.num_rows):
                i, done, text = (batch.column(c)[at].as_py() for c in (0, 3, 4))
                if audit is None or i != conv:
                    if audit is not None:
                        yield row()
                    conv, audit, digest, empty = i, [], hashlib.sha256(), True
                audit.append(done)
                if text is not None:
                    digest.update((b"" if empty else b"\n") + text.encode())
                    empty = False
        if audit is not None:
            yield row()

    return sorted_.mapInArrow(seal, f"conv_id {kind}, audit string, repaired_sha256 string")
