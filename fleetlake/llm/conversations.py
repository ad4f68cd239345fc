"""Conversation structure repair: the cheapest edits after which roles read ``(s?(ua)+)?``, by run-length DP.

A message is one of nine symbols: its role's initial (s, u, a or any other), truncated or not, or "must go"
(blank or repeated). What one message does to the four states of the grammar is a matrix of costs, (min, +) is
its product, and a run of equal symbols is a power, put together from cached binary powers. Costs-to-go at
the ends of runs come from the right; then the choices are unrolled from the left, always the letter that comes
first in ASCII among the cheapest (a letter and a state determine the next state, so this gives the least audit).

Messages are sorted with a range partitioning over (conversation, turn, role, text), so a conversation that holds
a large part of all rows is spread over many tasks, and read there in pieces of at most ``PIECE_ROWS`` messages.
A conversation that lies whole in one piece is finished on the spot. The others are put together from their
pieces: repeated messages by a group over digests, then a matrix per piece, costs-to-go at the ends of pieces (one
short row per piece is gathered per conversation, not its messages), choices for each of four entry states, the
state each piece is really entered in, and last the audit. Only the hash of a repaired conversation runs over its texts
in sequence, since SHA-256 does; it streams and holds one batch of pieces at a time.

Defined results: null roles and texts are one space, null turns come first, a null conversation is one of its own.
Messages of the same turn are ordered by role, then by the SHA-256 of their text; what is equal then is interchangeable.
An initial is a role's first code point. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import BLANKS, stage, table

PIECE_ROWS = 1024
PIECE_CHARS = 1_000_000
OUT_CHARS = 4_000_000  # texts held before rows are handed back

# The grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a. Ends in 0 or 3.
NEXT = (2, 2, 3, 2)  # state after an inserted or reroled message
ROLE = ("user", "user", "assistant", "user")  # and its role
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
LEGAL = {"su", "ua", "au"}
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
MUST_GO = "x"
NEVER = 1 << 50
DONE = (0, 4, 2, 0)  # cost of ending in each state: the inserts that are still missing

Costs = tuple[int, int, int, int]


# --- The dynamic programme


def _with_inserts(costs: list[int]) -> Costs:
    for _ in range(2):  # more than two inserts in a row lead back to a state that was cheaper before
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


@lru_cache(maxsize=100_000)
def before(symbol: str, after: Costs) -> Costs:
    """Cost-to-go in each state before a message, given those after it."""
    costs = []
    for q in range(4):
        best = DELETE + after[q]
        if symbol != MUST_GO:
            extra = TRUNCATED if symbol.isupper() else 0
            kept = KEEP[symbol.lower()][q]
            best = min(best, extra + REROLE + after[NEXT[q]], NEVER if kept is None else extra + after[kept])
        costs.append(best)
    return _with_inserts(costs)


def _apply(matrix: tuple[Costs, ...], after: Costs) -> Costs:
    return tuple(min(c + a for c, a in zip(row, after)) for row in matrix)


def _columns(columns: list[Costs]) -> tuple[Costs, ...]:
    return tuple(zip(*columns))


@lru_cache(maxsize=None)
def _power(symbol: str, bit: int) -> tuple[Costs, ...]:
    """The transition of ``2 ** bit`` equal messages; nine symbols and a few bits, so the cache is small."""
    if bit == 0:
        return _columns([before(symbol, tuple(0 if q == p else NEVER for q in range(4))) for p in range(4)])
    half = _power(symbol, bit - 1)
    return _columns([_apply(half, column) for column in zip(*half)])


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


def advance(symbol: str, times: int, after: Costs) -> Costs:
    """Costs-to-go before a run, through the binary powers of its symbol."""
    for bit in range(times.bit_length()):
        if times >> bit & 1:
            after = _apply(_power(symbol, bit), after)
    return after


def costs_before(symbols: str, after: Costs) -> Costs:
    for symbol, times in reversed(runs(symbols)):
        after = advance(symbol, times, after)
    return after


def transition(symbols: str) -> list[int]:
    """The matrix of a piece, row by row."""
    columns = [costs_before(symbols, tuple(0 if q == p else NEVER for q in range(4))) for p in range(4)]
    return [min(c, NEVER) for row in _columns(columns) for c in row]


@lru_cache(maxsize=100_000)
def _choose(symbol: str, state: int, after: Costs) -> tuple[str, int]:
    """The letters for one message (inserts first) and the state after it; ``after`` has 0 as its least cost."""
    here, letters = before(symbol, after), ""
    while True:
        if DELETE + after[state] == here[state]:
            return letters + "D", state
        if INSERT + here[NEXT[state]] == here[state]:
            letters, state = letters + "I", NEXT[state]
            continue
        kept = None if symbol == MUST_GO else KEEP[symbol.lower()][state]
        extra = TRUNCATED if symbol.isupper() else 0
        if kept is not None and extra + after[kept] == here[state]:
            return letters + "K", kept
        return letters + "R", NEXT[state]


def _relative(costs: Costs) -> Costs:
    """Costs less the least one: few such vectors exist, so the choices are remembered."""
    least = min(costs)
    return tuple(c - least for c in costs)


def unroll(symbols: str, state: int, after: Costs) -> tuple[str, int]:
    """The least audit of a piece entered in ``state``, and the state it leaves; ``after`` are the costs-to-go behind it."""
    behind, ends = runs(symbols), [after]
    for symbol, times in reversed(behind):
        ends.append(advance(symbol, times, ends[-1]))
    letters = []
    for (symbol, times), end in zip(behind, reversed(ends[:-1])):
        inside = [_relative(end)]
        for _ in range(times - 1):
            inside.append(_relative(before(symbol, inside[-1])))
        for costs in reversed(inside):
            chosen, state = _choose(symbol, state, costs)
            letters.append(chosen)
    return "".join(letters), state


def ending(state: int) -> str:
    """The inserts at the end of a conversation that is left in ``state``."""
    letters = ""
    while DONE[state]:
        letters, state = letters + "I", NEXT[state]
    return letters


@lru_cache(maxsize=50_000)
def _solve_short(symbols: str) -> tuple[int, str]:
    audit, state = unroll(symbols, 0, DONE)
    return costs_before(symbols, DONE)[0], audit + ending(state)


def solve(symbols: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation; short ones, of which many are alike, are remembered."""
    return _solve_short(symbols) if len(symbols) <= 32 else _solve_short.__wrapped__(symbols)


def messages_after(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that an audit leaves of a piece entered in ``state``."""
    new_roles, new_texts, i = [], [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            new_roles.append(roles[i])
            state = KEEP[role_class(roles[i])][state]
        else:
            new_roles.append(ROLE[state])
            state = NEXT[state]
        new_texts.append("" if letter == "I" else texts[i])
        i += letter != "I"
    return new_roles, new_texts


# --- Symbols


def role_class(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "o"


def fault(text: str) -> str:
    """``b`` for a blank text, ``t`` for one without closing punctuation, else ``-``; ``d`` is given to repeats."""
    end = text.rstrip(BLANKS)[-1:]
    return "b" if not end else "-" if end in ".!?" else "t"


def symbols_of(classes: str, faults: str) -> str:
    return "".join(MUST_GO if f in "bd" else c.upper() if f == "t" else c for c, f in zip(classes, faults))


def illegal_pairs(classes: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(classes, classes[1:]))


class Piece:
    """Consecutive messages of one conversation as they come from the sort."""

    def __init__(self, conv_id, first: int):
        self.conv_id, self.first = conv_id, first
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.keys: list[bytes] = []
        self.seen: set[bytes] = set()
        self.faults = self.classes = ""
        self.turns = self.chars = 0
        self.lo = self.hi = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
        found = fault(text)
        self.faults += "d" if found != "b" and key in self.seen else found
        self.classes += role_class(role)
        self.seen.add(key)
        self.keys.append(key)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if turn is not None and turn != self.hi:
            self.turns += 1
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn

    def full(self) -> bool:
        return len(self.roles) >= PIECE_ROWS or self.chars >= PIECE_CHARS

    def open_row(self) -> dict:
        columns = ("conv_id", "first", "roles", "texts", "keys", "classes", "faults", "turns", "lo", "hi")
        return {"done": False, **{c: getattr(self, c) for c in columns}}

    def done_row(self, with_messages: bool) -> dict:
        cost, audit = solve(symbols_of(self.classes, self.faults))
        roles, texts = messages_after(audit, 0, self.roles, self.texts)
        lines = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts))
        return {
            "done": True,
            "conv_id": self.conv_id,
            "first": self.first,
            "roles": roles if with_messages else None,
            "texts": texts if with_messages else None,
            "gaps": 0 if self.lo is None else self.hi - self.lo + 1 - self.turns,
            "blank": self.faults.count("b"),
            "duplicate": self.faults.count("d"),
            "truncated": self.faults.count("t"),
            "illegal": illegal_pairs(self.classes),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256(lines.encode("utf-8", "surrogatepass")).hexdigest(),
        }


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
OPEN = "classes string, faults string, keys array<binary>, turns long, lo long, hi long"
RESULT = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield from batch.slice(start, 512).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches bounded by their texts."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 200 + sum(map(len, row.get("texts") or ()))
        if chars >= OUT_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl_types: dict[str, pa.DataType], conv_type: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", conv_type), *ddl_types.items()])


LONGS, STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
PIECE_TYPES = {
    "done": pa.bool_(), "first": pa.int64(), "roles": STRINGS, "texts": STRINGS, "classes": pa.string(), "faults": pa.string(),
    "keys": pa.list_(pa.binary()), "turns": pa.int64(), "lo": pa.int64(), "hi": pa.int64(),
    **{c: pa.int64() for c in COUNTS}, "audit": pa.string(), "repaired_sha256": pa.string(),
}


def _map(df: DataFrame, rows_of, types: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """``mapInArrow`` with rows as dictionaries; the type of ``conv_id`` is that of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from _batches(rows_of(_rows(all_batches())), _arrow(types, first.schema.field("conv_id").type))

    return df.mapInArrow(run, f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {ddl}")


def _in_order(rows: DataFrame) -> DataFrame:
    """Messages sorted by conversation and turn over all partitions, with ``first`` as their running number."""
    space = F.lit(" ")
    named = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    # Equal messages are told apart by their number, so that even one message repeated very often is spread.
    keys = named.withColumns({"_hash": F.sha2("text", 256), "_tie": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "_hash", "_tie")]
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("first"))


def pieces(rows: DataFrame, with_messages: bool = False) -> DataFrame:
    """Finished conversations (``done``) and the pieces of all others, as a written table."""

    def read(found: Iterator[dict]) -> Iterator[dict]:
        piece, is_open = None, True  # the first conversation of a partition may have begun in the one before
        for row in found:
            if piece is None:
                piece = Piece(row["conv_id"], row["first"])
            elif row["conv_id"] != piece.conv_id:
                yield piece.open_row() if is_open else piece.done_row(with_messages)
                piece, is_open = Piece(row["conv_id"], row["first"]), False
            elif piece.full():
                yield piece.open_row()
                piece, is_open = Piece(row["conv_id"], row["first"]), True
            piece.add(row["turn"], row["role"], row["text"])
        if piece is not None:  # and the last one may go on in the next
            yield piece.open_row()

    ddl = f"done boolean, first long, roles array<string>, texts array<string>, {OPEN}, {RESULT}"
    return stage(_map(_in_order(rows), read, PIECE_TYPES, ddl), "conversation-pieces")


# --- Conversations in several pieces


def _with_copies(parts: DataFrame) -> DataFrame:
    """Pieces with the places of messages that an earlier piece, or they themselves, have already."""
    at = (F.col("first") + F.col("pos")).alias("at")
    places = parts.select("conv_id", "first", F.posexplode("keys").alias("pos", "key")).withColumn("at", at)
    originals = places.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at")
    # Places are unique, so this join has no hot key.
    copies = places.join(originals, "at", "left_anti").groupBy("first").agg(F.collect_list("pos").alias("copies"))
    return parts.select("conv_id", "first", "classes", "faults", "turns", "lo", "hi").join(copies, "first", "left")


def _summaries(parts: DataFrame) -> DataFrame:
    def summarise(found: Iterator[dict]) -> Iterator[dict]:
        for row in found:
            faults = list(row["faults"])
            for place in row["copies"] or ():
                if faults[place] != "b":
                    faults[place] = "d"
            classes, symbols = row["classes"], symbols_of(row["classes"], "".join(faults))
            yield {
                **{c: row[c] for c in ("conv_id", "first", "turns", "lo", "hi")},
                "blank": faults.count("b"),
                "duplicate": faults.count("d"),
                "truncated": faults.count("t"),
                "illegal": illegal_pairs(classes),
                "edges": classes[0] + classes[-1],
                "symbols": symbols,
                "matrix": transition(symbols),
            }

    numbers = ("first", "turns", "lo", "hi", "blank", "duplicate", "truncated", "illegal")
    types = {**{c: pa.int64() for c in numbers}, "edges": pa.string(), "symbols": pa.string(), "matrix": LONGS}
    ddl = ", ".join(f"{c} long" for c in numbers) + ", edges string, symbols string, matrix array<long>"
    return stage(_map(_with_copies(parts), summarise, types, ddl), "piece-summaries")


def _gathered(parts: DataFrame, *columns: str) -> DataFrame:
    """One row per conversation with its pieces' small columns in order."""
    return parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first", *columns))).alias("parts"))


def _costs_to_go(summaries: DataFrame) -> DataFrame:
    """``(conv_id, first, after, last)``: the costs-to-go behind each piece."""

    def scan(found: Iterator[dict]) -> Iterator[dict]:
        for row in found:
            after = DONE
            for part in reversed(row["parts"]):
                yield {"conv_id": row["conv_id"], "first": part["first"], "after": list(after), "last": part is row["parts"][-1]}
                flat = part["matrix"]
                after = _apply(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), after)

    types = {"first": pa.int64(), "after": LONGS, "last": pa.bool_()}
    return _map(_gathered(summaries, "matrix"), scan, types, "first long, after array<long>, last boolean").drop("conv_id")


def _choices(summaries: DataFrame) -> DataFrame:
    """For each piece and each of the four states it may be entered in: its audit, and the state it leaves."""

    def choose(found: Iterator[dict]) -> Iterator[dict]:
        for row in found:
            after = tuple(row["after"])
            ways = [unroll(row["symbols"], q, after) for q in range(4)]
            yield {
                "conv_id": row["conv_id"],
                "first": row["first"],
                "audits": [letters + (ending(state) if row["last"] else "") for letters, state in ways],
                "exits": [state for _, state in ways],
                "cost": costs_before(row["symbols"], after)[0],
            }

    types = {"first": pa.int64(), "audits": STRINGS, "exits": LONGS, "cost": pa.int64()}
    joined = summaries.select("conv_id", "first", "symbols").join(_costs_to_go(summaries), "first")
    return stage(_map(joined, choose, types, "first long, audits array<string>, exits array<long>, cost long"), "piece-choices")


COUNTED = ("turns", "lo", "hi", "blank", "duplicate", "truncated", "illegal", "edges")


def _entries(summaries: DataFrame, choices: DataFrame) -> DataFrame:
    """The state each piece is entered in; the counts of the conversation stand on its first piece."""

    def chain(found: Iterator[dict]) -> Iterator[dict]:
        for row in found:
            parts, state = row["parts"], 0
            total = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
            total["illegal"] += sum(a["edges"][1] + b["edges"][0] not in LEGAL for a, b in zip(parts, parts[1:]))
            timed = [p for p in parts if p["lo"] is not None]
            turns = total.pop("turns") - sum(a["hi"] == b["lo"] for a, b in zip(timed, timed[1:]))
            total["gaps"] = timed[-1]["hi"] - timed[0]["lo"] + 1 - turns if timed else 0
            total["cost"] = parts[0]["cost"]
            for i, part in enumerate(parts):
                yield {"conv_id": row["conv_id"], "first": part["first"], "entry": state, **(total if i == 0 else {})}
                state = part["exits"][state]

    types = {"first": pa.int64(), "entry": pa.int64(), **{c: pa.int64() for c in COUNTS}}
    both = summaries.select("conv_id", "first", *COUNTED).join(choices.select("first", "exits", "cost"), "first")
    gathered = _gathered(both, *COUNTED, "exits", "cost")
    return stage(_map(gathered, chain, types, "first long, entry long, " + ", ".join(f"{c} long" for c in COUNTS)), "piece-entries")


def _mended(parts: DataFrame, choices: DataFrame, entries: DataFrame) -> DataFrame:
    """``(conv_id, first, audit, roles, texts)``: every piece after its repair."""

    def mend(found: Iterator[dict]) -> Iterator[dict]:
        for row in found:
            roles, texts = messages_after(row["audit"], row["entry"], row["roles"], row["texts"])
            yield {**{c: row[c] for c in ("conv_id", "first", "audit")}, "roles": roles, "texts": texts}

    audit = F.element_at("audits", (F.col("entry") + 1).cast("int")).alias("audit")
    told = choices.join(entries.select("first", "entry"), "first").select("first", "entry", audit)
    joined = parts.select("conv_id", "first", "roles", "texts").join(told, "first")
    types = {"first": pa.int64(), "audit": pa.string(), "roles": STRINGS, "texts": STRINGS}
    return _map(joined, mend, types, "first long, audit string, roles array<string>, texts array<string>")


def _hashed(mended: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)``, streaming over the pieces of each conversation in order."""

    def run(found: Iterator[dict]) -> Iterator[dict]:
        for conv_id, parts in groupby(found, key=lambda row: row["conv_id"]):
            digest, audit, started = hashlib.sha256(), [], False
            for part in parts:
                audit.append(part["audit"])
                for role, text in zip(part["roles"], part["texts"]):
                    digest.update((("\n" if started else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    started = True
            yield {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    ordered = mended.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return _map(ordered, run, {"audit": pa.string(), "repaired_sha256": pa.string()}, "audit string, repaired_sha256 string")


# --- The operator


def _split(rows: DataFrame, with_messages: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Finished conversations, and the pieces of the others with their choices and entries."""
    found = pieces(rows, with_messages)
    parts = found.filter("not done")
    summaries = _summaries(parts)
    choices = _choices(summaries)
    return found.filter("done"), parts, choices, _entries(summaries, choices)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``(conv_id, turn, role, text)``: faults, cost, audit, hash of the repaired text."""
    done, parts, choices, entries = _split(rows, False)
    totals = entries.filter("cost is not null").select("conv_id", *COUNTS)
    hashed = _hashed(_mended(parts, choices, entries)).withColumnRenamed("conv_id", "_conv")
    several = totals.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return done.select("conv_id", *COUNTS, "audit", "repaired_sha256").unionByName(several)


def repaired_messages(rows: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the messages after the repair; ``place`` orders them within a conversation."""
    done, parts, choices, entries = _split(rows, True)
    columns = ["conv_id", "first", "roles", "texts"]
    both = done.select(*columns).unionByName(_mended(parts, choices, entries).select(*columns))
    message = F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "m")
    # Pieces of one conversation have growing numbers; a piece has fewer than 2 ^ 16 messages after its repair.
    place = F.struct("first", "pos").alias("place")
    return both.select("conv_id", "first", message).select("conv_id", place, F.col("m.roles").alias("role"), F.col("m.texts").alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with seeded damage by CRC-32 of conversation and turn: see the numbers below."""
    space = F.lit(" ")
    clean = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    name = F.concat(*[F.coalesce(p, space) for p in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("_kind")

    def on(number: int, value: Column, other: str) -> Column:
        return F.when(F.col("_kind") == number, value).otherwise(F.col(other))

    kept = clean.withColumn("_kind", kind).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").otherwise(on(2, F.translate("text", ".!?", ""), "text"))
    changed = kept.withColumns({"text": text, "role": on(4, F.lit("user"), "role")})
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return changed.withColumn("_copy", copies).select("conv_id", "turn", "role", "text")


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    report = repair_report(damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct()
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS}
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        *[zeros[c] for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same results by another way: from the left, every state carries its least cost with the audit and the repaired
# lines so far, as a struct that sorts by cost and then by audit.
_CRC = """
shifted(i, step, c) as (
  select i, 0, i from range(256) r(i)
  union all
  select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from shifted where step < 8),
crc_table as (select list(c order by i) as tab from shifted where step = 8)"""


def _state(cost: str, letter: str, old: str, line: str | None) -> str:
    """SQL for state ``old`` after an edit; a state is null where it cannot be reached."""
    add = "''" if line is None else f"case when {old}.o = '' then '' else chr(10) end || {line}"
    return f"case when {old} is null then null else {{'c': {old}.c + {cost}, 'a': {old}.a || '{letter}', 'o': {old}.o || {add}}} end"


def _least(*states: str) -> str:
    return f"list_sort(list_filter([{', '.join(states)}], lambda s: s is not null))[1]"


def _inserted(q0: str, q1: str, q2: str, q3: str) -> list[str]:
    """SQL for the four states after at most one insert each."""
    user = [_state("2", "I", q, "'user:'") for q in (q0, q1, q3)]
    return [q0, q1, _least(q2, *user), _least(q3, _state("2", "I", q2, "'assistant:'"))]


def op13_sql() -> str:
    names = ["q0", "q1", "q2", "q3"]

    def level(name: str, columns: list[str], source: str, rest: str) -> str:
        return f"{name} as (select {rest}{', '.join(f'{c} as {n}' for c, n in zip(columns, names))} from {source})"

    edit = "truncated"
    line = "role || ':' || text"

    def kept(initial: str, *states: str) -> list[str]:
        return [f"case when initial = '{initial}' and not must_go then {_state(edit, 'K', q, line)} end" for q in states]

    def reroled(role: str, *states: str) -> list[str]:
        return [f"case when not must_go then {_state(f'2 + {edit}', 'R', q, f"'{role}:' || text")} end" for q in states]

    def deleted(q: str) -> str:
        return _state("3", "D", q, None)

    step = [
        _least(deleted("q0")),
        _least(deleted("q1"), *kept("s", "q0")),
        _least(deleted("q2"), *kept("u", "q0", "q1", "q3"), *reroled("user", "q0", "q1", "q3")),
        _least(deleted("q3"), *kept("a", "q2"), *reroled("assistant", "q2")),
    ]
    once = _inserted(*names)
    row = "conv, n, rn, "
    message = "conv, n, rn, initial, must_go, truncated, role, text, "
    empty = "{'c': 0, 'a': '', 'o': ''}"
    none = "cast(null as struct(c bigint, a varchar, o varchar))"
    return f"""
with recursive {_CRC},
clean as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as hx
  from conversations),
hashed as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hx) // 2), lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::bigint)),
                            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind
  from clean, crc_table),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when kind = 3 then [1, 2] else [1] end) as copy
  from hashed where kind <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as rn,
         count(*) over (partition by conv_id) as n, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
         case when role[1] in ('s', 'u', 'a') then role[1] else 'o' end as initial
  from damaged),
faulty as (
  select *, body = '' as blank,
         body <> '' and row_number() over (partition by conv_id, role, text order by rn) > 1 as copied,
         lag(initial) over (partition by conv_id order by rn) || initial as pair
  from numbered),
messages as (
  select *, blank or copied as must_go, not (blank or copied) and body[-1] not in ('.', '!', '?') as cut from faulty),
typed as (
  select coalesce(cast(conv_id as varchar), 'none') as conv, n, rn, initial, must_go, cast(cut as int) as truncated, role, text from messages),
walk as (
  select distinct conv, n, 0::bigint as rn, {empty} as q0, {none} as q1, {none} as q2, {none} as q3 from typed
  union all
  select conv, n, rn, {', '.join(f'{c} as {n}' for c, n in zip(step, names))}
  from (select {message}{', '.join(f'{c} as {n}' for c, n in zip(once, names))}
        from (select {message}{', '.join(f'{c} as {n}' for c, n in zip(once, names))}
              from (select t.conv, t.n, t.rn, t.initial, t.must_go, t.truncated, t.role, t.text, q0, q1, q2, q3
                    from walk w join typed t on t.conv = w.conv and t.rn = w.rn + 1)))),
{level('once', once, 'walk where rn = n', row)},
{level('twice', once, 'once', row)},
ends as (select conv, {_least('q0', 'q3')} as e from twice),
counts as (
  select coalesce(cast(conv_id as varchar), 'none') as conv,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum(cast(blank as int))::bigint as blank,
         sum(cast(copied as int))::bigint as duplicate, sum(cast(cut as int))::bigint as truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from messages group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(e.c, 0) as cost, coalesce(e.a, '') as audit,
       sha256(coalesce(e.o, '')) as repaired_sha256
from (select distinct conv_id, coalesce(cast(conv_id as varchar), 'none') as conv from conversations) c
left join counts using (conv) left join ends using (conv)
"""


OP13_SQL = op13_sql()
