"""Conversation repair against a plain shortest path that carries whole audits."""

import hashlib
import itertools
import random
import re

import pytest

from fleetlake.llm import conversations

GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute_audit(symbols):
    """Least (cost, audit) from the left: states are prefixes of the grammar, every way is tried."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "")}

    def inserts(states):
        for _ in range(4):
            for q, (c, a) in list(states.items()):
                for role in "ua":
                    to = step.get((q, role))
                    if to is not None:
                        states[to] = min(states.get(to, (10**9, "")), (c + 2, a + "I"))
        return states

    for symbol in symbols:
        after = {}
        for q, (c, a) in inserts(best).items():
            ways = [(q, c + 3, a + "D")]
            if symbol != "x":
                extra = int(symbol.isupper())
                ways += [(step[q, r], c + 2 + extra, a + "R") for r in "ua" if (q, r) in step]
                if (q, symbol.lower()) in step:
                    ways.append((step[q, symbol.lower()], c + extra, a + "K"))
            for to, cost, audit in ways:
                after[to] = min(after.get(to, (10**9, "")), (cost, audit))
        best = after
    return min(v for q, v in inserts(best).items() if q in (0, 3))


def brute_report(rows):
    """``rows`` of one conversation: (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], hashlib.sha256(m[2].encode()).hexdigest()))
    seen, symbols, faults = set(), [], []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
        seen.add((role, text))
        faults.append(kind)
        initial = role[:1] if role[:1] in tuple("sua") else "o"
        symbols.append("x" if kind in "bd" else initial.upper() if kind == "t" else initial)
    cost, audit = brute_audit(symbols)
    out, i, state = [], 0, 0
    for letter in audit:
        role = "assistant" if state == 2 else "user"
        if letter == "D":
            i += 1
            continue
        message = ("", role) if letter == "I" else (rows[i][2], rows[i][1] if letter == "K" else role)
        i += letter != "I"
        out.append((message[1], message[0]))
        state = {"s": 1, "u": 2, "a": 3}[message[1][0]]
    assert GRAMMAR.fullmatch("".join(r[0] for r, _ in out))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(k) for k in "bdt"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def test_every_short_conversation_has_the_least_audit():
    for n in range(5):
        for symbols in itertools.product("xsuaoSUAO", repeat=n):
            assert conversations.solve("".join(symbols)) == brute_audit(symbols)


def test_long_runs_and_pieces_agree():
    rng = random.Random(3)
    for _ in range(60):
        symbols = "".join(rng.choice("xsuaoSUAO") * rng.choice((1, 1, 2, 7, 40)) for _ in range(rng.randint(1, 12)))
        cost, audit = conversations.solve(symbols)
        assert (cost, audit) == brute_audit(symbols)
        # The same in pieces, with the costs-to-go from their matrices.
        cuts = sorted(rng.sample(range(len(symbols) + 1), min(3, len(symbols))))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        after, ends = conversations.DONE, []
        for part in reversed(parts):
            ends.append(after)
            flat = conversations.transition(part)
            after = conversations._apply(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), after)
        assert after[0] == cost
        state, letters = 0, ""
        for part, end in zip(parts, reversed(ends)):
            more, state = conversations.unroll(part, state, end)
            letters += more
        assert letters + conversations.ending(state) == audit


def conversation(rng, n):
    texts = ["One.", "Two!", "three", "", " \t", "Four?", "cut off", "é…"]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = []
    for turn in range(n):
        turn = rng.choice((turn, turn, turn, turn + 3, None))
        rows.append((turn, rng.choice(roles), rng.choice([*texts, None, f"text {rng.random()}."])))
    return rows


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(11)
    convs = {i: conversation(rng, rng.randint(1, 9)) for i in range(60)}
    convs[None] = conversation(rng, 5)
    convs[7] = conversation(rng, 400)  # far more than a piece below
    convs[8] = [(1, "user", "same.")] * 150
    convs[9] = [(1, "user", "x" * 50_000 + "."), (2, "assistant", "y" * 50_000)]
    rows = [(i, *m, "k", 1, "f") for i, ms in convs.items() for m in ms]
    rng.shuffle(rows)
    schema = "conv_id long, turn long, role string, text string, first string, done int, _hash string"
    return convs, spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize("piece_rows", [conversations.PIECE_ROWS, 16])
def test_report_equals_brute_force(many, monkeypatch, piece_rows):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece_rows)
    convs, rows = many
    got = {r["conv_id"]: tuple(r[c] for c in (*conversations.COUNTS, "audit", "repaired_sha256")) for r in conversations.repair_report(rows).collect()}
    assert got == {i: brute_report(ms) for i, ms in convs.items()}


def test_messages_are_those_of_the_hash(many, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_ROWS", 16)
    convs, rows = many
    by_conv = {}
    for r in sorted(conversations.repaired_messages(rows).collect(), key=lambda r: tuple(r["place"])):
        by_conv.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for i, ms in convs.items():
        assert hashlib.sha256("\n".join(by_conv.get(i, [])).encode()).hexdigest() == brute_report(ms)[-1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_report(conversations.damaged(empty)).collect() == []
    assert conversations.repaired_messages(empty).collect() == []
