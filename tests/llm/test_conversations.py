"""Repair of conversations against a plain version that keeps the least edits of every state."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from siftgate.llm import common, conversations

SF_DIR = "/root/testdata/sf0.001"
AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def least_edits(turns):
    """``(cost, edits)`` of turns given as (initial, must go, cut off): every edit of every state, none left out."""
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(4):
            for state, (cost, edits) in list(best.items()):
                way = (cost + 5, edits + "I")
                best[NEXT[state]] = min(best.get(NEXT[state], way), way)
        return best

    for initial, must_go, cut_off in turns:
        after = {}
        for state, (cost, edits) in inserted(best).items():
            ways = [(state, cost + 2, "D")]
            if not must_go:
                ways.append((NEXT[state], cost + 1 + 5 * cut_off, "R"))
                if initial in AFTER[state]:
                    ways.append((AFTER[state][initial], cost + 5 * cut_off, "K"))
            for to, total, edit in ways:
                way = (total, edits + edit)
                after[to] = min(after.get(to, way), way)
        best = after
    inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


def plain(rows):
    """The whole contract, row by row."""
    by_conv = {}
    for conv, turn, role, text in rows:
        lines = by_conv.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        chance = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if chance == 1:
            text = ""
        if chance == 2:
            text = re.sub("[.!?]", "", text)
        if chance == 4:
            role = "user"
        lines += [(turn, role, text)] * (0 if chance == 0 else 2 if chance == 3 else 1)
    out = []
    for conv, lines in by_conv.items():
        digest = lambda text: hashlib.sha256(text.encode()).digest()[:16]
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
        known = [t for t, _, _ in lines if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, faults = set(), []
        for _, role, text in lines:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "sound" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(lines))
        cost, edits = least_edits([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(lines, faults)])
        state, left, done = 0, iter(lines), []
        for edit in edits:
            _, role, text = (None, None, "") if edit == "I" else next(left)
            if edit == "D":
                continue
            state = AFTER[state][role[:1]] if edit == "K" else NEXT[state]
            done.append(f"{role if edit == 'K' else {2: 'user', 3: 'assistant'}[state]}:{text}")
        hashed = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, edits, hashed))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


FIELDS = [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
CLASHING = [T.StructField(c, T.StringType()) for c in ("digest", "copies", "seen", "_kind", "audit", "place", "_conv", "fault")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["own"] * len(CLASHING)) for r in rows], T.StructType([*FIELDS, *CLASHING]))


def test_auction_finds_the_least_of_the_cheapest_edits():
    chance = random.Random(5)
    for n in [*range(9)] * 40 + [15, 16, 17, 31, 32, 33, 50] * 12:
        turns = [(chance.choice(["s", "u", "a", "u", "a", "t", ""]), chance.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        symbols = bytes(conversations.symbol(i, f) for i, f in turns)
        want = least_edits([(i, f in (1, 2), f == 3) for i, f in turns])
        assert conversations.cheapest_edits(symbols) == want, turns


def test_short_conversations_against_all_edit_strings():
    """Every string of edits, tried one by one."""
    legal = re.compile(r"(s?(ua)+)?")
    for turns in itertools.product([("u", 0), ("a", 0), ("s", 0), ("a", 3), ("u", 2)], repeat=3):
        best = None
        for length in range(7):
            for edits in itertools.product("DIKR", repeat=length):
                if length - edits.count("I") != 3:
                    continue
                for parts in itertools.product("ua", repeat=edits.count("I") + edits.count("R")):
                    given, rows, cost, roles = iter(parts), iter(turns), 0, ""
                    for edit in edits:
                        initial, fault = (None, 0) if edit == "I" else next(rows)
                        if edit != "D" and fault == 2:
                            break
                        cost += {"D": 2, "I": 5, "K": 0, "R": 1}[edit] + 5 * (fault == 3 and edit != "D")
                        roles += "" if edit == "D" else initial if edit == "K" else next(given)
                    else:
                        if legal.fullmatch(roles) and (best is None or (cost, "".join(edits)) < best):
                            best = (cost, "".join(edits))
        assert conversations.cheapest_edits(bytes(conversations.symbol(*t) for t in turns)) == best, turns


def test_prices_are_dual():
    """No arc is cheaper than the difference of its ends' prices, and an origin's price is its distance."""
    symbols = bytes(conversations.symbol(i, f) for i, f in [("a", 0), ("u", 3), ("u", 0), ("t", 0), ("a", 1), ("a", 0)])
    arcs = conversations.lattice(symbols, conversations.ENDS, True)
    prices = conversations.auction(arcs, (0,))
    assert all(prices[node] <= cost + prices[head] for node, out in enumerate(arcs) for cost, head, _ in out)
    assert prices[0] == conversations.cheapest_edits(symbols)[0]


def odd_rows():
    chance = random.Random(3)
    rows = [
        (conv, turn, chance.choice(["user", "assistant", "assistant", "system", "tool", "", None]), chance.choice(["Yes.", "No!", "well", " ", "", None, "a.b? c \n"]))
        for conv in [*range(60), None]
        for turn in [None, *range(chance.randrange(9)), None, 3, 3]
    ]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(700)]
    rows += [(101, 5, "user", "Same.")] * 300
    rows += [(102, -(1 << 40), "user", "word " * 40_000 + "end."), (102, 1 << 40, "assistant", "Ünï.")]
    # all rows of this one are dropped
    rows += [(c, 1, "user", "Gone.") for c in range(200, 400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0][:3]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    assert got(conversations.repair_conversations(frame(spark, rows).repartition(5))) == plain(rows)


def test_empty_table(spark):
    assert conversations.repair_conversations(frame(spark, [])).count() == 0


def test_repaired_turns(spark):
    rows = conversations.damaged(frame(spark, odd_rows()))
    edits = conversations.audits(rows)
    for conv, turns in itertools.groupby(conversations.repaired(rows, edits).collect(), key=lambda r: r.conv_id):
        turns = list(turns)
        assert [t.place for t in turns] == list(range(len(turns)))
        assert re.fullmatch("s?(ua)+", "".join(t.role[:1] for t in turns)), conv


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_table(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(conversations.op13_conversations(spark, sf_dir)) == plain(rows)
