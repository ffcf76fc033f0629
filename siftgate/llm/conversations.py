"""Repair of conversations: the cheapest edits that make their roles take turns, found by auctions for shortest paths."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import stored, table

# Costs of the edits, and of leaving a truncated turn in.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
# What a row suffers that chance picks for damage.
DROP, EMPTY, UNPUNCTUATE, REPEAT, USURP = range(5)
DAMAGE = 20

# What the roles so far have come to, and what a turn of the role s, u or a makes of it.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# The one state that a turn given a role, or put in, leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Roles may end here: nothing at all, or after an assistant.
ENDS = (0, None, None, 0)

# Faults of a turn. A symbol is its role's initial (or none that counts) and its fault.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua?"
# Turns of a stretch of the lattice that one auction runs over, and stretches a task remembers.
BLOCK, REMEMBERED = 16, 1 << 16
# Rows of a batch that is handed on.
BATCH = 4096

Arc = tuple[int, int, str]


def symbol(initial: str, fault: int) -> int:
    return 4 * INITIALS.index(initial if initial in ("s", "u", "a") else "?") + fault


def lattice(symbols: bytes, exits: Sequence[int | None], closing: bool) -> list[list[Arc]]:
    """Arcs ``cost, head, edit`` of a stretch of turns, by node: place times four plus state; the sink comes last.

    ``exits`` are the costs from the states after the stretch to the end, ``None`` where there is no way. Turns
    can be put in after the last one only if the stretch is ``closing``: else the next stretch does that.
    """
    last = len(symbols)
    sink = 4 * (last + 1)
    arcs: list[list[Arc]] = []
    for place in range(last + 1):
        for state in range(4):
            out: list[Arc] = []
            if place < last:
                initial, fault = INITIALS[symbols[place] >> 2], symbols[place] & 3
                out.append((DELETE, 4 * (place + 1) + state, "D"))
                if fault not in (BLANK, DUPLICATE):
                    more = CUT_OFF if fault == TRUNCATED else 0
                    if initial in AFTER[state]:
                        out.append((KEEP + more, 4 * (place + 1) + AFTER[state][initial], "K"))
                    out.append((REROLE + more, 4 * (place + 1) + NEXT[state], "R"))
            elif exits[state] is not None:
                out.append((exits[state], sink, ""))
            if place < last or closing:
                out.append((INSERT, 4 * place + NEXT[state], "I"))
            arcs.append(out)
    return arcs


def auction(arcs: Sequence[Sequence[Arc]], origins: Sequence[int]) -> list[int]:
    """Prices after auctions from several origins to the last node: no arc is cheaper than its price difference.

    The end of the path looks for its cheapest arc, cost and price of the head together. If its own price is
    below that, the price rises and the path contracts by a node; else the path extends along the arc, until it
    is at the sink. An origin's price is then its distance. Prices stay good for the next origin.
    """
    sink = len(arcs)
    prices = [0] * (sink + 1)
    for origin in origins:
        path = [origin]
        while path[-1] != sink:
            node = path[-1]
            best, head = min((cost + prices[head], head) for cost, head, _ in arcs[node])
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
    return prices


def tight_edits(arcs: Sequence[Sequence[Arc]], prices: Sequence[int]) -> list[str | None]:
    """For each node the least edit among the tight arcs that lead on to the sink; ``None`` where none does.

    An arc is tight if its cost is the difference of the prices. All shortest paths consist of tight arcs, and
    all tight paths from an origin to the sink are shortest.
    """
    sink = len(arcs)
    into: list[list[int]] = [[] for _ in range(sink + 1)]
    for node, out in enumerate(arcs):
        for cost, head, _ in out:
            if prices[node] == cost + prices[head]:
                into[head].append(node)
    leads, reached = [sink], {sink}
    while leads:
        for node in into[leads.pop()]:
            if node not in reached:
                reached.add(node)
                leads.append(node)
    return [
        min((edit for cost, head, edit in out if head in reached and prices[node] == cost + prices[head]), default=None)
        for node, out in enumerate(arcs)
    ]


@functools.lru_cache(maxsize=REMEMBERED)
def _stretch(symbols: bytes, exits: tuple, closing: bool, origins: tuple[int, ...]) -> tuple[tuple[int, ...], bytes]:
    """Distances from the states before a stretch to the end, and the least tight edit of each node in it."""
    arcs = lattice(symbols, exits, closing)
    prices = auction(arcs, origins)
    edits = tight_edits(arcs, prices)
    if not closing:
        edits = edits[:-4]  # the next stretch has them
    return tuple(prices[:4]), bytes(ord(e) if e else 0 for e in edits)


def cheapest_edits(symbols: bytes) -> tuple[int, str]:
    """Cost and initials of the cheapest edits of a conversation, the ASCII-least of several.

    The lattice is cut into stretches, last one first. A stretch's prices are exact for all states before it, and
    are what the stretch before it has to pay at its end; so the work grows with the number of turns.
    """
    base, exits, closing = 0, ENDS, True
    tables: list[bytes] = []
    end = len(symbols)
    while True:
        start = max(0, end - BLOCK)
        least = min(e for e in exits if e is not None)
        relative = tuple(None if e is None else e - least for e in exits)
        base += least
        origins = (START,) if start == 0 else (START, SYSTEM, USER, ASSISTANT)
        exits, edits = _stretch(symbols[start:end], relative, closing, origins)
        tables.append(edits)
        closing, end = False, start
        if start == 0:
            break
    edits = b"".join(reversed(tables))
    audit = bytearray()
    place, state = 0, START
    while edit := edits[4 * place + state]:
        audit.append(edit)
        if edit == ord("K"):
            state = AFTER[state][INITIALS[symbols[place] >> 2]]
        elif edit != ord("D"):
            state = NEXT[state]
        place += edit != ord("I")
    return base + exits[START], audit.decode()


def damaged(conversations: DataFrame, conv_column="conv_id", turn_column="turn", role_column="role", text_column="text") -> DataFrame:
    """Rows after damage: ``conv_id, turn, role, text, copies``; a dropped row has no copies.

    Chance is the CRC-32 of ``conv_id:turn`` modulo 20. Nulls count as one space: in that text, as role, as text.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv_column).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_column).cast("string"), space))
    chance = F.crc32(name.cast("binary")) % DAMAGE
    text = F.coalesce(F.col(text_column), space)
    role = F.coalesce(F.col(role_column), space)
    return conversations.select(
        F.col(conv_column).cast("long").alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.when(chance == USURP, "user").otherwise(role).alias("role"),
        F.when(chance == EMPTY, "").when(chance == UNPUNCTUATE, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(chance == DROP, 0).when(chance == REPEAT, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(text: str) -> Column:
    return F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16)


def _turns(rows: DataFrame) -> DataFrame:
    """Equal turns as one row, without texts: order, initial, faults, and whether an earlier turn says the same."""
    trimmed = F.expr(r"rtrim('\t\n\u000B\f\r ', text)")
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.when(F.col("copies") > 0, _digest("text")).alias("digest"),
        F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault"),
        "copies",
    )
    # dropped turns only tell that there is such a conversation
    kept = F.col("copies") > 0
    narrow = narrow.withColumns({c: F.when(kept, F.col(c)) for c in ("turn", "role", "fault")})
    keys = ["conv_id", "role", "digest"]
    equal = narrow.groupBy(*keys, "turn", "fault").agg(F.sum("copies").alias("copies"))
    # a null turn comes before all others
    place = F.struct(F.col("turn").isNotNull(), "turn")
    seen = F.min(place).over(Window.partitionBy(*keys)) < place
    return equal.select("conv_id", "turn", "role", "digest", "fault", "copies", seen.alias("seen"))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
AUDIT_NAMES = [field.split()[0] for field in AUDIT.split(", ")]
LEGAL = ("su", "ua", "au")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for piece in range(0, batch.num_rows, BATCH):
            part = batch.slice(piece, BATCH)
            yield from zip(*[c.to_pylist() for c in part.columns])


def _audit(conv: int | None, turns: Iterator[tuple]) -> tuple:
    """One conversation's turns, in order, without their texts."""
    counts = [0, 0, 0, 0]
    symbols = bytearray()
    illegal = distinct = 0
    low = high = before = None
    for _, turn, role, _, fault, copies, seen in turns:
        if not copies:
            continue
        if turn is not None and turn != high:
            low, high, distinct = (turn if low is None else low), turn, distinct + 1
        initial = role[:1]
        for copy in range(copies):
            own = fault if fault == BLANK or not (seen or copy) else DUPLICATE
            counts[own] += 1
            illegal += before is not None and before + initial not in LEGAL
            before = initial
            symbols.append(symbol(initial, own))
    cost, audit = cheapest_edits(bytes(symbols))
    gaps = 0 if low is None else high - low + 1 - distinct
    return conv, gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost, audit


def _audit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in AUDIT_NAMES])
    groups = itertools.groupby(_rows(batches), key=lambda row: row[0])
    audits = (_audit(conv, turns) for conv, turns in groups)
    while found := list(itertools.islice(audits, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def audits(rows: DataFrame) -> DataFrame:
    """Faults, cost and edits of every conversation of ``damaged`` rows (or of any such rows, ``copies`` 1).

    Turns go by number, nulls first, equal numbers by role and then by a hash of the text; equal rows lie together.
    Texts stay where they are: what is sorted is a symbol and a hash per turn. A task streams its
    conversations, with a few bytes per turn of the one at hand.
    """
    turns = _turns(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return turns.mapInArrow(_audit_all, AUDIT)


REPAIRED = "conv_id long, place long, role string, text string"


def _repair(audit: str, turns: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    state = START
    edits = iter(audit)
    for _, role, text, copies in turns:
        for _ in range(copies):
            while (edit := next(edits)) == "I":
                state = NEXT[state]
                yield ROLES[state], ""
            if edit == "K":
                state = AFTER[state][role[:1]]
                yield role, text
            elif edit == "R":
                state = NEXT[state]
                yield ROLES[state], text
    for _ in edits:  # turns put in at the end
        state = NEXT[state]
        yield ROLES[state], ""


def _repair_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def repaired() -> Iterator[tuple]:
        for conv, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
            audit = next(rows)[1]
            for place, (role, text) in enumerate(_repair(audit, (r[1:] for r in rows))):
                yield conv, place, role, text

    turns = repaired()
    while found := list(itertools.islice(turns, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The turns after the edits: ``conv_id, place, role, text``, a conversation's in order and in one task.

    Every conversation's edits lie before its turns in the same sort, so a task streams both.
    """
    first = edits.select("conv_id", F.lit(0).alias("_kind"), "audit", *[F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"), ("copies", "long"))])
    turns = rows.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", _digest("text").alias("digest"), "text", "copies"
    )
    line = first.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "_kind", "turn", "role", "digest")
    return line.select("conv_id", "audit", "role", "text", "copies").mapInArrow(_repair_all, REPAIRED)


def _hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def hashed() -> Iterator[tuple]:
        for conv, turns in itertools.groupby(_rows(batches), key=lambda row: row[0]):
            digest = hashlib.sha256()
            for _, place, role, text in turns:
                digest.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())
            yield conv, digest.hexdigest()

    found = hashed()
    while some := list(itertools.islice(found, BATCH)):
        ids, digests = zip(*some)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests)], names=["conv_id", "repaired_sha256"])


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults after damage, the cheapest edits, the hash of what they make of it.

    Null conversation ids are one conversation, null turns come first; nulls elsewhere are one space. A conversation
    whose rows are all dropped has zeros, no edits and the hash of nothing; an empty table gives no rows;
    repeated rows are duplicates of each other; a role that begins with none of s, u, a is never kept; other
    columns are not looked at.
    """
    rows = damaged(conversations)
    summary = stored(audits(rows), "op13-audits")
    hashes = repaired(rows, summary).mapInArrow(_hash_all, "conv_id long, repaired_sha256 string")
    joined = summary.join(hashes.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return joined.select(*AUDIT_NAMES, F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))
