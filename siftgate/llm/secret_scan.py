"""Secrets in texts: fixed formats, and values in credential context that would take many guesses."""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.llm.common import table, whole

# The formats, kinds in the order in which equal starts are listed.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16
KINDS = ("assign", "access", "hex", "guess")

# What makes a context: a credential's name, a sign of assignment, a value in quotes or up to white space.
NAMES = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "login")
CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?|auth|login)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=]|\x20is\x20)[\x20\t]*"""
    r"""(?:"((?:[^"\\\n]|\\.)+)"|'((?:[^'\\\n]|\\.)+)'|["']?(\S+))""",
    re.ASCII,
)
# What the text around a value without quotes ends it with; brackets only if nothing in the value opens them.
AFTER, CLOSING = ".!?:,;\"'", {")": "(", "]": "[", "}": "{", ">": "<"}

# Rows of a keyboard, each a little to the right of the one above.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./"))
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])|"
                  r"(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d")  # fmt: skip

DICTIONARY = "word_bpe_49k.json"
# Guesses (powers of ten) from which a value counts as a secret, and its shortest length.
STRONG, SHORTEST = 10.0, 8
# Longest repeated unit and longest word that the segmentation knows.
UNIT, WORD_LENGTH = 32, 24


def dictionary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DICTIONARY)


@functools.cache
def ranked_words(path: str) -> dict[str, int]:
    """Whole words of a public vocabulary; the vocabulary lists frequent ones first."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = [(rank, word[:-4]) for word, rank in vocabulary.items() if word.endswith("</w>")]
    known = [word for _, word in sorted(words) if len(word) > 2 and word.isalpha()]
    return {word: rank for rank, word in enumerate(known, 1)}


@functools.cache
def neighbours() -> dict[str, set[str]]:
    """Keys next to each key."""
    at = {place: key for key, place in places().items()}
    around = ((0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0))
    return {key: {at[y + b, x + a] for b, a in around if (y + b, x + a) in at} for (y, x), key in at.items()}


def _key(char: str) -> str:
    return SHIFTED.get(char, char.lower())


@functools.cache
def places() -> dict[str, tuple[int, int]]:
    return {key: (y, x) for y, row in enumerate(KEYBOARD) for x, key in enumerate(row, start=int(y > 0))}


def _step(keys: list[str], k: int) -> tuple[int, int]:
    """Direction of the walk's step to key k."""
    (a, b), (c, d) = places()[keys[k - 1]], places()[keys[k]]
    return c - a, d - b


def _case_cost(word: str) -> float:
    if word.islower():
        return 0.0
    if word[1:].islower() or word.isupper():
        return math.log10(2)
    upper = sum(c.isupper() for c in word)
    return math.log10(sum(math.comb(len(word), i) for i in range(1, min(upper, len(word) - upper) + 1)) or 2)


def _alphabet(value: str) -> int:
    groups = ((26, str.islower), (26, str.isupper), (10, str.isdigit))
    size = sum(n for n, has in groups if any(map(has, value)))
    return max(2, size + (33 if not value.isalnum() else 0))


def guess_cost(value: str, words: dict[str, int]) -> float:
    """Power of ten of the guesses for the cheapest segmentation of a value.

    ``cost[j]`` is the least cost of the first j characters: over all segments that end there, the cost
    before the segment plus the segment's own. Words, dates and walks (4 to 32 keys) are tried at every
    place; repeats of a unit of up to 32 characters from where they start, as far as they go. Work and
    memory grow in proportion to the length.
    """
    n = len(value)
    each = math.log10(_alphabet(value))
    cost = [0.0] + [math.inf] * n
    low = value.lower()
    near = neighbours()
    keys = [_key(c) for c in value]
    same = {}  # unit length: end of the stretch in which each character repeats the one a unit before
    dates = {}
    for i in range(n):
        if value[i].isdigit() and (found := DATE.match(value, i)):
            dates[i] = found.end()
    for i in range(n):
        here = cost[i]

        def reach(end, more):
            if here + more < cost[end]:
                cost[end] = here + more

        reach(i + 1, each)  # brute force goes on character by character
        if low[i].isalpha():
            for j in range(i + 3, min(n, i + WORD_LENGTH) + 1):
                if rank := words.get(low[i:j]):
                    reach(j, math.log10(rank + 1) + _case_cost(value[i:j]))
        if end := dates.get(i):
            reach(end, math.log10(365 * 100) if end - i > 4 else 2.0)
        j = i + 1
        while j < n and j - i < UNIT and keys[j] in near.get(keys[j - 1], ()):
            j += 1
            if j - i >= 4:
                turns = sum(_step(keys, k) != _step(keys, k - 1) for k in range(i + 2, j))
                reach(j, math.log10(47 * (j - i)) + turns * math.log10(4))
        for unit in range(1, min(UNIT, (n - i) // 2) + 1):
            if value[i : i + unit] != value[i + unit : i + 2 * unit]:
                continue
            if same.get(unit, -1) >= i + 2 * unit and i and value[i - 1] == value[i - 1 + unit]:
                continue  # inside a run that was taken from its start
            j = i + 2 * unit
            while value[j : j + unit] == value[i : i + unit] and j + unit <= n:
                j += unit
            same[unit] = j
            times = (j - i) // unit
            if times > 2 or unit > 2:
                piece = value[i : i + unit]
                reach(j, guess_cost(piece, words) + math.log10(times))
    return cost[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the fixed formats, code points, in order."""
    spans = []
    low = text.lower()
    if any(name in low for name in ("passw", "secret", "token", "key")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _trimmed(text: str, start: int, end: int) -> int:
    """End of a value without the punctuation that belongs to the text around it."""
    excess = {c: text.count(c, start, end) - text.count(o, start, end) for c, o in CLOSING.items()}
    while end > start:
        last = text[end - 1]
        if last in CLOSING and excess[last] > 0:
            excess[last] -= 1
        elif last not in AFTER:
            break
        end -= 1
    return end


def guessed_spans(text: str, taken: list[tuple[int, int, int]], words: dict[str, int], strong: float) -> list[tuple[int, int, int]]:
    """Values in credential context that take many guesses and reach beyond the fixed formats."""
    low = text.lower()
    if not any(name in low for name in NAMES):
        return []
    spans = []
    for match in CONTEXT.finditer(text):
        start, end = match.span(match.lastindex)
        if match.lastindex == 3:
            end = _trimmed(text, start, end)
        if end - start < SHORTEST or any(a <= start and end <= b for a, _, b in taken):
            continue
        if guess_cost(text[start:end], words) >= strong:
            spans.append((start, 3, end))
    return spans


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", strong: float = STRONG, words_path: str | None = None
) -> DataFrame:
    """One row per document with the counts and places of its secrets; nothing is exchanged.

    A value in credential context counts (kind ``guess``) if the cheapest way to put it together
    from dictionary words, dates, repeats, keyboard walks and single characters takes ``10 ** strong``
    guesses. Whole texts are scanned. The dictionary is a public vocabulary of fixed size.

    Null and empty texts have no spans, equal starts are listed by kind, repeated rows are scanned each,
    an empty table gives no rows, and other columns are not looked at.
    """
    path = words_path or dictionary_path()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ranked_words(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                added = guessed_spans(text, spans, words, strong)
                for kind in range(3):
                    out[kind].append(sum(k == kind for _, k, _ in spans))
                out[3].append(hashlib.sha256(_listed(spans).encode()).hexdigest())
                out[4].append(_listed(sorted(spans + added)))
                out[5].append(len(added))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [batch.column(0).cast(pa.int64()), *[pa.array(v, k) for v, k in zip(out, kinds)]]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col(id_column).cast("long"), whole(text_column)).mapInArrow(scan, SCHEMA)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


SQL = None
