"""Toxicity: disguised spellings are decoded as a noisy channel, then the restored words are scored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.llm.common import as_row, stored, table, whole
from siftgate.llm.packed import portions

REJECT = 0.7
# Most labelled rows that the weights of words are fitted on; the character model is of all texts.
FIT_ROWS = 20_000
# Word beginnings that count as features of their own, and the least documents of a feature.
STEMS, SUPPORT = range(3, 7), 3
# Normal quantile of the lower bound on a feature's share of toxic documents.
CONFIDENCE = 1.5
# Words of a shingle, and hashes by which near copies among fitted rows are found.
SHINGLE, MARKS = 3, 4

# Characters that stand in for letters.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
SEPARATORS = " ._*-"
# Channel costs (natural logarithms): a stand-in, a separator put in, a letter said once more.
STAND_IN, PUT_IN, AGAIN = 2.0, 0.7, 1.2

# Classes of the character model: 0 for all that parts words, then letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
OTHER, CLASSES = 62, 64
PARTS = re.compile(r"\W+|_+")
# What may be read as a letter; single ones with one to three separators in between are spelled out.
SYMBOLS = "".join(c for c in STANDS_FOR if not c.isalnum())
_ONE = rf"(?:[^\W_]|[{re.escape(SYMBOLS)}])"
SPELLED = re.compile(rf"(?<![^\W_]){_ONE}(?:[\s._*-]{{1,3}}{_ONE}){{2,}}(?![^\W_])")
AGAIN_SAID = re.compile(r"([^\W\d_])\1")
# A separator between what may be read as letters.
PARTED = re.compile(rf"{_ONE}[{re.escape(SEPARATORS)}]+{_ONE}")
LETTER = re.compile(rf"[^\W\d_]|[{re.escape(SYMBOLS)}]")
STANDING = re.compile(f"[{re.escape(''.join(STANDS_FOR))}]")
OUTSIDE = re.compile(rf"^(?:_|[^\w{re.escape(SYMBOLS)}])+|(?:_|[^\w{re.escape(SYMBOLS)}])+$")
PLAIN = re.compile(r"^[\W_]+|[\W_]+$")
# Tokens whose weight a task remembers, and characters whose runs are counted together.
REMEMBERED, PORTION = 400_000, 1 << 20


def _class_table() -> np.ndarray:
    """Class of every code point."""
    found = np.zeros(0x110000, np.uint8)
    for code in range(0x250):
        char = chr(code).lower()
        if char.isalpha():
            found[code] = LETTERS.find(char) + 1 if len(char) == 1 and char in LETTERS else OTHER
    found[0x250:] = OTHER
    found[0x2000:0x2070] = 0
    return found


def _char_class(char: str) -> int:
    place = LETTERS.find(char)
    return place + 1 if place >= 0 else OTHER if char.isalpha() else 0


def character_counts(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts of all runs of three character classes in all texts: a table of fixed size, ``64 ** 3``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _class_table()
        sums = np.zeros(CLASSES**3, np.int64)
        for batch in portions(batches, 0, PORTION):
            # texts are parted by the two blanks that every text begins with
            joined = "  " + "  ".join(batch.column(0).to_pylist())
            for at in range(0, len(joined), PORTION):
                piece = joined[max(0, at - 2) : at + PORTION]
                codes = classes[np.frombuffer(piece.encode("utf-32-le"), "<u4")].astype(np.int64)
                runs = (codes[:-2] << 12) | (codes[1:-1] << 6) | codes[2:]
                sums += np.bincount(runs[(codes[1:-1] != 0) | (codes[2:] != 0)], minlength=CLASSES**3)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["run", "n"])

    counted = docs.select(whole(text_column)).mapInArrow(count, "run long, n long")
    counts = np.zeros(CLASSES**3)
    for run, n in counted.groupBy("run").agg(F.sum("n").alias("n")).collect():  # at most 64 ** 3 rows
        counts[run] = n
    return counts


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a class after two others: three orders mixed."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.5) / (one + 0.5).sum()
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


def decode(spelled: str, model: np.ndarray) -> str:
    """The likeliest intended spelling.

    The lattice has, for each character, itself, the letters it may stand for, nothing if it is a
    separator, and nothing if it says the letter before once more. A state is the last two intended
    characters; Viterbi keeps the cheapest way into each, model and channel costs added.
    """
    states: dict[tuple[str, str], tuple[float, tuple | None]] = {(" ", " "): (0.0, None)}
    for char in [*spelled.lower(), " "]:
        following: dict[tuple[str, str], tuple[float, tuple | None]] = {}

        def reach(state, cost, way):
            if state not in following or cost < following[state][0]:
                following[state] = (cost, way)

        meant = [(char, 0.0)] + [(letter, STAND_IN) for letter in STANDS_FOR.get(char, "")]
        for (first, second), (cost, way) in states.items():
            for letter, more in meant:
                if letter == second and letter.isalpha():
                    reach((first, second), cost + more + AGAIN, way)
                step = model[_char_class(first), _char_class(second), _char_class(letter)]
                reach((second, letter), cost + more - step, (letter, way))
            if char in SEPARATORS:
                reach((first, second), cost + PUT_IN, way)
        states = following
    way = min(states.values(), key=lambda s: s[0])[1]
    letters = []
    while way is not None:
        letters.append(way[0])
        way = way[1]
    return "".join(reversed(letters)).strip()


def _disguised(token: str) -> bool:
    """A stand-in, a letter said once more or a separator inside; numbers are not."""
    if token.isalpha():
        return AGAIN_SAID.search(token) is not None
    if LETTER.search(token) is None:
        return False
    return any(p.search(token) is not None for p in (STANDING, AGAIN_SAID, PARTED))


def _readings(token: str) -> set[str]:
    """A token without the punctuation around it, with and without stand-ins among that."""
    return {OUTSIDE.sub("", token), PLAIN.sub("", token)}


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word] + ["^" + word[:n] for n in STEMS if n <= len(word)]


def _marks(text: str) -> list[int]:
    """Least hashes of the text's word shingles, one for each of several mixes: near copies share most."""
    words = text.split()
    last = max(1, len(words) - SHINGLE + 1)
    hashed = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + SHINGLE])) for i in range(last)], np.uint64)
    mixed = [hashed * np.uint64(0x9E3779B97F4A7C15 + 2 * i) for i in range(MARKS)]
    return [int((m ^ (m >> np.uint64(31))).min() >> np.uint64(1)) for m in mixed]


def token_words(token: str, model: np.ndarray) -> list[str]:
    """Plain words of a token, restored ones included."""
    words = [w for w in PARTS.split(token) if w]
    if not token.isalnum():
        words += spelled_words(token, model)
    for reading in _readings(token):
        if _disguised(reading):
            words += [w for w in PARTS.split(decode(reading, model)) if w]
    return words


def spelled_words(text: str, model: np.ndarray) -> list[str]:
    """Words spelled out character by character, with blanks or other separators in between."""
    spelled = (" ".join(m.group().split()) for m in SPELLED.finditer(text))
    return [w for s in spelled for w in PARTS.split(decode(s, model)) if len(w) > 2]


def _crc(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3


def lower_bound(toxic: Column, total: Column) -> Column:
    """Lower end of the Wilson interval of a share."""
    share, z2 = toxic / total, CONFIDENCE**2
    spread = F.sqrt(share * (1 - share) / total + F.lit(z2) / (4 * total * total))
    return (share + F.lit(z2) / (2 * total) - CONFIDENCE * spread) / (1 + F.lit(z2) / total)


def _different(sample: DataFrame) -> DataFrame:
    """One of each family of near copies: rows ``_toxic, _words`` by turns unique in each of several least shingle hashes."""
    for mark in range(MARKS):
        first = sample.groupBy(F.col("_marks")[mark]).agg(F.min(F.struct("_hash", "_toxic", "_words", "_marks")).alias("_s"))
        sample = first.select("_s.*")
    return sample


def fit_weights(docs: DataFrame, labels: DataFrame, model, id_column: str, text_column: str, fit_rows: int) -> dict[str, float]:
    """Features that mark toxic documents, with the lower bound of a share times the squared share.

    A word's share is that of toxic documents among fitted documents with the word. A beginning's is the mean
    share of the different words that begin so: what matters is whether a word not seen yet would mark
    toxic documents too. Fitted on at most ``fit_rows`` labelled rows outside the held-out third, chosen by
    a hash of the id; near copies among them are one piece of evidence. Features count whose bound is above the
    toxic share of all fitted rows: without clean rows none does.
    """
    usable = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (_crc("doc_id") != 1))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    chosen = chosen.select(F.col("doc_id").alias("_chosen"), F.col("toxic").alias("_toxic"))
    # at most fit_rows rows
    texts = docs.select(F.col(id_column).alias("_doc"), whole(text_column).alias("_text"))
    sample = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_chosen"))
    sample = sample.select((F.col("_toxic") == 1).cast("int").alias("_toxic"), "_text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, marks = [], []
            for text in batch.column(1).to_pylist():
                found = set(spelled_words(text, model.value))
                for token in set(text.lower().split()):
                    found.update(token_words(token, model.value))
                words.append(sorted(found))
                marks.append(_marks(text))
            hashes = [zlib.crc32(text.encode()) for text in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(hashes, pa.int64()), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks, pa.list_(pa.int64()))], names=["_toxic", "_hash", "_words", "_marks"])

    sample = sample.mapInArrow(read, "_toxic int, _hash long, _words array<string>, _marks array<long>")
    sample = stored(_different(stored(sample, "op6-read")), "op6-fit")
    words = sample.select("_toxic", F.explode("_words").alias("feature")).groupBy("feature")
    words = stored(words.agg(F.sum("_toxic").alias("hits"), F.count("*").alias("total")), "op6-words")
    share = F.col("hits") / F.col("total")
    begin = F.explode(F.array(*[F.when(F.length("feature") >= n, F.concat(F.lit("^"), F.substring("feature", 1, n))) for n in STEMS]))
    stems = words.select(begin.alias("feature"), share.alias("share")).filter("feature IS NOT NULL").groupBy("feature")
    stems = stems.agg(F.sum("share").alias("hits"), F.count("*").alias("total"))
    every = sample.agg(F.count("*"), F.sum("_toxic")).first()
    base = (every[1] or 0) / max(1, every[0])
    # above the share of all rows for certain, which some feature can be whatever that share is
    least = lower_bound(F.col("hits").cast("double"), F.col("total").cast("double"))
    marked = words.union(stems).filter((F.col("hits") >= SUPPORT) & (least > base))
    # the square of the share tells mixed features from rare ones
    marked = marked.select("feature", (least * share**2).alias("weight"))
    # bounded by the sample: a feature needs several of its documents or words
    return {r["feature"]: r["weight"] for r in marked.collect()}


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    carry: Sequence[Column],
    id_column: str = "doc_id",
    text_column: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The carried columns of every document, in their order, and its ``score``.

    A document scores as its most telling word or beginning of a word does (``fit_weights``). Tokens in disguise are read both ways, as they stand
    and as decoded. Two passes over all texts, none of them exchanged.

    Null and empty texts score 0, repeated rows are scored each (copies of a text alike), labels that are
    null or missing are not fitted, of labels that contradict each other the toxic one counts, an
    empty table gives no rows, without labels every score is 0, and other columns are not looked at.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(character_model(character_counts(docs, text_column)))
    weights = spark.sparkContext.broadcast(fit_weights(docs, labels, model, id_column, text_column, fit_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tables = weights.value, model.value
        remembered: dict[str, float] = {}

        def weigh(words: list[str]) -> float:
            return max((known.get(f, 0.0) for w in words for f in features(w)), default=0.0)

        for batch in batches:
            scores = []
            for text in batch.column(0).to_pylist():
                best = 0.0
                for token in set(text.lower().split()):
                    weight = remembered.get(token)
                    if weight is None:
                        weight = remembered[token] = weigh(token_words(token, tables))
                    if weight > best:
                        best = weight
                if len(remembered) > REMEMBERED:
                    remembered.clear()
                scores.append(max(best, weigh(spelled_words(text, tables))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names=names)

    rows = docs.select(whole(text_column).alias("_text"), *[c.alias(f"_{i}") for i, c in enumerate(carry)])
    plain = docs.select(*carry)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("_score", T.DoubleType())])
    names = schema.names
    return rows.mapInArrow(score, schema).toDF(*plain.columns, "score")


def keep_clean(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents below the score of rejection, all columns as they came."""
    scored = score_documents(docs, labels, [as_row(docs)], id_column, text_column)
    return scored.filter(F.col("score") < REJECT).select("_row.*")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(_crc("doc_id") == 1, F.lit(False)).alias("held_out")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score_documents(docs, labels, [F.col("doc_id"), held])
    return found.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))
