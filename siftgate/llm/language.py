"""Language of a text: words by their frequency in each language, unseen words by ever shorter runs of characters."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import stored, table, whole
from siftgate.llm.packed import portions

UNKNOWN = "und"
# Different texts that the model is fitted on, taken from all languages by turns, and languages it can tell apart.
FIT_ROWS, LANGUAGES = 10_000, 200
# Words and character runs of the model, shared out evenly among its languages.
WORDS, RUNS = 100_000, 100_000
# Characters of a run, longest first, the blanks around a word included.
ORDERS = (5, 4, 3, 2, 1)
# Longer words are known by their runs only.
LONGEST = 40
# Added to every count.
SMOOTHING = 0.1
# Words of evidence that the score of a text can rest on: neighbouring words are not independent.
EVIDENCE = 10
WORD = re.compile(r"[^\W\d_]+")
# Words whose weights a task remembers; words of a text and bytes of a portion that are looked up together.
REMEMBERED, PIECE, PORTION = 200_000, 1 << 17, 1 << 20


def runs(word: str, order: int) -> list[str]:
    """Runs of characters of a word with a blank on either side; a blank alone is none."""
    padded = f" {word} " if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def fitted_texts(docs: DataFrame, fit_rows: int, languages: int) -> DataFrame:
    """``lang, text`` of different texts, chosen by a hash of the text: one of each language by turns.

    Only hashes are ranked; the texts chosen move once.
    """
    named = docs.withColumn("_hash", F.xxhash64("text"))
    common = docs.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(languages)
    different = named.join(F.broadcast(common), "lang", "left_semi").select("lang", "_hash").distinct()
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("_hash"))
    # what one language could take at most is cut before the exchange
    ranked = different.withColumn("_turn", turn).filter(F.col("_turn") <= fit_rows)
    chosen = ranked.orderBy("_turn", "lang").limit(fit_rows).select("lang", "_hash")
    kept = named.join(F.broadcast(chosen), ["lang", "_hash"], "left_semi")
    return kept.groupBy("lang", "_hash").agg(F.min("text").alias("text")).select("lang", "text")


def _counted(units):
    """A function for ``mapInArrow`` from rows of language, unit and number to added numbers of other units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for lang, text, number in zip(*[c.to_pylist() for c in batch.columns]):
                for unit in units(text):
                    sums[lang, unit] += number
        langs, found = zip(*sums) if sums else ((), ())
        columns = [pa.array(langs, pa.string()), pa.array(found, pa.string()), pa.array(sums.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "unit", "n"])

    return run


def _words(text: str) -> list[str]:
    return list(itertools.chain.from_iterable(_pieces(text)))


def _all_runs(word: str) -> Iterable[str]:
    return itertools.chain.from_iterable(runs(word, order) for order in ORDERS)


UNITS = "lang string, unit string, n long"


@dataclass
class Model:
    """Log frequencies: a row per word or run, a column per language."""

    languages: list[str]
    prior: np.ndarray
    rows: np.ndarray
    words: dict[str, int] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)


def _frequencies(counts: dict[str, np.ndarray], totals: np.ndarray) -> np.ndarray:
    table = np.array(list(counts.values()), float).reshape(-1, len(totals))
    return np.log((table + SMOOTHING) / (totals + SMOOTHING * (len(table) + 1)))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, languages: int = LANGUAGES, words: int = WORDS, run_count: int = RUNS) -> Model:
    """The model of ``lang, text`` rows; rows without one of the two are left out.

    A bounded sample of texts gives it; how common each language is, all rows tell. Sizes of sample and model are
    the parameters.
    """
    usable = docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    sample = fitted_texts(usable, fit_rows, languages)
    word_rows = sample.select("lang", "text", F.lit(1).cast("long")).mapInArrow(_counted(_words), UNITS)
    word_rows = stored(word_rows.groupBy("lang", "unit").agg(F.sum("n").alias("n")), "op11-words")
    run_rows = word_rows.mapInArrow(_counted(_all_runs), UNITS).groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    run_rows = stored(run_rows, "op11-runs")
    shares = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in shares)
    place = {n: i for i, n in enumerate(names)}
    prior = np.zeros(len(names))
    for row in shares:
        prior[place[row["lang"]]] = row["n"]
    model = Model(names, np.log((prior + 1) / (prior.sum() + len(names) + 1)), np.zeros((0, len(names))))
    if not names:
        return model

    def most_common(frame: DataFrame, size: int) -> dict[str, np.ndarray]:
        """Counts by language of units that are among the most frequent of any: at most ``size`` of them."""
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "unit"))
        chosen = frame.withColumn("_rank", rank).filter(F.col("_rank") <= max(1, size // len(names))).select("unit").distinct()
        counts: dict[str, np.ndarray] = {}
        found = frame.join(F.broadcast(chosen), "unit").toArrow().sort_by([("unit", "ascending")])
        for lang, unit, n in zip(*[found.column(c).to_pylist() for c in ("lang", "unit", "n")]):
            counts.setdefault(unit, np.zeros(len(names)))[place[lang]] = n
        return counts

    def totals(frame: DataFrame) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        for row in frame.groupBy("lang", F.length("unit").alias("size")).agg(F.sum("n").alias("n")).collect():
            sums.setdefault(row["size"], np.zeros(len(names)))[place[row["lang"]]] = row["n"]
        return sums

    short = word_rows.filter(F.length("unit") <= LONGEST)
    tables = []
    counts = most_common(short, words)
    tables.append(_frequencies(counts, sum(totals(short).values(), np.zeros(len(names)))))
    model.words = {w: i for i, w in enumerate(counts)}
    all_runs, by_order = most_common(run_rows, run_count), totals(run_rows)
    for order in ORDERS:
        some = {u: c for u, c in all_runs.items() if len(u) == order}
        start = sum(map(len, tables))
        model.runs |= {u: start + i for i, u in enumerate(some)}
        tables.append(_frequencies(some, by_order.get(order, np.zeros(len(names)))))
    model.rows = np.concatenate(tables)
    return model


def weigh(word: str, model: Model) -> np.ndarray:
    """Log frequencies of a word by language: its own, else the mean of those of its longest known runs, else zeros."""
    if (place := model.words.get(word)) is not None:
        return model.rows[place]
    for order in ORDERS:
        places = [p for r in runs(word, order) if (p := model.runs.get(r)) is not None]
        if places:
            return model.rows[places].mean(axis=0)
    return np.zeros(len(model.languages))


class _Memory:
    """Weights of the words a task has met, row by row; it starts anew when it is full."""

    def __init__(self, model: Model, limit: int):
        self.model, self.limit = model, limit
        self.rows = np.zeros((limit + PIECE, len(model.languages)))
        self.places: dict[str, int] = {}

    def sum(self, words: list[str]) -> np.ndarray:
        if len(self.places) > self.limit:
            self.places.clear()
        places = self.places
        for word in {w for w in words if w not in places}:
            self.rows[len(places)] = weigh(word, self.model)
            places[word] = len(places)
        return self.rows[np.fromiter(map(places.__getitem__, words), np.int64, len(words))].sum(axis=0)


def _pieces(text: str) -> Iterator[list[str]]:
    """A text's words, so many at a time; what has a word character but no letter is no word."""
    lowered = text.lower()
    if len(lowered) <= PIECE:
        found = iter((WORD.findall(lowered),))
    else:
        matches = (m.group() for m in WORD.finditer(lowered))
        found = iter(lambda: list(itertools.islice(matches, PIECE)), [])
    for words in found:
        yield [w for w in words if w.isascii() or any(map(str.isalpha, w))]


def predict(sums: np.ndarray, words: int, model: Model) -> tuple[str, float]:
    """The likeliest language, and its share: words count up to a bounded evidence, languages as often as they are."""
    logs = model.prior + sums * (min(words, EVIDENCE) / words)
    shares = np.exp(logs - logs.max())
    best = int(shares.argmax())
    return model.languages[best], float(shares[best] / shares.sum())


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memory = _Memory(model, min(REMEMBERED, max(1000, (1 << 23) // max(1, len(model.languages)))))
        for batch in portions(batches, 2, PORTION):
            names, scores = [], []
            for text in batch.column(2).to_pylist():
                sums, count = np.zeros(len(model.languages)), 0
                for words in _pieces(text):
                    if words and model.languages:
                        sums, count = sums + memory.sum(words), count + len(words)
                name, score = predict(sums, count, model) if count else (UNKNOWN, 0.0)
                names.append(name)
                scores.append(score)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return run


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, id_column="doc_id", text_column="text", lang_column="lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The language of every text, learned from rows whose CRC-32 of the id modulo 4 is not 2.

    Every word counts: known ones by the logarithm of their frequency in each language, unseen ones by the mean over
    their longest known runs of five characters or fewer. The score is the share of the language predicted.

    Null texts and texts without a letter are ``und`` with score 0, as all are if no row names a language; a null
    id counts as empty text; repeated rows and copies are fitted once but answered each; of equal languages the first
    by name is taken; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    held_out = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2
    learned = docs.filter(~held_out).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    shared = spark.sparkContext.broadcast(fit(learned, fit_rows))  # of bounded size: WORDS, RUNS, LANGUAGES
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), whole(text_column))
    return rows.mapInArrow(_predictor(shared), PREDICTED)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
