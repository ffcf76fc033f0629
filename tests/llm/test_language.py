"""Languages: held-out accuracy, the scoring word by word against a plain version, odd rows."""

import re
import zlib

import conftest as odd_data
import numpy as np
import pytest
from pyspark.sql import functions as F

from siftgate.llm import common, language

SF_DIR = "/root/testdata/sf0.01"


def plain(text, model):
    """Each word by itself: known, or by the longest runs that are known; then the shares."""
    words = [w for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w)]
    if not words:
        return "und", 0.0
    totals = [0.0] * len(model.languages)
    for word in words:
        units = [word] if word in model.words else []
        table = model.words
        for size in (5, 4, 3, 2, 1):
            if units:
                break
            padded, table = (f" {word} " if size > 1 else word), model.runs
            units = [u for u in (padded[i : i + size] for i in range(len(padded) - size + 1)) if u in table]
        for i in range(len(totals)):
            totals[i] += sum(model.rows[table[u]][i] for u in units) / max(1, len(units))
    logs = [model.prior[i] + totals[i] * min(10, len(words)) / len(words) for i in range(len(totals))]
    shares = np.exp(np.array(logs) - max(logs))
    return model.languages[int(shares.argmax())], shares.max() / shares.sum()


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(common.table(spark, SF_DIR, "documents"))


def test_plain_scores(model, spark):
    texts = [r.text for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts += ["Qwrtz XYLOPHON äöü ¿qué?", "², ½ Ⅷ 12 _", "日本語", "zzzzzz " * 30, "a" * 300, "it's 4u2c", "İstanbul"]
    memory = language._Memory(model, 50)
    for text in texts:
        pieces = list(language._pieces(text))
        count = sum(map(len, pieces))
        sums = sum((memory.sum(p) for p in pieces), np.zeros(len(model.languages)))
        name, score = language.predict(sums, count, model) if count else ("und", 0.0)
        want, share = plain(text, model)
        assert name == want and score == pytest.approx(share), text[:50]


def test_words_fall_back(model):
    word = next(iter(model.words))
    assert (language.weigh(word, model) == model.rows[model.words[word]]).all()
    assert not language.weigh("ʘʘʘ", model).any()
    unseen = next(w for w in ("theqqing", "schungqq", "ciónqq") if w not in model.words)
    assert language.weigh(unseen, model).any()


def test_long_texts_are_read_whole(model):
    """The tail of a long text counts: so many words of one language after one of another."""
    pieces = list(language._pieces("the " * (language.PIECE + 7)))
    assert sum(map(len, pieces)) == language.PIECE + 7


@pytest.mark.parametrize("sf_dir, least", [(SF_DIR, 0.98), ("/root/testdata/sf0.1", 0.99)])
def test_held_out_accuracy(spark, sf_dir, least):
    found = language.op11_language(spark, sf_dir).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in common.table(spark, sf_dir, "documents").collect()}
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    asked = [r for r in found if r.held_out and truth[r.doc_id][0] is not None and any(map(str.isalpha, truth[r.doc_id][1]))]
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in asked)
    assert right / len(asked) >= least


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    other = docs.withColumn("lang", F.when(crc == 2, "xx").otherwise(F.col("lang")))
    assert sorted(language.identify(docs).collect()) == sorted(language.identify(other).collect())


def test_copies_are_fitted_once(spark):
    rows = [(0, "alpha beta gamma", "a"), (1, "delta epsilon", "b")]
    many = rows + [(i, "alpha beta gamma", "a") for i in range(3, 300)]
    once, often = (language.fit(spark.createDataFrame(r, "doc_id long, text string, lang string")) for r in (rows, many))
    assert (once.rows == often.rows).all() and once.words == often.words
    assert (once.prior != often.prior).any()


def test_odd_rows(spark, odd, empty):
    found = language.identify(odd).collect()
    assert len(found) == len(odd_data.odd_rows())
    blank = {i for i, t, _ in odd_data.odd_rows() if not any(map(str.isalpha, t or ""))}
    assert {r.doc_id for r in found if r.lang_pred == "und"} == blank
    assert {r.lang_pred for r in found} == {"und", "en"}
    assert language.identify(empty).count() == 0
    nameless = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(nameless).collect()} == {("und", 0.0)}
