import zlib
from collections import Counter

import numpy as np
import pytest

from granary.llm import language
from granary.llm.language import UNKNOWN, bundles, learn_profiles, letter_vector, predict_language, trigrams_of
from granary.llm.queries import QUERIES

TEXTS = ["", None, "12 ++ 34", "a", "Ab, ab!  ÉÀ", "日本語のテキスト", "x" * 50, "word another\nword\tthird"]


def slow_bundle(text):
    letters, last = [0], 0
    for c in (text or "").lower():
        code = ord(c) if c.isalpha() else 0
        if code or last:
            letters.append(code)
        last = code
    if last:
        letters.append(0)
    total = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if a or b or c:
            total += np.roll(letter_vector(a), 2).astype(int) * np.roll(letter_vector(b), 1) * letter_vector(c)
    return total


def test_bundles_equal_brute_force(monkeypatch):
    assert np.array_equal(bundles(TEXTS), np.array([slow_bundle(text) for text in TEXTS]))
    grouped = bundles(TEXTS, [0, 0, 1, 1, 1, 0, 0, 1], 2)
    assert np.array_equal(grouped[1], sum(slow_bundle(TEXTS[i]) for i in (2, 3, 4, 7)))
    # many letters take the other way of counting
    monkeypatch.setattr(language, "DENSE_CODES", 0)
    assert np.array_equal(bundles(TEXTS), np.array([slow_bundle(text) for text in TEXTS]))
    # a long text is cut and added up; only trigrams across a cut are lost
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 10)
    assert np.array_equal(bundles(["abc def ghi jkl mno"]), [slow_bundle("abc def gh") + slow_bundle("i jkl mno")])
    assert np.array_equal(bundles(TEXTS[:3]), np.zeros((3, language.DIMENSIONS)))


def test_trigrams_name_their_text():
    different, which, owner = trigrams_of(["ab", "", "b"])
    found = Counter((i, tuple(different[w])) for w, i in zip(which, owner))
    a, b = ord("a"), ord("b")
    assert found == Counter({(0, (0, a, b)): 1, (0, (a, b, 0)): 1, (2, (0, b, 0)): 1})


def test_held_out_accuracy(spark, data):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, data).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en", 7), (2, "le chat est sur la table", "fr", 7), (3, None, "en", 7),
                                  (4, "123 !!", None, 7), (5, "the mat", None, 7), (5, "the mat", None, 7), (None, "la table est là", None, 7)],
                                 "doc_id long, text string, lang string, score int").repartition(3)
    profiles = learn_profiles(docs)
    assert profiles.languages == ("en", "fr")
    assert np.array_equal(profiles.prototypes, learn_profiles(docs.repartition(1)).prototypes)
    made = predict_language(docs, profiles)
    assert made.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = Counter((r.doc_id, r.lang_pred) for r in made.collect())
    assert found == Counter({(1, "en"): 1, (2, "fr"): 1, (3, UNKNOWN): 1, (4, UNKNOWN): 1, (5, "en"): 2, (None, "fr"): 1})
    assert all(r.score == 0 for r in made.where("lang_pred = 'und'").collect())
    nothing = learn_profiles(docs.limit(0))
    assert {r.lang_pred for r in predict_language(docs, nothing).collect()} == {UNKNOWN}
    assert predict_language(docs.limit(0), profiles).count() == 0


@pytest.mark.parametrize("size", [150_000])
def test_long_texts(spark, size):
    docs = spark.createDataFrame([(1, "abc " * size)], "doc_id long, text string")
    profiles = learn_profiles(docs.selectExpr("*", "'xx' as lang"))
    assert predict_language(docs, profiles).head().lang_pred == "xx"
