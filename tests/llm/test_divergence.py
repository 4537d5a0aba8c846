import random
import re
from collections import Counter, defaultdict

import numpy as np

from granary.llm.divergence import audit_sources, skyband
from granary.llm.queries import ORACLES, QUERIES
from tests.llm.brute import UPPER
from tests.oracle import connect, oracle_rows, spark_rows


def brute_audit(rows, min_docs=10, top=10):
    """Rows are (text, lang, source); every group and term with plain whole numbers."""
    counts, totals, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts[lang, source].update(terms)
        totals[lang].update(terms)
        docs[lang].update(set(terms))
    result = []
    for lang in docs:
        kept = [term for term, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for l, s in counts if l == lang)

        def shares(count):
            words = sum(count[term] for term in kept)
            return {term: 1 + 10**9 * (count[term] + 2) // (words + 2 * len(kept)) for term in kept}

        whole, own = shares(totals[lang]), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            p = own[s]
            pairs = [(o, sum((p[t] - own[o][t])**2 // (p[t] + own[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[t] - whole[t])**2 // (p[t] + whole[t])) for t in kept if counts[lang, s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                result += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:most], 1)]
    return Counter(result)


def texts(draw, n):
    words = [f"{a}{b}" for a in "abcdeüéÄ" for b in ("", "x", "Y", "zz", "ø")]
    for _ in range(n):
        bias = draw.randrange(len(words))
        yield " ".join(draw.choice(words[:bias + 1]) for _ in range(draw.randrange(40)))


def test_audit_equals_brute_force(spark):
    draw = random.Random(11)
    rows = [(text, draw.choice(["en", "en", "de", None]), draw.choice(["a", "b", "b", "b", None, "ü", "Z"])) for text in texts(draw, 400)]
    rows += [("rare words of a language", "fr", "a"), (None, "fr", "b"), ("", "fr", "c"), (None, "it", "only"), ("same same", "en", "b")]
    rows += [("hot " * 3 + "Über-hot_x1y", "en", "hot")] * 300 + [("w" * 100_000 + " " + "long text " * 20_000, "en", "long")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    made = audit_sources(docs)
    assert made.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(tuple(row) for row in made.collect()) == brute_audit(rows)


def test_empty_and_clashing_tables(spark):
    docs = spark.createDataFrame([("a b", "en", "x", 1, 2), ("a b", "en", "y", 1, 2)], "text string, lang string, source string, value int, term int")
    assert sorted(map(tuple, audit_sources(docs).collect())) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert audit_sources(docs.limit(0)).collect() == []


def test_the_band_holds_what_is_dominated_less_than_k_times():
    draw = np.random.default_rng(2)
    for size, k in ((1, 1), (300, 1), (1500, 10), (700, 3)):
        count, total = draw.integers(1, 30, size), draw.integers(1, 30, size)
        term = np.array([f"t{n:05d}" for n in draw.permutation(size)], dtype=object)
        expected = {i for i in range(size) if sum(
            count[j] >= count[i] and total[j] <= total[i] and term[j] < term[i] for j in range(size)) < k}
        found = skyband(count, total, term, k)
        assert set(found.tolist()) == expected and len(found) == len(expected)


def test_query_equals_oracle(spark, data):
    names, rows = spark_rows(QUERIES["op11_source_divergence"](spark, data))
    assert (names, rows) == oracle_rows(connect(data), ORACLES["op11_source_divergence"])
