import random
from collections import Counter

import numpy as np
import pytest

from granary.llm import darts
from granary.llm.components import connected_components
from granary.llm.darts import Shingles, band_hashes, portions, shingles, sketch, weighted_jaccard
from granary.llm.near_dedup import keep_one_of_each, near_duplicates
from granary.llm.queries import QUERIES
from tests.llm import brute


def changed(draw, words, changes):
    words = list(words)
    for place in draw.sample(range(len(words)), changes):
        words[place] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(3, 250))] for _ in range(25)]
    rows = [" ".join(words) for words in base]
    rows += [changed(draw, words, min(len(words), n)) for words in base for n in (0, 1, 2, 4, 8)]
    rows += [" ".join(words).upper() + "!" for words in base[:5]] + ["", "...", "one two", "One, two", "a a a a a a a a", "a a a a a a"]
    return rows


def test_shingles_are_those_of_the_words(texts):
    at = 0
    for part in portions(texts):
        found = shingles(part)
        for i, text in enumerate(part):
            counts = brute.shingle_counts(text)
            assert sorted(found.of(i)[1].tolist()) == sorted(counts.values())
            assert (found.contents[i] == 0) == (not counts)
            for j in range(i):
                other = brute.shingle_counts(part[j])
                assert weighted_jaccard(found.of(i), found.of(j)) == pytest.approx(brute.weighted_jaccard(counts, other))
        at += len(part)
    assert at == len(texts)
    assert len(shingles([]).starts) == 1


def test_sketches_estimate_the_weighted_similarity(texts):
    found = shingles(texts)
    ranks = sketch(found, 512)
    errors = []
    for i in range(0, len(texts), 3):
        for j in range(i):
            errors.append((ranks[i] == ranks[j])[np.isfinite(ranks[i])].mean() - weighted_jaccard(found.of(i), found.of(j)) if found.contents[i] else 0)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    assert np.isinf(ranks[texts.index("")]).all()
    assert np.array_equal(ranks[0], sketch(shingles([texts[0]]), 512)[0]), "a sketch does not depend on its neighbours"


def test_darts_respect_weights_that_are_no_whole_numbers():
    draw = np.random.default_rng(1)
    hashes = draw.integers(1, 2**63, 40).astype(np.uint64)
    hashes.sort()
    a, b = draw.uniform(0.1, 5, 40), draw.uniform(0.1, 5, 40)
    both = Shingles(np.concatenate([hashes, hashes]), np.concatenate([a, b]), np.array([0, 40, 80]), np.ones(2, dtype=np.uint64))
    ranks = sketch(both, 4096)
    assert (ranks[0] == ranks[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.04)


def test_bands_agree_where_all_their_ranks_do():
    ranks = np.array([[1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 5.0]])
    one, other = band_hashes(ranks, 2)
    assert one[0] == other[0] and one[1] != other[1]


def test_portions_bound_their_size(monkeypatch):
    monkeypatch.setattr(darts, "CHARS_AT_ONCE", 10)
    assert list(portions(["a" * 8, "b", "c" * 30, "", "d"])) == [["a" * 8, "b"], ["c" * 30], ["", "d"]]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (7, 7), (20, 5), (20, 6), (6, 3)] + [(i, i + 1) for i in range(100, 140)]
    found = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 20: 1, 10: 10, 11: 10} | {i: 100 for i in range(100, 141)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_equal_brute_force(spark, texts):
    rows = [(1000 - i, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_duplicates(docs)
    assert {r.doc_id: r.class_id for r in found.collect()} == brute.near_classes(rows)
    kept = keep_one_of_each(docs.selectExpr("*", "doc_id as key", "'x' as node"))
    assert kept.columns == ["doc_id", "text", "key", "node"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute.near_classes(rows).values()))


def test_a_large_group_of_chained_copies(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, changed(draw, words, draw.choice([0, 1, 2, 3, 4, 5]))) for i in range(400)]
    rows += [(1000 + i, " ".join(f"v{draw.randrange(10**6)}" for _ in range(40))) for i in range(100)]
    rows += [(2000 + i, " ".join(words)) for i in range(300)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    classes = brute.near_classes([row for row in rows if row[0] < 2000])
    # two texts that are similar by a hair share a bucket with high probability, not for certain
    wrong = [r for r in found if r.doc_id < 2000 and r.class_id != classes[r.doc_id]]
    assert len(wrong) <= 2
    assert {r.class_id for r in found if r.doc_id >= 2000} == {0}


def test_nulls_and_repeated_rows(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(3, long), (3, long), (None, long), (2, None), (2, None), (4, ""), (5, "!!"), (6, long + " eleven twelve thirteen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter((r.doc_id, r.class_id, r.kept) for r in near_duplicates(docs).collect())
    assert found == Counter({(3, 3, True): 2, (None, 3, False): 1, (2, 2, True): 2, (4, 2, False): 1, (5, 5, True): 1, (6, 6, True): 1})
    assert sorted((r.doc_id, r.text or "") for r in keep_one_of_each(docs).collect()) == sorted(
        [(3, long), (2, ""), (5, "!!"), (6, rows[-1][1])])
    assert near_duplicates(docs.limit(0)).count() == 0 and keep_one_of_each(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = {r.doc_id: r.class_id for r in QUERIES["op6_minhash_near_dedup"](spark, sf).collect()}
    assert found == brute.near_classes(rows)


def test_links_of_a_bucket_are_a_forest(spark):
    """Nodes that are all similar, each a component of its own: links grow with the nodes, not with their pairs."""
    from granary.llm.near_dedup import _settled

    common = " ".join(f"word{i}" for i in range(200))
    texts = spark.createDataFrame([(i, f"{common} end{i}") for i in range(300)], "node long, text string")
    rest = spark.range(300).selectExpr("1L as bucket", "id as node", "id as root", "1700 as bytes")
    links = [tuple(row) for row in _settled(rest, texts, 5, 0.8).collect()]
    assert len(links) <= 2 * 299
    root = list(range(300))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    assert len({find(i) for i in range(300)}) == 1
