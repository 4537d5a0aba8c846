import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm.queries import QUERIES, with_cycles
from granary.llm.runs import SuffixAutomaton, find_runs, periodic_runs


def brute_runs(words, min_words=6, power=4):
    """Every maximal stretch of every period, that has no lesser period."""
    n, found = len(words), []
    for period in range(1, n // power + 1):
        at = 0
        while at + period < n:
            end = at + period
            while end < n and words[end] == words[end - period]:
                end += 1
            stretch = words[at:end]
            if len(stretch) >= max(min_words, power * period) and not any(
                    all(stretch[i] == stretch[i - less] for i in range(less, len(stretch))) for less in range(1, period)):
                found.append((at, end - at, period))
            at = end - period + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_cycles(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


def brute_row(doc_id, text):
    words = brute_cycles(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    kept = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def sequences():
    draw = random.Random(3)
    for letters in (1, 2, 3, 5):
        for _ in range(150):
            yield [draw.randrange(letters) for _ in range(draw.randrange(0, 60))]
    for _ in range(200):
        # planted runs, one inside another
        words = [draw.randrange(50) for _ in range(draw.randrange(20))]
        for _ in range(draw.randrange(1, 4)):
            cycle = [draw.randrange(4) for _ in range(draw.randrange(1, 6))]
            words += (cycle * 9)[:draw.randrange(1, 9 * len(cycle) + 1)] + [draw.randrange(50) for _ in range(draw.randrange(3))]
        yield words * draw.randrange(1, 6)


@pytest.mark.parametrize("min_words, power", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(min_words, power):
    for words in sequences():
        assert find_runs(np.array(words, dtype=np.int64), min_words, power) == brute_runs(words, min_words, power), words


def test_access_tells_where_factors_ended_last():
    draw = random.Random(5)
    for _ in range(100):
        words = [draw.randrange(3) for _ in range(draw.randrange(1, 40))]
        automaton = SuffixAutomaton(words)
        for end in range(len(words)):
            last = {}
            for length in range(1, end + 2):
                factor = words[end - length + 1:end + 1]
                before = [e for e in range(length - 1, end) if words[e - length + 1:e + 1] == factor]
                if before:
                    last[max(before)] = length
            met = {}
            for longest, before in automaton.access(end):
                met[before] = max(longest, met.get(before, 0))
            assert {e: length for e, length in met.items() if length} == last


ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (5, "la " * 40), (5, "la " * 40), (6, "a b " * 9 + "c " + "x y z " * 5),
        (7, "Ünï cödé\x0bÜnï\x0ccödé " * 6), (8, "same word " * 7), (None, "no id no id no id no id"), (9, "w " * 5), (10, "w " * 6),
        (11, " ".join(str(i % 997) for i in range(30_000)))]


def test_rows_of_every_kind(spark):
    docs = spark.createDataFrame([(*row, "kept", 7) for row in ROWS], "doc_id long, text string, extra string, runs int").repartition(3)
    made = periodic_runs(docs)
    assert made.columns == ["doc_id", "text", "extra", "n_words", "runs", "collapsed"]
    rows = made.collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        words = (row.text or "").encode().split()
        runs = brute_runs(words) if len(words) < 1000 else [(0, 30_000, 997)]
        assert (row.n_words, [tuple(run) for run in row.runs]) == (len(words), runs)
        dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
        assert row.collapsed.encode() == b" ".join(word for i, word in enumerate(words) if i not in dropped)
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, power=1)


def test_cycles_are_those_of_the_contract(spark):
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(i % 83))) for i in range(600)] + [(1000, None), (None, "a b c")]
    made = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", with_cycles(F.col("doc_id"), F.col("text")).alias("text"))
    found = {row.doc_id: (row.text or "").encode().split() for row in made.collect()}
    assert found == {i: brute_cycles(i, text) for i, text in rows}
    assert sum(len(set(words)) < len(words) for words in found.values()) > 20


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    # brute force is quadratic
    chosen = {row.doc_id: row.text for row in docs if len((row.text or "").split()) <= 1500}
    rows = [row for row in QUERIES["op13_periodic_runs"](spark, data).collect()]
    assert len(rows) == len(docs)
    assert rows[0].__fields__ == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = sorted(tuple(row) for row in rows if row.doc_id in chosen)
    assert found == sorted(brute_row(i, text) for i, text in chosen.items())
    assert sum(row[1] > 0 for row in found) > 20
