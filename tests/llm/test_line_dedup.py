import hashlib
from collections import Counter

from granary.llm.line_dedup import drop_repeated_lines
from granary.llm.queries import ORACLES, QUERIES
from tests.llm.brute import kept_lines
from tests.oracle import connect, oracle_rows, spark_rows

SHARED = "A line that several documents share"
ROWS = [
    (3, f"own line of three\n{SHARED}\nshort"), (1, f"\t {SHARED.upper()} \r\nown line of one"), (2, SHARED), (2, SHARED),
    (4, f"{SHARED}\n{SHARED}\nshort\n\nown line of four"), (5, None), (6, ""), (7, "\n\n"), (None, f"{SHARED}\nonly null holds this line"),
    (8, "ÜBER alle Maße\nshort"), (9, "über alle Maße\nshort"), (10, "a line twice in one document\na line twice in one document"),
    (11, "word " * 30_000 + f"\n{SHARED}\n" + "x" * 100_000),
]


def expected(rows):
    return Counter((i, len(lines), len(lines) - len(kept), "\n".join(kept)) for i, lines, kept in kept_lines(rows))


def test_lines_equal_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    made = drop_repeated_lines(docs)
    assert made.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in made.collect()) == expected(ROWS)


def test_a_line_of_most_documents(spark):
    rows = [(i, f"{SHARED}\nown line number {i:06d}\n{'only some of them' if i % 3 else ''}") for i in range(600)]
    made = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in made.collect()) == expected(rows)


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, SHARED, 5, "x"), (2, SHARED, 6, "y")], "doc_id long, text string, n_lines int, _pos string")
    made = drop_repeated_lines(docs)
    assert made.columns == ["doc_id", "_pos", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, made.collect())) == [(1, "x", SHARED, 1, 0), (2, "y", "", 1, 1)]
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_query_equals_oracle(spark, data):
    names, rows = spark_rows(QUERIES["op10_line_dedup"](spark, data))
    assert (names, rows) == oracle_rows(connect(data), ORACLES["op10_line_dedup"])


def test_digest_is_of_the_kept_text(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    kept = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    found = {r.doc_id: r.kept_sha256 for r in QUERIES["op10_line_dedup"](spark, data).collect()}
    assert found == {i: hashlib.sha256(text.encode()).hexdigest() for i, text in kept.items()}
