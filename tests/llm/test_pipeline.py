import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from granary.llm.queries import PACK_END_ID, PACK_VOCABULARY, vocabulary
from tests.llm import brute

SHARED = "A passage of the kind that many pages repeat at their end"


@pytest.fixture(scope="module")
def directory(spark, tmp_path_factory):
    draw = random.Random(12)
    words = {"en": "the house stands on a hill and looks over fields of corn".split(), "fr": "la maison est sur une colline avec des champs".split()}
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        lines = [" ".join(draw.choice(words[lang]) + draw.choice(["", "s", "e", "er"]) for _ in range(draw.randint(10, 40))) for _ in range(3)]
        lines += [SHARED] if i % 2 else []
        lines += [f"write to person{i}@mail.example.com or +1 (555) 555-{i:04d}"] if i % 5 == 0 else []
        rows.append((i, "\n".join(lines), lang if i % 7 else None, "src", 0))
    for i in range(10):
        tokens = rows[i][1].split(" ")
        tokens[3] = "changed"
        rows.append((100 + i, " ".join(tokens), rows[i][2], "src", 0))
    rows += [(200, None, "en", "src", 0), (201, "", None, "src", 0), (202, "12345 !!", "en", "src", 0), (203, "the house", "en", None, None), (5, rows[5][1], rows[5][2], "src", 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def plain_stages(rows):
    """(id, text) after each stage but the last, by plain Python."""
    docs = [(i, text) for i, text, *_ in rows if any(c.isalpha() for c in text or "")]
    yield docs
    docs = [(i, "\n".join(kept)) for i, _, kept in brute.kept_lines(docs)]
    yield docs
    single = dict(docs)
    classes = brute.near_classes(list(single.items()))
    docs = [(i, text) for i, text in single.items() if classes[i] == i]
    yield docs
    docs = [(i, brute.redacted(text, brute.personal(text))) for i, text in docs]
    yield docs


def test_stages_equal_brute_force(spark, directory):
    path, rows = directory
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "pii", "packing"]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain_stages(rows)):
        made = stage(spark, docs, path)
        assert made.schema.names == docs.schema.names and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
        found = made.collect()
        assert sorted((r.doc_id, r.text) for r in found) == sorted(expected), name
        if name in ("line_dedup", "pii"):
            assert all(r.n_chars == len(r.text) for r in found)
        if name == "language_id":
            assert all(r.lang for r in found)
        docs = spark.createDataFrame(found, made.schema)


def test_run_packs_what_is_left(spark, directory):
    path, rows = directory
    left = list(plain_stages(rows))[-1]
    tokenizer = Tokenizer.from_file(vocabulary(PACK_VOCABULARY))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, path).collect():
        assert r.length & (r.length - 1) == 0 and r.offset == 0
        pieces[r.doc_id].append((r.start, r.ids))
    found = {i: np.frombuffer(b"".join(ids for _, ids in sorted(parts)), "<u4").tolist() for i, parts in pieces.items()}
    assert found == {i: tokenizer.encode(text, add_special_tokens=False).ids + [PACK_END_ID] for i, text in left}


def test_run_over_an_empty_table(spark, directory, tmp_path):
    spark.read.parquet(f"{directory[0]}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_documents_stay_when_no_language_is_known(spark):
    rows = [(1, "the house", None, "src", 9), (2, "12345 !!", None, "src", 8), (3, None, None, "src", 0), (4, "la maison", None, "src", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in found) == [(1, "the house", "und"), (4, "la maison", "und")]


def test_columns_of_the_caller_stay(spark):
    """Columns named like those that operators make or use inside."""
    words = [f"word{i} of a text about hills and houses and fields with number {i} in it" for i in range(12)]
    rows = [(i, f"{text}\nA line that all of the texts hold", "en", "src", 0, 7.5, 99, ["s"], "k", i, True, 1, "z", "o")
            for i, text in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines int, "
                                       "spans array<string>, key string, _row_key long, _gone boolean, lang_pred int, _line_id string, others string")
    expected = {row[0]: row[5:] for row in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, "")
        assert made.schema.names == docs.schema.names and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema], name
        found = made.collect()
        assert {row.doc_id: tuple(row[5:]) for row in found} == expected, name
        docs = spark.createDataFrame(found, docs.schema)
    assert corpus_pipeline.pack(spark, docs, "").where("others.score = 7.5 AND others.others = 'o'").count() >= len(rows)
