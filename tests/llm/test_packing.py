import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from granary.llm.packing import ChunkEncoder, binary_lengths, pack_documents, write_buckets
from granary.llm.queries import PACK_END_ID, PACK_VOCABULARY, QUERIES, vocabulary

ODD = ["", None, " ", "\n\n", "<|endoftext|> x <|ENDOFTEXT|>", "İstanbul Σίσυφος ΟΔΟΣ", "é é ́a שׁ,x", "a\x1cb\x85c d",
       "don't It's 12,5 ...,, x-y", "KK ﬁn", "a" * 9000 + ", b", "word " * 9000]


@pytest.fixture(scope="module")
def path():
    return vocabulary(PACK_VOCABULARY)


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [PACK_END_ID]


def test_binary_lengths():
    assert binary_lengths(1, 8) == [1]
    assert binary_lengths(21, 8) == [8, 8, 4, 1]
    assert binary_lengths(16, 8) == [8, 8]
    for n in range(1, 200):
        assert sum(binary_lengths(n, 16)) == n


def test_chunks_add_up_to_the_whole_text(spark, data, path, monkeypatch):
    tokenizer = Tokenizer.from_file(path)
    texts = [text or "" for text in ODD] + [r.text for r in spark.read.parquet(f"{data}/documents.parquet").limit(300).collect()]
    monkeypatch.setattr("granary.llm.packing.CACHED_CHUNKS", 500)
    encoder = ChunkEncoder(path)
    for at in range(0, len(texts), 20):
        part = texts[at:at + 20]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(part)] == [whole(tokenizer, text)[:-1] for text in part]
    assert encoder.encode([]) == []


def test_pieces_make_up_their_document(spark, path, tmp_path):
    rows = [(i, text, "s") for i, text in enumerate(ODD)] + [(2, ODD[2], "s"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    pieces = pack_documents(docs, path, PACK_END_ID, longest=1024)
    found = defaultdict(list)
    seen = set()
    for r in pieces.collect():
        assert r.length == len(r.ids) // 4 == 1 << r.bucket <= 1024 and r.offset == 0
        seen.add(r.sequence_id)
        found[r.doc_id].append((r.start, r.length, r.ids, r.doc_tokens))
    assert len(seen) == sum(map(len, found.values()))
    tokenizer = Tokenizer.from_file(path)
    for i, text, _ in rows:
        copies = sum(row[:2] == (i, text) for row in rows)
        ids, at = whole(tokenizer, text), 0
        for start, length, data, tokens in sorted(found[i])[::copies]:
            assert start == at and tokens == len(ids)
            assert np.frombuffer(data, "<u4").tolist() == ids[at:at + length]
            at += length
        assert at == len(ids)
    assert "start" in pieces.columns and dict(pieces.dtypes)["start"] == "bigint"
    write_buckets(pieces, str(tmp_path / "buckets"))
    assert "bucket=10" in os.listdir(tmp_path / "buckets")
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == len(seen)
    assert pack_documents(docs.limit(0), path, PACK_END_ID).count() == 0
    with pytest.raises(ValueError):
        pack_documents(docs, path, PACK_END_ID, longest=1000)


def test_query_covers_every_token(spark, data, path):
    tokenizer = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = defaultdict(list)
    for r in QUERIES["op2_packing"](spark, data).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 4096
        found[r.doc_id].append(r)
    assert found.keys() == texts.keys()
    for i in list(texts)[::7]:
        ids, at = np.array(whole(tokenizer, texts[i]), dtype="<u4"), 0
        for r in sorted(found[i], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids) == found[i][0].doc_tokens
