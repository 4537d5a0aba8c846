"""Packing by powers of two: no sequence holds more than one document and none needs padding."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import others

MADE = ("doc_tokens", "start", "length", "ids", "bucket", "sequence_id", "offset")
CACHED_CHUNKS = 400_000
DOCS_AT_ONCE = 128
WORDS_AT_ONCE = 50
MARKS = ".,"


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """As many pieces of ``longest`` (a power of two) as fit, then the powers of two that make up the rest, falling."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << bit for bit in reversed(range(longest.bit_length())) if rest >> bit & 1]


def _simple(text: str) -> bool:
    """Whether lower case, the vocabulary's own step after the normal form, can be taken first: no letters but Latin-1, no special tokens."""
    if text.isascii():
        return "<|" not in text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, remembering what it has encoded.

    The vocabulary drops white space and never joins across it, so a text is the sum of its chunks between blanks and line ends. The
    ids of known chunks lie in one array; a text is put together by gathering their ranges. Once ``CACHED_CHUNKS`` are known, all are
    forgotten before the next texts. New words go to the tokenizer many at a time, and the ends of words in the result tell them apart; a
    word with a mark behind it is put together from both; all other chunks are encoded each for itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.place = {"": 0}
        self.ids = np.zeros(0, dtype="<u4")
        self.bounds = np.zeros(2, dtype=np.int64)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.place) > CACHED_CHUNKS:
            self._forget()
        chunks: list[str] = []
        sizes = []
        for text in texts:
            found = (text.lower() if _simple(text) else text).replace("\n", " ").split(" ")
            sizes.append(len(found))
            chunks += found
        places = np.fromiter(map(self.place.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        new = np.flatnonzero(places < 0)
        if len(new):
            self._learn(list(dict.fromkeys(chunks[i] for i in new.tolist())))
            places[new] = [self.place[chunks[i]] for i in new.tolist()]
        gathered, ends = self._gather(places)
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *sizes])] * 4
        data = gathered.tobytes()
        return [data[start:end] for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known chunks one after another, and where each chunk ends."""
        starts = self.bounds[places]
        lengths = self.bounds[places + 1] - starts
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)], ends

    def _learn(self, chunks: list[str]) -> None:
        marked = [chunk for chunk in chunks if chunk[-1] in MARKS and chunk[:-1].isalpha()]
        words = dict.fromkeys([chunk for chunk in chunks if chunk.isalpha()] + [chunk[:-1] for chunk in marked])
        taken = {*words, *marked}
        rest = [chunk for chunk in chunks if chunk not in taken] + [mark for mark in MARKS if mark not in self.place and mark not in chunks]
        words = [word for word in words if word not in self.place]
        groups = [words[at:at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE)]
        fitting, encoded, limits, size = [], [], [], 0
        for group, found in zip(groups, self._encoded([" ".join(group) for group in groups])):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):
                rest += group
                continue
            fitting += group
            encoded.append(ids)
            limits.append(ends + size)
            size += len(ids)
        self._remember(fitting, encoded, limits)
        encoded = [np.array(found.ids, dtype="<u4") for found in self._encoded(rest)]
        self._remember(rest, encoded, [np.cumsum([len(ids) for ids in encoded], dtype=np.int64)])
        # a word and its mark are two pieces of text to the vocabulary
        both = np.array([self.place[part] for chunk in marked for part in (chunk[:-1], chunk[-1])], dtype=np.int64)
        ids, ends = self._gather(both)
        self._remember(marked, [ids], [ends[1::2]])

    def _remember(self, chunks: list[str], encoded: list[np.ndarray], limits: list[np.ndarray]) -> None:
        first = len(self.bounds) - 1
        self.place.update(zip(chunks, range(first, first + len(chunks))))
        self.bounds = np.concatenate([self.bounds, *[limit + len(self.ids) for limit in limits]])
        self.ids = np.concatenate([self.ids, *encoded])

    def _encoded(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, longest: int = 4096, text: str = "text") -> DataFrame:
    """One row per piece of a document: each document is cut into pieces whose lengths are powers of two, at most ``longest``.

    A piece is a whole sequence; equal lengths share a ``bucket`` (the exponent), so that a batch drawn from one bucket has no
    padding and no sequence crosses documents. ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers,
    ``start`` the ids of its document before it, ``doc_tokens`` all ids of the document with its ``end_id``. ``sequence_id`` is
    unique and ``offset`` is 0.

    A null or empty text is a document of ``end_id`` alone. Repeated rows are packed each for itself. ``text`` is left out, other
    columns repeat on each piece, and a column named like a made one gives way to it. An empty table gives no piece. ``tokenizer``
    is the path of a word-level vocabulary that drops white space, readable on all executors.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = end_id.to_bytes(4, "little")

    @F.arrow_udf("array<binary>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            # only so many texts and ids are Python objects at a time
            parts = [pa.array([], pa.list_(pa.binary()))]
            for at in range(0, len(batch), DOCS_AT_ONCE):
                out = []
                for ids in encode([value or "" for value in batch.slice(at, DOCS_AT_ONCE).to_pylist()]):
                    ids += end
                    cuts, start = [], 0
                    for length in binary_lengths(len(ids) // 4, longest):
                        cuts.append(ids[start:start + 4 * length])
                        start += 4 * length
                    out.append(cuts)
                parts.append(pa.array(out, pa.list_(pa.binary())))
            yield pa.concat_arrays(parts)

    kept = others(docs, (text, *MADE))
    # marked as not deterministic, or the optimizer runs it once for each use of its result
    whole = docs.select(*kept, pieces.asNondeterministic()(F.col(f"`{text}`")).alias("_pieces"))
    whole = whole.withColumn("doc_tokens", F.aggregate(
        "_pieces", F.lit(0).cast("bigint"), lambda n, ids: n + F.shiftright(F.octet_length(ids), 2)))
    rows = whole.select(*kept, "doc_tokens", F.posexplode("_pieces").alias("_pos", "ids"))
    rows = rows.withColumn("length", F.shiftright(F.octet_length("ids"), 2).cast("bigint"))
    before = F.col("doc_tokens") - F.col("doc_tokens") % (2 * F.col("length"))
    start = F.when(F.col("length") == longest, F.col("_pos").cast("bigint") * longest).otherwise(before)
    return rows.select(*kept, "doc_tokens", start.alias("start"), "length", "ids", F.log2("length").cast("int").alias("bucket"),
                       F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))


def write_buckets(pieces: DataFrame, path: str, mode: str = "error") -> None:
    """One directory per sequence length, so that a loader draws batches of equal length without reading the others."""
    pieces.hint("rebalance", "bucket").write.mode(mode).partitionBy("bucket").parquet(path)
