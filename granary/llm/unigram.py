"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.common import others

SPACE = "▁"
CACHED_CHUNKS = 400_000
DOCS_AT_ONCE = 128
WORDS_AT_ONCE = 2048
BYTES_AT_ONCE = 1 << 20
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: pieces with log scores, which of them are single bytes, which stand for nothing, and the unknown piece."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: Mapping[int, int]
    silent: frozenset[int]
    unknown: int

    @staticmethod
    def load(path: str) -> Pieces:
        """The vocabulary of a SentencePiece model file, with its scores as they are."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        pieces = tuple(model.id_to_piece(i) for i in size)
        byte_ids = {int(pieces[i][3:5], 16): i for i in size if model.is_byte(i)}
        silent = frozenset(i for i in size if model.is_control(i) or model.is_unused(i) or model.is_unknown(i))
        return Pieces(pieces, tuple(model.get_score(i) for i in size), byte_ids, silent, model.unk_id())

    def spelled(self) -> dict[str, int]:
        """The pieces that stand for their own letters."""
        bytes_ = set(self.byte_ids.values())
        return {piece: i for i, piece in enumerate(self.pieces) if i not in bytes_ and i not in self.silent and piece}


class DoubleArrayTrie:
    """Byte strings in two arrays: from state ``s`` the byte ``c`` leads to ``base[s] + c + 1`` if ``check`` of that is ``s``."""

    def __init__(self, strings: Mapping[bytes, int]):
        size = 1 << 12
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, -1, dtype=np.int64)
        self.value = np.full(size, -1, dtype=np.int64)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for string, number in strings.items():
            node = 0
            for code in string:
                node = children[node].setdefault(code, len(children))
                if node == len(children):
                    children.append({})
            ends[node] = number
        self.check[0] = 0
        # the search for room goes on where it last succeeded, apart for nodes with one child, which fill gaps
        state, waiting, last = {0: 0}, [0], {True: 1, False: 1}
        for node in waiting:
            if node in ends:
                self.value[state[node]] = ends[node]
            if not children[node]:
                continue
            codes = np.array(sorted(children[node])) + 1
            at = last[len(codes) == 1] = self._room(last[len(codes) == 1], codes)
            self.base[state[node]] = at
            self.check[at + codes] = state[node]
            for code in codes.tolist():
                child = children[node][code - 1]
                state[child] = at + code
                waiting.append(child)
        # a step from any state stays inside the arrays
        self._reach(int(self.base.max()) + 258)

    def _room(self, low: int, codes: np.ndarray) -> int:
        """The first place from ``low`` on where all of a node's children fit."""
        while True:
            self._reach(low + 1024 + 258)
            tried = np.arange(low, low + 1024)
            tried = tried[self.check[tried + codes[0]] == -1]
            fits = (self.check[tried[:, None] + codes] == -1).all(axis=1)
            if fits.any():
                return int(tried[fits.argmax()])
            low += 1024

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            grown = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(grown, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(grown, -1, dtype=np.int64)])
            self.value = np.concatenate([self.value, np.full(grown, -1, dtype=np.int64)])


class UnigramCodec:
    """Encodes texts with the best sum of log scores, and decodes ids.

    White space is a marker: a text gets one in front and each blank becomes one. No piece joins letters to a following marker and no
    piece holds a line end, which is checked; so the best path is the sum of the best paths of the chunks between, and known chunks
    are remembered up to a bound. New chunks run through the trie side by side.
    """

    def __init__(self, pieces: Pieces):
        spelled = pieces.spelled()
        self.trie = DoubleArrayTrie({piece.encode(): number for piece, number in spelled.items()})
        self.scores = np.array(pieces.scores, dtype=np.float64)
        least = min((pieces.scores[number] for number in spelled.values()), default=0.0)
        self.unknown_score = least - UNKNOWN_PENALTY
        self.byte_ids = np.array([pieces.byte_ids.get(byte, -1) for byte in range(256)])
        self.by_bytes = bool((self.byte_ids >= 0).all())
        self.unknown = pieces.unknown
        joined = any(SPACE in piece.lstrip(SPACE) for piece in spelled)
        self.apart = not joined and not any("\n" in piece for piece in spelled)
        surfaces = [b"" if i in pieces.silent else piece.encode() for i, piece in enumerate(pieces.pieces)]
        for byte, number in pieces.byte_ids.items():
            surfaces[number] = bytes([byte])
        surfaces[self.unknown] = " ⁇ ".encode()
        self.surface_ends = np.cumsum([len(surface) for surface in surfaces])
        self.surface_sizes = np.array([len(surface) for surface in surfaces])
        self.surface = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.place = {"": 0}
        self.ids = np.zeros(0, dtype="<u4")
        self.bounds = np.zeros(2, dtype=np.int64)

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.apart:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " ":
            marked = SPACE + text.replace(" ", SPACE)
            return re.sub(f"({SPACE}+)", r" \1", marked).replace("\n", " \n ").split(" ")
        return (SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")).split(" ")

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.place) > CACHED_CHUNKS:
            self._forget()
        chunks: list[str] = []
        sizes = []
        for text in texts:
            found = self._chunks(text)
            sizes.append(len(found))
            chunks += found
        places = np.fromiter(map(self.place.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        new = np.flatnonzero(places < 0)
        if len(new):
            self._learn(list(dict.fromkeys(chunks[i] for i in new.tolist())))
            places[new] = [self.place[chunks[i]] for i in new.tolist()]
        starts = self.bounds[places]
        lengths = self.bounds[places + 1] - starts
        ends = np.cumsum(lengths)
        gathered = self.ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *sizes])] * 4
        data = gathered.tobytes()
        return [data[start:end] for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _learn(self, chunks: list[str]) -> None:
        encoded = sorted(((len(data), data, chunk) for chunk, data in ((chunk, chunk.encode()) for chunk in chunks)), key=lambda x: x[0])
        at = 0
        while at < len(encoded):
            end = min(at + WORDS_AT_ONCE, len(encoded))
            while end > at + 1 and (end - at) * encoded[end - 1][0] > BYTES_AT_ONCE:
                end = at + (end - at) // 2
            group = encoded[at:end]
            ids, counts = self.best_paths([data for _, data, _ in group])
            first = len(self.bounds) - 1
            self.place.update(zip((chunk for _, _, chunk in group), range(first, first + len(group))))
            self.bounds = np.concatenate([self.bounds, len(self.ids) + np.cumsum(counts)])
            self.ids = np.concatenate([self.ids, ids.astype("<u4")])
            at = end

    def best_paths(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the best path of each word, one after another, and their numbers. All words take each step together.

        Of equal paths the one whose last piece begins earlier is taken. A character that no piece spells alone may be passed as
        unknown, at a score below all pieces, and becomes its bytes.
        """
        sizes = np.array([len(word) for word in words])
        count, longest = len(words), int(sizes.max(initial=0))
        text = np.zeros((count, longest + 4), dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        row = np.repeat(np.arange(count), sizes)
        text[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        best = np.full((count, longest + 5), -np.inf)
        best[:, 0] = 0
        piece = np.full((count, longest + 5), -1)
        origin = np.zeros((count, longest + 5), dtype=np.int64)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for i in range(longest):
            lead = text[:, i]
            begin = np.flatnonzero((i < sizes) & ((lead & 0xC0) != 0x80))
            if not len(begin):
                continue
            width = np.ones(count, dtype=np.int64)
            width[begin] = 1 + (lead[begin] >= 0xC0) + (lead[begin] >= 0xE0) + (lead[begin] >= 0xF0)
            alone = np.zeros(count, dtype=bool)
            alive, state, j = begin, np.zeros(len(begin), dtype=np.int64), i
            while len(alive) and j < longest:
                following = base[state] + text[alive, j] + 1
                ok = (check[following] == state) & (j < sizes[alive])
                alive, state = alive[ok], following[ok]
                j += 1
                number = value[state]
                ends = number >= 0
                if ends.any():
                    word, number = alive[ends], number[ends]
                    alone[word[width[word] == j - i]] = True
                    total = best[word, i] + self.scores[number]
                    better = total > best[word, j]
                    word = word[better]
                    best[word, j], piece[word, j], origin[word, j] = total[better], number[better], i
            word = begin[~alone[begin]]
            if len(word):
                target, total = i + width[word], best[word, i] + self.unknown_score
                better = total > best[word, target]
                word, target = word[better], target[better]
                best[word, target], piece[word, target], origin[word, target] = total[better], -1, i
        made = np.full((count, longest + 1), -1)
        word, end = np.flatnonzero(sizes), sizes[sizes > 0]
        while len(word):
            start, number = origin[word, end], piece[word, end]
            spelled = number >= 0
            made[word[spelled], start[spelled]] = number[spelled]
            passed, from_, to = word[~spelled], start[~spelled], end[~spelled]
            if len(passed) and self.by_bytes:
                for step in range(4):
                    inside = from_ + step < to
                    made[passed[inside], from_[inside] + step] = self.byte_ids[text[passed[inside], from_[inside] + step]]
            elif len(passed):
                made[passed, from_] = self.unknown
            more = start > 0
            word, end = word[more], start[more]
        return made[made >= 0], (made >= 0).sum(axis=1)

    def decode(self, ids: Sequence[bytes]) -> list[str]:
        """The text of each sequence of ids: bytes are put together, markers become blanks, the one in front goes."""
        counts = np.array([len(data) // 4 for data in ids])
        numbers = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
        lengths = self.surface_sizes[numbers]
        ends = np.cumsum(lengths)
        letters = self.surface[np.repeat(self.surface_ends[numbers] - ends, lengths) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        texts = (letters[start:end].decode("utf-8", "replace").replace(SPACE, " ") for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return [text[1:] if text[:1] == " " else text for text in texts]


@lru_cache(maxsize=2)
def codec(path: str) -> UnigramCodec:
    return UnigramCodec(Pieces.load(path))


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, make: Callable[[list], list], empty: object) -> DataFrame:
    """``df`` with a column made from ``source``, a few rows at a time, so that neither side of a batch is held in full twice."""
    kept = [field for field in df.schema if field.name.lower() != name.lower()]
    fed = df.select(*others(df, (name,)), F.col(f"`{source}`").alias("_source"))
    arrow = {"string": pa.string(), "binary": pa.binary()}[kind.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                values = [empty if value is None else value for value in part.column(len(kept)).to_pylist()]
                columns = [*part.columns[:len(kept)], pa.array(make(values), arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=[*[field.name for field in kept], name])

    return fed.mapInArrow(run, T.StructType([*kept, T.StructField(name, kind)]))


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Add ``ids``, the best segmentation of each text, as little-endian unsigned 32-bit numbers.

    A null or empty text has no ids. ``vocabulary`` is the path of a SentencePiece model file, readable on all executors; its pieces
    and scores are used, not its algorithm. All rows stay; a column named ``ids`` gives way.
    """
    return _with_column(docs, text, "ids", T.BinaryType(), lambda texts: codec(vocabulary).encode(texts), "")


def decode_ids(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of each sequence of ids in column ``into``; null ids give an empty text, broken bytes the replacement character.

    Decoding gives back what was encoded, except that the marker itself becomes a blank. All rows stay; a column named ``into`` gives way.
    """
    return _with_column(encoded, ids, into, T.StringType(), lambda rows: codec(vocabulary).decode(rows), b"")
