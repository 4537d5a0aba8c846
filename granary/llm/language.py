"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import others

DIMENSIONS = 1024
UNKNOWN = "und"
CHARS_AT_ONCE = 500_000
DOCS_AT_ONCE = 256
DENSE_CODES = 1 << 22


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


@lru_cache(maxsize=8192)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of +1 and -1 of a letter; it depends on the letter alone, so all executors agree. Code 0 is a word border."""
    bits = np.random.Generator(np.random.Philox(key=code + 1)).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return 2 * bits - 1


def trigram_vectors(trigrams: np.ndarray) -> np.ndarray:
    """Bind the letters of each trigram (rows of three codes): the first permuted twice, the second once, multiplied."""
    letters, place = np.unique(trigrams, return_inverse=True)
    table = np.stack([letter_vector(int(code)) for code in letters])
    place = place.reshape(trigrams.shape)
    bound = np.roll(table, 2, axis=1)[place[:, 0]]
    bound *= np.roll(table, 1, axis=1)[place[:, 1]]
    bound *= table[place[:, 2]]
    return bound.astype(np.float32)


def trigrams_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letter trigrams of some texts: the different ones (rows of three codes), which one stands at each place, and the text there.

    Letters are in lower case; everything else is a border, runs of it count once, and each text begins and ends with one.
    """
    marked = [f"\n{text.lower()}\n" for text in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_is_letter()[codes], codes, 0)
    owner = np.repeat(np.arange(len(marked)), [len(text) for text in marked])
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep], owner[keep]
    inside = owner[2:] == owner[:-2] if len(owner) > 2 else np.zeros(0, dtype=bool)
    letters = np.flatnonzero(np.bincount(codes)) if len(codes) else np.zeros(0, dtype=np.int64)
    size = max(len(letters), 1)
    if size ** 3 <= DENSE_CODES and len(codes):
        rank = np.zeros(letters[-1] + 1, dtype=np.int64)
        rank[letters] = np.arange(size)
        place = rank[codes]
        code = ((place[:-2] * size + place[1:-1]) * size + place[2:])[inside]
        found = np.flatnonzero(np.bincount(code, minlength=1))
        index = np.zeros(size ** 3, dtype=np.int64)
        index[found] = np.arange(len(found))
        which = index[code]
        different = letters[np.stack([found // size ** 2, found // size % size, found % size], axis=1)]
    else:
        wide = codes.astype(np.int64)
        code = ((wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:])[inside]
        found, which = np.unique(code, return_inverse=True)
        low = (1 << 21) - 1
        different = np.stack([found >> 42, found >> 21 & low, found & low], axis=1)
    return different, which, owner[2:][inside]


def _portions(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in portions of bounded size; a longer text is cut, and its parts keep its number."""
    numbers, parts, size = [], [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text or ""), CHARS_AT_ONCE):
            part = text[start:start + CHARS_AT_ONCE]
            if parts and size + len(part) > CHARS_AT_ONCE:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            numbers.append(number)
            parts.append(part)
            size += len(part)
    if parts:
        yield numbers, parts


def bundles(texts: Sequence[str | None], groups: Sequence[int] | None = None, size: int | None = None) -> np.ndarray:
    """The bundle (sum) of the trigram vectors of each text, or of each group of texts. Texts without letters give zero."""
    groups = range(len(texts)) if groups is None else groups
    result = np.zeros((len(texts) if size is None else size, DIMENSIONS))
    for numbers, parts in _portions(texts):
        different, which, owner = trigrams_of(parts)
        lettered = (different != 0).any(axis=1)
        vectors = trigram_vectors(different) if len(different) else np.zeros((0, DIMENSIONS), dtype=np.float32)
        target = np.array([groups[number] for number in numbers])[owner] if len(owner) else owner
        ends = np.flatnonzero(np.diff(target, append=-1)) + 1
        start = 0
        for end in ends:
            count = np.bincount(which[start:end], minlength=len(different)) * lettered
            present = np.flatnonzero(count)
            result[target[start]] += count[present].astype(np.float32) @ vectors[present]
            start = end
    return result


@dataclass(frozen=True)
class LanguageProfiles:
    """The prototypes of the languages, each of length one."""

    languages: tuple[str, ...]
    prototypes: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        made = bundles(texts)
        length = np.linalg.norm(made, axis=1)
        lettered = length > 0
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = made @ self.prototypes.T / np.where(lettered, length, 1)[:, None]
        best = cosine.argmax(axis=1)
        names = [self.languages[i] if known else UNKNOWN for i, known in zip(best, lettered)]
        return names, np.where(lettered, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0)


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageProfiles:
    """Bundle the documents of each language into a prototype. Rows without text or language teach nothing.

    Every row is used. A map task adds up whole numbers, so the sums do not depend on order or retries, and sends one vector per
    language; what reaches the driver is one vector per language. An empty table gives no language at all.
    """
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = sorted(set(batch["_lang"]))
            place = {name: i for i, name in enumerate(names)}
            # texts of one language side by side are bundled in one step
            order = np.argsort(batch["_lang"].map(place).to_numpy(), kind="stable")
            made = bundles(batch["_text"].iloc[order].tolist(), [place[name] for name in batch["_lang"].iloc[order]], len(names))
            for name, vector in zip(names, np.rint(made).astype(np.int64)):
                sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [vector.tolist() for vector in sums.values()]})

    known = docs.select(F.col(f"`{text}`").alias("_text"), F.col(f"`{lang}`").alias("_lang")).where("_text IS NOT NULL AND _lang IS NOT NULL")
    partial = known.mapInPandas(add, "lang string, vector array<bigint>")
    summed = partial.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors: dict[str, np.ndarray] = {}
    for row in summed.toPandas().itertuples():
        vectors.setdefault(row.lang, np.zeros(DIMENSIONS))[row.place] = row.value
    learned = {name: vector / np.linalg.norm(vector) for name, vector in sorted(vectors.items()) if vector.any()}
    return LanguageProfiles(tuple(learned), np.array(list(learned.values())).reshape(-1, DIMENSIONS))


def predict_language(docs: DataFrame, profiles: LanguageProfiles, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, the language whose prototype has the greatest cosine with the document, and ``score``, that cosine cut to 0..1.

    A null text or one without a letter is ``und`` with score 0, as is everything if no language was learned. Equal cosines go to
    the first name. All rows stay; columns named like the added ones give way.
    """
    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = [], []
            # a bundle is many times as large as a short text, so only so many are held at a time
            for at in range(0, len(batch), DOCS_AT_ONCE):
                found, cosines = profiles.predict(batch.iloc[at:at + DOCS_AT_ONCE].tolist())
                names += found
                scores += cosines.tolist()
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": np.array(scores, dtype=np.float64)})

    kept = others(docs, ("lang_pred", "score"))
    return docs.select(*kept, predict.asNondeterministic()(F.col(f"`{text}`")).alias("_language")).select(*kept, "_language.lang_pred", "_language.score")
