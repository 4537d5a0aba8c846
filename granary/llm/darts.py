"""Weighted minwise sketches of word shingles by thrown darts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

CHARS_AT_ONCE = 1_000_000
FIRST_SLAB = 12
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit permutation whose output bits all depend on all input bits."""
    values = np.asarray(values, dtype=np.uint64) + _ODD
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def uniform(values: np.ndarray) -> np.ndarray:
    return (mix(values) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    return np.array([chr(code).isalnum() for code in range(0x110000)]), mix(np.arange(0x110000, dtype=np.uint64))


@lru_cache(maxsize=8)
def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _powers_for(base: np.uint64, count: int) -> np.ndarray:
    return _powers(int(base), 1 << max(int(count), 1).bit_length())[:count]


@dataclass(frozen=True)
class Shingles:
    """Weighted shingles of some texts: ascending hashes of each text one after another, their counts, and where each text begins."""

    hashes: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    contents: np.ndarray

    def of(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.starts[number], self.starts[number + 1])
        return self.hashes[here], self.weights[here]


def portions(texts: Sequence[str]) -> Iterator[list[str]]:
    """Texts in order, in portions of bounded size; a longer text is alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHARS_AT_ONCE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def shingles(texts: Sequence[str], words: int = 5) -> Shingles:
    """Shingles of ``words`` words, a word being a run of letters and digits in lower case.

    A text with fewer words is one shingle of all of them; a text without a word has none. ``contents`` is a 64-bit fingerprint of
    the sequence of words, 0 if there is none.
    """
    word_hash, owner = _word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(word_hash)) - first[owner]
    contents = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        placed = mix(word_hash) * _powers_for(_STEP, int(counts.max()))[place]
        contents[some] = mix(np.add.reduceat(placed, first[some]) ^ counts[some].astype(np.uint64)) | np.uint64(1)
    total = np.zeros(len(word_hash), dtype=np.uint64)
    powers = _powers_for(_STEP, words)
    within = np.minimum(counts, words)[owner]
    for j in range(min(words, len(word_hash))):
        shifted = np.concatenate([word_hash[j:], np.zeros(j, dtype=np.uint64)])
        total += np.where(j < within, shifted * powers[j], np.uint64(0))
    begins = place <= (counts - np.minimum(counts, words))[owner]
    hashes, owner = mix(total[begins] + within[begins].astype(np.uint64)), owner[begins]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    where = np.flatnonzero(new)
    weights = np.diff(where, append=len(hashes)).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner[where], minlength=len(texts)))])
    return Shingles(hashes[where], weights, starts, contents)


def _word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, from its letters alone, and the text it stands in."""
    is_word, value = _letters()
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = is_word[codes]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value[codes] * _powers_for(_ODD, len(codes)), dtype=np.uint64)])
    inverse = pow(int(_ODD), -1, 1 << 64)
    hashes = mix((sums[end] - sums[begin]) * _powers_for(np.uint64(inverse), len(codes) + 1)[begin])
    ends = np.cumsum([len(text) + 1 for text in lowered])
    return hashes, np.searchsorted(ends, begin, side="right")


@lru_cache(maxsize=256)
def _poisson(mean: float) -> np.ndarray:
    """The distribution function of a Poisson number, up to where it is 1."""
    terms, term, k = [], np.exp(-mean), 0
    while k < mean or term > 1e-18:
        terms.append(term)
        k += 1
        term *= mean / k
    return np.cumsum(terms)


def sketch(found: Shingles, coordinates: int) -> np.ndarray:
    """For each text the rank of the earliest dart of each coordinate; two texts agree in one with the probability of their weighted Jaccard similarity.

    Darts fall on the plane of weight and rank of each shingle as a Poisson process that its hash alone decides, ``coordinates``
    per unit of area, each dealt to one coordinate. A text sees the darts below the weight of its shingles. Ranks are scanned in
    slabs of doubling width until every coordinate of the text has a dart; the first is the earliest, as slabs ascend. So a text
    costs about ``n log n`` darts for ``n`` coordinates, however many shingles it has. Weights are cut into cells of doubling width
    in the same way, and a dart above the weight does not count. A text without shingles stays at infinity.
    """
    texts = len(found.starts) - 1
    result = np.full((texts, coordinates), np.inf)
    owner = np.repeat(np.arange(texts), np.diff(found.starts))
    open_ = np.diff(found.starts) > 0
    slab, low, high = 0, 0.0, 2.0 ** -FIRST_SLAB
    while open_.any():
        active = open_[owner]
        hashes, weights, text = found.hashes[active], found.weights[active], owner[active]
        cell, floor, top = 0, 0.0, 1.0
        while len(hashes):
            seed = mix(hashes ^ mix(np.array([slab << 20 | cell], dtype=np.uint64)))
            known = _poisson(coordinates * (high - low) * (top - floor))
            thrown = np.searchsorted(known, uniform(seed), side="right")
            hit = np.flatnonzero(thrown)
            count = thrown[hit]
            element = np.repeat(hit, count)
            number = np.arange(len(element)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix(seed[element] + number.astype(np.uint64) * _STEP)
            rank = low + (high - low) * uniform(dart)
            coordinate = (mix(dart ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(coordinates)).astype(np.int64)
            if cell or weights.min() < top:
                under = floor + (top - floor) * uniform(dart ^ np.uint64(0x14057B7EF767814F)) < weights[element]
                element, rank, coordinate = element[under], rank[under], coordinate[under]
            np.minimum.at(result.reshape(-1), text[element] * coordinates + coordinate, rank)
            more = weights > top
            hashes, weights, text = hashes[more], weights[more], text[more]
            cell, floor, top = cell + 1, top, 2 * top
        open_ &= ~np.isfinite(result).all(axis=1)
        slab, low, high = slab + 1, high, 2 * high
    return result


def band_hashes(ranks: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash for each band of consecutive coordinates."""
    values = np.ascontiguousarray(ranks).view(np.uint64).reshape(len(ranks), bands, -1)
    total = mix(np.arange(bands, dtype=np.uint64))[None, :] + np.zeros((len(ranks), 1), dtype=np.uint64)
    for j in range(values.shape[2]):
        total = mix(total ^ values[:, :, j])
    return total.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The sum of the lesser weights over the sum of the greater ones; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - common
    return float(common / whole) if whole else 0.0
