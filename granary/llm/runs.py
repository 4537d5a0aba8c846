"""Stretches of words that repeat with a period, by a suffix automaton whose link tree remembers where each factor last ended."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import others

MIN_WORDS = 6
MIN_POWER = 4
SLICE_ROWS = 500

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MADE = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class SuffixAutomaton:
    """All factors of a sequence; the states, hung on their suffix links, form a tree that is cut into heavy paths.

    ``access`` appends one word to what was read: it walks from the state of the prefix to the root and gives every path segment it
    meets the new end. A segment is a stretch of a heavy path whose factors all ended last at one place, so a heavy path keeps its
    segments as a stack, the one nearest to the root on top; those above the state go, the one it lies in is cut in two.
    """

    def __init__(self, words: Sequence[int]):
        self.length, self.link = [0], [-1]
        steps: list[dict[int, int]] = [{}]
        self.prefix: list[int] = []
        last = 0
        for word in words:
            state = len(self.length)
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            steps.append({})
            at = last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = state
                at = self.link[at]
            if at >= 0:
                after = steps[at][word]
                if self.length[after] > self.length[at] + 1:
                    split = len(self.length)
                    self.length.append(self.length[at] + 1)
                    self.link.append(self.link[after])
                    steps.append(dict(steps[after]))
                    self.link[after] = split
                    while at >= 0 and steps[at].get(word) == after:
                        steps[at][word] = split
                        at = self.link[at]
                    after = split
                self.link[state] = after
            self.prefix.append(state)
            last = state
        self._cut_into_paths()

    def _cut_into_paths(self) -> None:
        states = np.argsort(np.array(self.length), kind="stable").tolist()
        below = [1] * len(states)
        for state in reversed(states[1:]):
            below[self.link[state]] += below[state]
        heavy = [-1] * len(states)
        for state in states[1:]:
            above = self.link[state]
            if heavy[above] < 0 or below[state] > below[heavy[above]]:
                heavy[above] = state
        self.head = list(range(len(states)))
        for state in states[1:]:
            if heavy[self.link[state]] == state:
                self.head[state] = self.head[self.link[state]]
        self.segments: list[list[tuple[int, int]]] = [[] for _ in states]

    def access(self, end: int) -> list[tuple[int, int]]:
        """For the word at ``end``: the longest factor of each segment met, which ends here too, and where it ended last."""
        met = []
        state = self.prefix[end]
        while state > 0:
            longest, head = self.length[state], self.head[state]
            segments, seen = self.segments[head], 0
            while segments and segments[-1][0] <= longest:
                seen = segments[-1][0]
                met.append(segments.pop())
            if segments and seen < longest:
                met.append((longest, segments[-1][1]))
            segments.append((longest, end))
            state = self.link[head]
        return met


def windows(words: np.ndarray, min_words: int, power: int) -> list[tuple[int, int]]:
    """Stretches outside of which no run can lie; they are apart and in order.

    Behind its first period each word of a run stands at most a period after its last occurrence. So, for periods up to a power of
    two, only stretches of words that come again that soon and are long enough for the least of these periods matter, and the period
    before them.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    gap = np.full(n, n + 1)
    gap[order[1:][again]] = (order[1:] - order[:-1])[again]
    found = []
    breaks, most = np.arange(n), 1
    while (power - 1) * ((most + 1) // 2) < n:
        breaks = breaks[gap[breaks] > most]
        edges = np.concatenate(([-1], breaks, [n]))
        enough = max((power - 1) * ((most + 1) // 2), min_words - most, 1)
        for place in np.flatnonzero(np.diff(edges) > enough):
            found.append((max(0, int(edges[place]) + 1 - most), int(edges[place + 1])))
        most = 2 * most + 1
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS, power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start and then period.

    A factor that ends here and ended last ``period`` words ago overlaps itself, or touches, if it is at least that long: what both
    cover repeats with that period, and with no lesser one, as the factor would have ended later else. It is extended to both sides.
    """
    runs = []
    for first, behind in windows(words, min_words, power):
        inside = words[first:behind].tolist()
        automaton = SuffixAutomaton(inside)
        reached: dict[int, int] = {}
        for end in range(len(inside)):
            for longest, before in automaton.access(end):
                period = end - before
                if longest < (power - 1) * period or longest + period < min_words or end < reached.get(period, 0):
                    continue
                start, stop = end - longest - period + 1, end + 1
                while start and inside[start - 1] == inside[start - 1 + period]:
                    start -= 1
                while stop < len(inside) and inside[stop] == inside[stop - period]:
                    stop += 1
                reached[period] = stop
                runs.append((first + start, stop - start, period))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _examined(text: bytes, min_words: int, power: int) -> tuple[int, list[tuple[int, int, int]], bytes]:
    # white space of the ASCII range, which is what splits bytes
    words = text.split()
    runs = []
    if len(words) >= min_words:
        numbers = {word: number for number, word in enumerate(dict.fromkeys(words))}
        if len(numbers) < len(words):
            runs = find_runs(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), min_words, power)
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[place] for place in np.flatnonzero(kept)]
        return len(kept), runs, b" ".join(words)
    return len(words), runs, b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, power: int = MIN_POWER) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period, in words from 0) and ``collapsed`` to every row.

    Words are what stands between white space of the ASCII range. A run is a stretch of consecutive words with a smallest period, at
    least ``min_words`` long and at least ``power`` (2 or more) times its period, that no neighbouring word extends. Runs come by start
    and then period. ``collapsed`` joins by one space the words that no run holds behind its first period.

    Null, empty and blank texts have no word, no run and an empty collapsed text. Rows and texts may repeat; every row stays, in its
    partition, without a shuffle. Other columns stay, and one named like an added one gives way. A text is handled as a whole: of a
    very long one only what can lie in a run goes into the automaton, which takes about a kilobyte a word there. An empty table stays
    empty.
    """
    if power < 2 or min_words < 2:
        raise ValueError("a run has at least two periods and two words")

    @F.arrow_udf(_MADE)
    def examine(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for at in range(0, len(batch), SLICE_ROWS):
                found = [_examined(value or b"", min_words, power) for value in batch.slice(at, SLICE_ROWS).cast(pa.binary()).to_pylist()]
                counts, runs, kept = zip(*found)
                shown = [[dict(zip(("start", "length", "period"), one)) for one in some] for some in runs]
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(counts, pa.int64()), pa.array(shown, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["n_words", "runs", "collapsed"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
                [("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]))

    kept = others(docs, ("n_words", "runs", "collapsed"))
    return docs.select(*kept, examine.asNondeterministic()(F.col(f"`{text}`")).alias("_found")).select(
        *kept, "_found.n_words", "_found.runs", "_found.collapsed")
