"""Toxicity scores from a learned lexicon that misspellings cannot escape."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import others
from granary.llm.components import stored

SAMPLE_ROWS = 20_000
# The chance that any form at all becomes a term though it stands in documents of label 1 no more often than others do.
FALSE_TERMS = 0.01
MIN_DOCS = 5
MIN_PURITY = 0.8
STEM_LETTERS = (4, 5, 6)
# From so many letters on a term may be misspelled by one edit, and by two.
FUZZY_LETTERS = (3, 8)
WINDOW_WORDS = 10
KNOWN_WORDS = 300_000
AUTOMATON_STATES = 50_000

_WORD = re.compile(r"[^\W_]+")
# Words with marks inside, and single letters with blanks between them.
_MASKED = re.compile(r"(?<![^\W_])(?:[^\W_]++(?:(?:[^\w\s]|_){1,3}[^\W_]++)++|[^\W_](?:[^\S\n][^\W_]){2,}(?![^\W_]))")
_MARK = re.compile(r"[\"'“”„«»‘’\n]")


@dataclass(frozen=True)
class Term:
    """A word, or with ``stem`` the beginning of words, and the evidence of its exact and misspelled forms."""

    text: str
    stem: bool
    exact: float
    fuzzy: float = 0.0
    far: float = 0.0

    @property
    def edits(self) -> int:
        return sum(len(self.text) >= letters for letters in FUZZY_LETTERS)

    def evidence(self, edits: int) -> float:
        """Of the exact form, of one edit, and of more."""
        return (self.exact, self.fuzzy, self.far)[min(edits, 2)]


def quotations(text: str) -> list[tuple[int, int]]:
    """Start and end of each quotation of a text, in order and apart: marks are paired, however far from each other.

    Straight marks open before a word and close behind one, as do single ones, which are apostrophes else; a single straight mark
    is not paired over lines. A further opening mark before the closing one, as of each paragraph, is inside.
    """
    opened: dict[str, int] = {}
    spans: list[tuple[int, int]] = []
    for found in _MARK.finditer(text):
        at, mark = found.start(), found.group()
        before, after = text[at - 1:at], text[at + 1:at + 2]
        if mark == "\n":
            opened.pop("'", None)
            continue
        closes = {'"': '"', "'": "'", "”": "“„", "“": "„", "»": "«", "’": "‘"}.get(mark, "")
        ends = mark not in "\"'’" or not before.isspace() and not after.isalnum()
        first = min((opened[kind] for kind in closes if kind in opened), default=-1)
        if first >= 0 and ends:
            for kind in closes:
                opened.pop(kind, None)
            while spans and spans[-1][0] >= first:
                spans.pop()
            if not spans or spans[-1][1] < at:
                spans.append((first, at + 1))
        elif mark in "“„«‘" or mark in "\"'" and not before.isalnum() and after and not after.isspace():
            opened.setdefault(mark, at)
    return spans


@dataclass
class Match:
    term: int
    edits: int


class LexiconAutomaton:
    """The Levenshtein automata of all terms, intersected with the trie of the lexicon and made deterministic as words need it.

    A state is the set of trie nodes that the letters so far may have reached, each with the fewest edits, and the stems already
    complete. Most words die after a few letters, as no node is left. The states met are kept up to a bound, then built anew.
    """

    def __init__(self, terms: Sequence[Term]):
        self.terms = list(terms)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.allowed: list[int] = [0]
        for number, term in enumerate(self.terms):
            node = 0
            self.allowed[0] = max(self.allowed[0], term.edits)
            for letter in term.text:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                self.allowed[node] = max(self.allowed[node], term.edits)
            self.ends[node].append(number)
        # two neighbouring letters in each other's place are one step
        self.swapped: dict[tuple[str, bool], int] = {}
        for number in sorted(range(len(self.terms)), key=lambda i: (-self.terms[i].fuzzy, i)):
            term = self.terms[number]
            for i in range(len(term.text) - 1 if term.edits else 0):
                form = term.text[:i] + term.text[i + 1] + term.text[i] + term.text[i + 2:]
                self.swapped.setdefault((form, term.stem), number)
        self.stem_sizes = sorted({len(form) for form, stem in self.swapped if stem}, reverse=True)
        self._restart()

    def near(self, word: str) -> Match | None:
        """The match of a word, with a swap of neighbours as one edit."""
        found = self.match(word)
        if found is not None and found.edits <= 1:
            return found
        forms = [(word, False), *((word[:size], True) for size in self.stem_sizes)]
        number = next((self.swapped[form] for form in forms if form in self.swapped), None)
        return found if number is None else Match(number, 1)

    def _restart(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple[dict[int, int], dict[int, int]]] = []
        self.steps: list[dict[str, int]] = []
        self.results: list[Match | None] = []
        self.start = self._state({0: 0}, {})

    def _state(self, nodes: dict[int, int], stems: dict[int, int]) -> int:
        """The number of a state; letters that the word lacks are skipped here."""
        waiting = list(nodes.items())
        while waiting:
            node, edits = waiting.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and edits + 1 < nodes.get(child, 9):
                    nodes[child] = edits + 1
                    waiting.append((child, edits + 1))
        stems = dict(stems)
        words: dict[int, int] = {}
        for node, edits in nodes.items():
            for number in self.ends[node]:
                if edits <= self.terms[number].edits:
                    into = stems if self.terms[number].stem else words
                    into[number] = min(edits, into.get(number, 9))
        key = (frozenset(nodes.items()), frozenset(stems.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append((nodes, stems))
            self.steps.append({})
            found = [(edits, -self._evidence(number, edits), number) for number, edits in {**stems, **words}.items()]
            self.results.append(Match(min(found)[2], min(found)[0]) if found else None)
        return self.numbers[key]

    def _evidence(self, number: int, edits: int) -> float:
        return self.terms[number].evidence(edits)

    def _step(self, state: int, letter: str) -> int:
        nodes, stems = self.states[state]
        following: dict[int, int] = {}
        for node, edits in nodes.items():
            if edits + 1 <= self.allowed[node]:
                following[node] = min(edits + 1, following.get(node, 9))
            for other, child in self.children[node].items():
                cost = edits + (other != letter)
                if cost <= self.allowed[child]:
                    following[child] = min(cost, following.get(child, 9))
        return self._state(following, stems)

    def match(self, word: str) -> Match | None:
        """The term nearest to a word, with fewest edits and then the strongest evidence; None if there is none."""
        if len(self.states) > AUTOMATON_STATES:
            self._restart()
        state = self.start
        for letter in word:
            following = self.steps[state].get(letter)
            if following is None:
                following = self.steps[state][letter] = self._step(state, letter)
            state = following
            if not self.states[state][0]:
                break
        return self.results[state]


class _Words:
    """The automaton of a lexicon and the words it has judged so far."""

    def __init__(self, terms: Sequence[Term]):
        self.automaton = LexiconAutomaton(terms)
        self.clean: set[str] = set()
        self.hot: dict[str, Match] = {}


# A worker serves many tasks of one model; it keeps the words of the last model it met.
_met: dict[tuple[Term, ...], _Words] = {}


@dataclass
class ToxicityModel:
    """Terms and the weights of a logistic score over a document's evidence."""

    terms: list[Term]
    weights: list[float]
    _words: _Words | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "weights": self.weights, "_words": None}

    @property
    def _hot(self) -> dict[str, Match]:
        return self._words.hot

    def _hot_words(self, words: set[str]) -> bool:
        if self._words is None:
            key = tuple(self.terms)
            if key not in _met:
                _met.clear()
                _met[key] = _Words(self.terms)
            self._words = _met[key]
        known = self._words
        if len(known.clean) > KNOWN_WORDS or len(known.hot) > KNOWN_WORDS:
            known.clean.clear()
            known.hot.clear()
        some = False
        for word in words - known.clean:
            if word in known.hot:
                some = True
                continue
            found = known.automaton.near(word)
            if found is None:
                known.clean.add(word)
            else:
                known.hot[word] = found
                some = True
        return some

    def matches(self, text: str) -> list[dict]:
        """The terms in a text: term, word, start, end (code points), edits, its place among the words and whether it is quoted."""
        lowered = text.lower()
        masked = [(found.start(), found.end(), "".join(_WORD.findall(found.group()))) for found in _MASKED.finditer(lowered)]
        if not self._hot_words({*_WORD.findall(lowered), *(word for _, _, word in masked)}):
            return []
        hot = [(start, end, word) for start, end, word in masked if word in self._hot]
        quoted = quotations(lowered)
        result, inside = [], 0

        def add(start: int, end: int, found: Match, edits: int, place: int) -> None:
            nonlocal inside
            while inside < len(quoted) and quoted[inside][1] <= start:
                inside += 1
            cited = inside < len(quoted) and quoted[inside][0] <= start
            result.append({"term": self.terms[found.term].text, "word": lowered[start:end], "start": start, "end": end,
                           "edits": edits, "place": place, "quoted": cited, "number": found.term})

        pending = iter([*hot, (len(lowered) + 1, 0, "")])
        ahead, within, first = next(pending), None, 0
        for place, word in enumerate(_WORD.finditer(lowered)):
            start, end = word.span()
            if within is not None and start >= within[1]:
                # none of its parts was a term itself
                if not result or result[-1]["end"] <= within[0]:
                    add(within[0], within[1], self._hot[within[2]], self._hot[within[2]].edits + 1, first)
                within = None
            if start == ahead[0]:
                within, first, ahead = ahead, place, next(pending)
            found = self._hot.get(word.group())
            if found is not None:
                add(start, end, found, found.edits, place)
        if within is not None and (not result or result[-1]["end"] <= within[0]):
            add(within[0], within[1], self._hot[within[2]], self._hot[within[2]].edits + 1, first)
        return result

    def evidence(self, matches: Sequence[dict]) -> list[float]:
        """What a document is judged by: open evidence, its densest window, quoted evidence; each on a logarithmic scale."""
        weight = [self.terms[m["number"]].evidence(m["edits"]) for m in matches]
        open_ = [w if not m["quoted"] else 0.0 for w, m in zip(weight, matches)]
        densest, total, first = 0.0, 0.0, 0
        for i, match in enumerate(matches):
            total += open_[i]
            while matches[first]["place"] < match["place"] - WINDOW_WORDS:
                total -= open_[first]
                first += 1
            densest = max(densest, total)
        return [float(np.log1p(max(value, 0.0))) for value in (sum(open_), densest, sum(weight) - sum(open_))]

    def score(self, matches: Sequence[dict]) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], self.evidence(matches)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, chosen by a hash of the id; one label per id and per text, and whether a row picks terms."""
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    chosen = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(rows)
    found = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # the sample has a fixed bound, so it may be broadcast; copies of a text are evidence once
    texts = found.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    return stored(texts.withColumn("picks", F.pmod(F.xxhash64("text"), F.lit(3)) > 0), "labelled")


def _lexicon(sample: DataFrame) -> list[Term]:
    """Words and stems that stand almost only in documents with label 1, and there more often than chance explains.

    By Chernoff's bound a form in n documents, a share s of them with label 1, comes about by chance with a probability of at most
    exp(-n KL(s, base rate)); times the number of forms that must not exceed ``FALSE_TERMS``. So a term needs about ten documents, and
    the sample bounds the number of terms.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]{3,}"), F.lit(0)))
    split = sample.select("toxic", words.alias("words"))

    def stems(size: int):
        longer = F.filter("words", lambda w: F.char_length(w) > size)
        return F.array_distinct(F.transform(longer, lambda w: F.concat(F.substring(w, 1, size), F.lit("*"))))

    forms = split.select("toxic", F.explode(F.concat("words", *[stems(size) for size in STEM_LETTERS])).alias("form"))
    counted = forms.groupBy("form").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    totals = sample.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")).head()
    base = np.log((totals["bad"] or 0) + 1) - np.log(totals["all"] - (totals["bad"] or 0) + 1)
    pure = counted.where((F.col("bad") >= MIN_DOCS) & (F.col("bad") >= MIN_PURITY * (F.col("bad") + F.col("good"))))
    rate = ((totals["bad"] or 0) + 1) / (totals["all"] + 2)
    n = F.col("bad") + F.col("good")
    surprise = F.col("bad") * F.ln(F.col("bad") / n / rate) + F.when(F.col("good") > 0, F.col("good") * F.ln(F.col("good") / n / (1 - rate))).otherwise(0.0)
    # a share below the base rate is as far from it, but says the opposite
    enough = np.log(max(counted.count(), 1) / FALSE_TERMS)
    rows = pure.where((F.col("bad") / n > rate) & (surprise > enough)).orderBy(F.desc("bad"), "form").collect()
    bad = {row["form"]: row["bad"] for row in rows}
    evidence = {row["form"]: float(np.log(row["bad"] + 0.5) - np.log(row["good"] + 0.5) - base) for row in rows}
    most = dict.fromkeys(bad, 0)
    for form, count in bad.items():
        bare = form.rstrip("*")
        for size in STEM_LETTERS:
            stem = f"{bare[:size]}*"
            if size < len(bare) and stem in most:
                most[stem] = max(most[stem], count)
    # a stem is worth having if no single longer form explains it, and a form only if no stem above it is kept
    stems_kept = {form for form in bad if form.endswith("*") and most[form] < 0.8 * bad[form]}
    kept = []
    for form in bad:
        bare = form.rstrip("*")
        covered = any(size < len(bare) and f"{bare[:size]}*" in stems_kept for size in STEM_LETTERS)
        if not covered and (form in stems_kept or not form.endswith("*")):
            kept.append(Term(bare, form.endswith("*"), evidence[form]))
    return kept


PRIOR = np.array([-3.0, 1.5, 1.5, 0.75])


def _fitted(features: np.ndarray, toxic: np.ndarray) -> list[float]:
    """Weights of a logistic score, drawn towards a prior in which quoted evidence counts a quarter and nothing means clean.

    The penalised likelihood has one maximum. Newton's steps towards it are halved until the likelihood rises enough, so that it is
    reached from everywhere. More open evidence never makes a document cleaner: a weight that would be negative is held at zero.
    """
    x = np.hstack([np.ones((len(features), 1)), features])
    free = np.ones(len(PRIOR), dtype=bool)
    while True:
        weights = np.where(free, PRIOR, 0.0)
        weights = _maximised(x, toxic, weights, free)
        negative = free & (weights < 0)
        negative[0] = False
        if not negative.any():
            return [float(w) for w in weights]
        free &= ~negative


def _maximised(x: np.ndarray, toxic: np.ndarray, weights: np.ndarray, free: np.ndarray) -> np.ndarray:
    def likelihood(w: np.ndarray) -> float:
        z = x @ w
        return float(toxic @ z - np.logaddexp(0.0, z).sum() - 0.5 * ((w - PRIOR)[free] ** 2).sum())

    value = likelihood(weights)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
        gradient = (x.T @ (toxic - p) - (weights - PRIOR))[free]
        hessian = ((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(PRIOR)))[np.ix_(free, free)]
        step = np.zeros(len(PRIOR))
        step[free] = np.linalg.solve(hessian, gradient)
        gain, part = float(gradient @ step[free]), 1.0
        while part > 1e-12 and likelihood(weights + part * step) < value + 1e-4 * part * gain:
            part /= 2
        if part <= 1e-12:
            break
        weights = weights + part * step
        value = likelihood(weights)
        if gain < 1e-10:
            break
    return weights


def learn_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                   sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn terms and weights from at most ``sample_rows`` labelled documents, chosen by a hash of their ids.

    First the words and stems that mark label 1 are found, by two thirds of the texts. Then the automaton is run over the sample, and
    the misspelled forms of each term get evidence from the labels of the documents they stand in: a form that is common in clean
    documents gets none. Last, a logistic score is fitted to the evidence of the other third, which picked no term. Null labels, ids and labels other than 0 and 1 teach nothing; with two labels for an id
    the greater holds. Without labelled documents the lexicon is empty and all scores are low.
    """
    sample = _sample(docs, labels, doc_id, text, label, sample_rows)
    model = ToxicityModel(_lexicon(sample.where("picks")), [0.0, 0.0, 0.0, 0.0])
    model = ToxicityModel(_with_fuzzy(sample, model), model.weights)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [model.evidence(model.matches(value)) for value in batch["text"]]
            yield pd.DataFrame(rows, columns=["a", "b", "c"], dtype=float).assign(toxic=batch["toxic"].to_numpy())

    rows = sample.where("NOT picks").mapInPandas(evidence, "a double, b double, c double, toxic int").toPandas()
    weights = _fitted(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy())
    return ToxicityModel(model.terms, weights)


def _with_fuzzy(sample: DataFrame, model: ToxicityModel) -> list[Term]:
    """The terms with the evidence of their misspelled forms."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(number, edits, toxic) for value, toxic in zip(batch["text"], batch["toxic"])
                    for number, edits in {(m["number"], min(m["edits"], 2)) for m in model.matches(value) if m["edits"]}]
            yield pd.DataFrame(rows, columns=["number", "edits", "toxic"], dtype="int64")

    found = sample.mapInPandas(count, "number bigint, edits bigint, toxic bigint").groupBy("number", "edits").agg(
        F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")).collect()
    totals = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("all")).head()
    base = np.log(totals["bad"] + 1) - np.log(totals["all"] - totals["bad"] + 1)
    seen = {(row["number"], row["edits"]): (row["bad"], row["all"] - row["bad"]) for row in found}
    result = []
    for number, term in enumerate(model.terms):
        weights = []
        for edits in (1, 2):
            bad, good = seen.get((number, edits), (0, 0))
            # an unseen form is trusted half as much as the term itself
            fuzzy = np.log(bad + 0.5) - np.log(good + 0.5) - base if bad + good else term.exact / 2
            weights.append(float(min(max(fuzzy, 0.0), term.exact)))
        result.append(Term(term.text, term.stem, term.exact, *weights))
    return result


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``matches`` (term, word, start, end, edits, quoted) for every text.

    Null and empty texts have no matches and the low score of a text without evidence. Positions are code points of the text in lower
    case. All rows stay; columns named like the added ones give way.
    """
    @F.pandas_udf("struct<score: double, matches: array<struct<term: string, word: string, start: int, end: int, edits: int, quoted: boolean>>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("term", "word", "start", "end", "edits", "quoted")
        for batch in batches:
            found = [model.matches(value or "") for value in batch]
            yield pd.DataFrame({"score": [model.score(matches) for matches in found],
                                "matches": [[{name: m[name] for name in names} for m in matches] for matches in found]})

    kept = others(docs, ("score", "predicted", "matches"))
    made = docs.select(*kept, run.asNondeterministic()(F.col(f"`{text}`")).alias("_toxicity"))
    return made.select(*kept, "_toxicity.score", (F.col("_toxicity.score") >= 0.5).cast("int").alias("predicted"), "_toxicity.matches")
