"""How the sources of a language differ in what words they use: exact divergences of smoothed shares, and the terms behind them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.components import stored
from granary.operators.sizing import broadcast_if_small

MIN_DOCS = 10
TOP_TERMS = 10
# A task holds so many counted terms, band rows and cells of a block at once before it passes them on.
HELD_TERMS = 250_000
HELD_ROWS = 200_000
BLOCK_CELLS = 1_000_000

# Letters of a term: A-Z in lower case, a-z and whatever is not ASCII, byte by byte; all else parts terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences and documents of the texts of a task, added up as far as ``HELD_TERMS`` allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def counts() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(total), pa.string()), pa.array([source] * len(total), pa.string()),
                pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64()),
                pa.array(map(docs.__getitem__, total), pa.int64())], ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        size = sum(len(total) for total, _ in held.values())
        for at, group in enumerate(zip(langs, sources)):
            terms = batch.column("text")[at].as_buffer().to_pybytes().translate(_LETTERS).split()
            if not terms:
                continue
            total, docs = held.setdefault(group, (Counter(), Counter()))
            before = len(total)
            total.update(terms)
            docs.update(set(terms))
            size += len(total) - before
            if size > HELD_TERMS:
                yield from counts()
                size = 0
    yield from counts()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each term that at least ``min_docs`` rows of a language hold: lang, term, total and counts, a map from source to occurrences.

    Counts of a task travel once, by language and term, and serve both the totals of a term and its counts per source. The map holds
    an entry for each source of the language that has the term, not for each document.
    """
    partial = docs.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    # one exchange by what is common to both aggregates below
    dealt = partial.repartition("lang", "term")
    by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return by_term.where(F.col("docs") >= min_docs).drop("docs")


def share(count: str, words: str, terms: str) -> str:
    """1 and the billionths that a smoothed count is of its group, rounded down, in SQL; exact, as decimals are multiplied."""
    return f"1 + (CAST(1000000000 AS DECIMAL(12, 0)) * CAST({count} + 2 AS DECIMAL(19, 0))) div ({words} + 2 * {terms})"


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The triangular divergence of two shares, rounded down. Shares are at most a billion and one, so squares fit 64 bits."""
    return (p - q) * (p - q) // (p + q)


def _pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """lang, i, j, value: the divergences of all terms of a task, added up for the i-th and j-th source of a language, i before j."""
    sums: dict[str, np.ndarray] = {}

    def added() -> pd.DataFrame:
        frames = []
        for lang, matrix in sums.items():
            i, j = np.triu_indices(len(matrix), 1)
            frames.append(pd.DataFrame({"lang": lang, "i": i, "j": j, "value": matrix[i, j]}))
        sums.clear()
        return pd.concat(frames)

    for batch in batches:
        for lang, rows in batch.groupby("lang", sort=False):
            shares = rows["shares"].to_numpy()
            size = len(shares[0])
            if lang not in sums:
                if size * size + sum(m.size for m in sums.values()) > 4 * BLOCK_CELLS and sums:
                    yield added()
                sums[lang] = np.zeros((size, size), dtype=np.int64)
            step = max(1, BLOCK_CELLS // size)
            for at in range(0, len(shares), step):
                block = np.stack(shares[at:at + step]).astype(np.int64).T.copy()
                for i in range(size - 1):
                    sums[lang][i, i + 1:] += divergence(block[i], block[i + 1:]).sum(axis=1)
    if sums:
        yield added()


def skyband(count: np.ndarray, total: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """The places of the terms that fewer than ``k`` others dominate: at least their count, at most their total, earlier as text.

    Terms are taken in an order in which dominators come first. Those dropped need not be compared with, as their own dominators
    dominate whatever they do.
    """
    rank = np.empty(len(term), dtype=np.int64)
    rank[np.argsort(term, kind="stable")] = np.arange(len(term))
    order = np.lexsort((rank, total, -count))
    kept = np.empty(0, dtype=np.int64)
    for at in range(0, len(order), 512):
        block = order[at:at + 512]
        above = _dominators(block, kept, total, rank)
        block, above = block[above < k], above[above < k]
        # inside a block only what comes earlier in the order can dominate
        earlier = np.tril(np.ones((len(block), len(block)), dtype=bool), -1)
        kept = np.concatenate((kept, block[above + _dominators(block, block, total, rank, earlier) < k]))
    return kept


def _dominators(of: np.ndarray, by: np.ndarray, total: np.ndarray, rank: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    over = (total[by][None, :] <= total[of][:, None]) & (rank[by][None, :] < rank[of][:, None])
    return (over if mask is None else over & mask).sum(axis=1)


def _bands(k: int):
    """A function that keeps the skyband of each group of a task: lang, source, term, n, total."""
    def banded(frames: list[pd.DataFrame]) -> pd.DataFrame:
        held = pd.concat(frames, ignore_index=True)
        keep = [rows.index.to_numpy()[skyband(rows["n"].to_numpy(), rows["total"].to_numpy(), rows["term"].to_numpy(dtype=object), k)]
                for _, rows in held.groupby(["lang", "source"], sort=False)]
        return held.loc[np.concatenate(keep)] if keep else held

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames: list[pd.DataFrame] = []
        rows = least = 0
        for batch in batches:
            frames.append(batch)
            rows += len(batch)
            if rows - least > HELD_ROWS:
                frames = [banded(frames)]
                rows = least = len(frames[0])
                if least > HELD_ROWS:
                    yield frames.pop()
                    rows = least = 0
        if frames:
            yield banded(frames)

    return run


def audit_sources(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
                  top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from its others, and by which terms it stands out.

    Terms are runs of letters, A-Z in lower case; a language keeps those in at least ``min_docs`` of its rows. With V of them, a group
    of N occurrences gives a term it holds c times the share 1 + floor(10^9 (c + 2) / (N + 2 V)); the divergence of two shares is
    floor((p - q)^2 / (p + q)). Part ``pair`` gives for each other source the sum over all kept terms, part ``term`` the ``top`` terms a
    source holds whose share is above that of the language. Ranks go by value, then by UTF-8 of the item.

    Null language, source and text are empty text; a group without terms has pairs, and a language without kept terms pairs of value 0.
    Rows that repeat count each. No table is too empty: no rows give no rows. Other columns are not looked at, whatever their names.

    Value grows with the count in the group and falls with the total of the language, so only terms that fewer than ``top`` others
    dominate in both, and in their order as text, can be ranked: each task keeps these for each group, then one task for each group
    merges what the tasks kept. Pairs are the result, the square of the sources of a language; the terms behind them are added up in
    blocks, one matrix a task.
    """
    plain = docs.select(*[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(made)
                          for name, made in ((text, "text"), (lang, "lang"), (source, "source"))])
    kept = stored(kept_terms(plain, min_docs), "kept-terms")
    spread = kept.select("lang", "term", "total", F.explode("counts").alias("source", "n"))

    words = spread.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all_words"))
    groups = plain.select("lang", "source").distinct().join(words, ["lang", "source"], "left_outer").join(sizes, "lang", "left_outer")
    groups = stored(groups.select("lang", "source", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("words", "terms", "all_words")]), "groups")
    listed = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "words"))).alias("sources"),
                                        F.first("terms").alias("terms"), F.first("all_words").alias("all_words"))
    listed = stored(listed, "sources")

    shares = F.expr(f"transform(sources, s -> {share('coalesce(counts[s.source], 0)', 's.words', 'terms')})")
    dense = kept.join(broadcast_if_small(listed.select("lang", "sources", "terms")), "lang").select("lang", shares.alias("shares"))
    sums = dense.mapInPandas(_pair_sums, "lang string, i int, j int, value bigint").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    one = listed.select("lang", "sources", F.posexplode("sources.source").alias("i", "source"))
    pairs = one.select("lang", "i", "source", F.posexplode("sources.source").alias("j", "item")).where("i <> j")
    pairs = pairs.select("lang", "source", "item", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    pairs = pairs.join(sums, ["lang", "i", "j"], "left_outer").select("lang", "source", F.lit("pair").alias("part"), "item",
                                                                      F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))

    schema = "lang string, source string, term string, n bigint, total bigint"
    bands = spread.select("lang", "source", "term", "n", "total").mapInPandas(_bands(top), schema)
    bands = stored(bands.repartition("lang", "source").mapInPandas(_bands(top), schema), "skyband")
    rated = bands.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", F.expr(share("n", "words", "terms")).alias("p"), F.expr(share("total", "all_words", "terms")).alias("q"))
    terms = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    ranked = pairs.unionAll(terms).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
