"""Near-duplicate documents: DartMinHash sketches, banded joining, exact check, classes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import same_columns
from granary.llm.components import connected_components, stored
from granary.llm.darts import Shingles, band_hashes, portions, shingles, sketch, weighted_jaccard

BANDS = 24
ROWS = 6
WORDS = 5
SIMILARITY = 0.8
FEW = 8
NODES_PER_BLOCK = 1000
BYTES_PER_BLOCK = 16 * 1024 * 1024


def _row_key(doc_id: str, text: str):
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(text))


def sketched(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Columns doc_id, key and text of ``docs`` turned to doc_id, key, the node (fingerprint of its words) and its band hashes.

    The node of a text without words is the fingerprint of the text itself; it has no bands.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, band_rows = [], []
            for part in portions([value or "" for value in batch["text"]]):
                found = shingles(part, words)
                hashes = band_hashes(sketch(found, bands * rows), bands)
                for text, node, values in zip(part, found.contents.view(np.int64).tolist(), hashes):
                    nodes.append(node or int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True))
                    band_rows.append(values if node else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "node": np.array(nodes, dtype=np.int64),
                                "bands": pd.Series(band_rows, dtype=object, index=batch.index)}, index=batch.index)

    return docs.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key bigint, node bigint, bands array<bigint>")


def checked(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """``pairs`` (node, leader) with whether the weighted Jaccard similarity of their shingles reaches ``similarity``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[at:at + 500] for whole in batches for at in range(0, len(whole), 500)):
            made: dict[str, tuple] = {}
            for part in portions(list(dict.fromkeys([*batch["one"], *batch["other"]]))):
                found = shingles(part, words)
                made |= {text: found.of(i) for i, text in enumerate(part)}
            same = [weighted_jaccard(made[one], made[other]) >= similarity for one, other in zip(batch["one"], batch["other"])]
            yield pd.DataFrame({"node": batch["node"], "leader": batch["leader"], "linked": same})

    one = texts.select("node", F.col("text").alias("one"))
    other = texts.select(F.col("node").alias("leader"), F.col("text").alias("other"))
    return pairs.join(one, "node").join(other, "leader").select("node", "leader", "one", "other").mapInPandas(
        run, "node bigint, leader bigint, linked boolean")


def _many(found: Shingles, one: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The weighted Jaccard similarity of one text with each of many."""
    hashes, weights = one
    place = np.minimum(np.searchsorted(hashes, found.hashes), len(hashes) - 1)
    common = np.where(hashes[place] == found.hashes, np.minimum(weights[place], found.weights), 0.0)
    sums = np.add.reduceat(np.stack([common, found.weights]), found.starts[:-1], axis=1)
    return sums[0] / (sums[1] + weights.sum() - sums[0])


def _settled(rest: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """All links between nodes of one bucket but of different components: node, leader.

    ``rest`` holds bucket, node, root and the bytes of the node's text. In each bucket the component with most nodes is not compared with itself; all other nodes
    are, with everything. Both are cut into blocks of bounded size, and each pair of blocks is one group of rows with their texts,
    compared inside its task: what leaves it are links alone, at most one less than the components it holds.
    """
    sizes = rest.groupBy("bucket", "root").agg(F.struct(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")).alias("size"))
    sizes = sizes.groupBy("bucket").agg(F.max_by("root", "size").alias("main"), F.max("size").alias("largest"),
                                        F.sum("size.rows").alias("rows"), F.sum("size.bytes").alias("bytes"))
    # stored, or the join would take over the aggregate's partitions, and those of a large bucket could not be cut
    sizes = stored(sizes, "bucket-sizes")

    def blocks(rows: str, size: str) -> Column:
        return F.ceil(F.greatest(F.expr(rows) / NODES_PER_BLOCK, F.expr(size) / BYTES_PER_BLOCK)).cast("int")

    placed = rest.drop("bytes").join(sizes, "bucket").select(
        "bucket", "node", "root", (F.col("root") != F.col("main")).alias("apart"), blocks("largest.rows", "largest.bytes").alias("mains"),
        blocks("rows - largest.rows", "bytes - largest.bytes").alias("others"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("apart"), F.col("others")).otherwise(F.col("mains"))).cast("int")
    placed = placed.withColumn("own", own)
    main = placed.where("NOT apart").withColumn("other", F.explode(F.expr("sequence(0, others - 1)"))).select(
        "bucket", F.lit(True).alias("with_main"), F.col("own").alias("i"), F.col("other").alias("j"), "node", "root", "apart")
    beside = placed.where("apart").withColumn("other", F.explode(F.expr("sequence(0, mains - 1)"))).select(
        "bucket", F.lit(True).alias("with_main"), F.col("other").alias("i"), F.col("own").alias("j"), "node", "root", "apart")
    among = placed.where("apart").withColumn("other", F.explode(F.expr("sequence(0, others - 1)"))).select(
        "bucket", F.lit(False).alias("with_main"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", "apart")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        nodes, component = group["node"].to_numpy(), group["root"].to_numpy().copy()
        parts = [shingles(part, words) for part in portions(group["text"].tolist())]
        every = [part.of(i) for part in parts for i in range(len(part.contents))]
        links = []
        for i in np.flatnonzero(group["apart"].to_numpy()):
            if (component == component[i]).all():
                continue
            similar = np.concatenate([_many(part, every[i]) for part in parts]) >= similarity
            # one link joins two components, further ones say nothing new
            for j in np.flatnonzero(similar & (component != component[i])):
                if component[j] != component[i]:
                    links.append((nodes[i], nodes[j]))
                    component[component == component[j]] = component[i]
        return pd.DataFrame(links, columns=["node", "leader"], dtype="int64")

    groups = main.unionAll(beside).unionAll(among).join(texts, "node")
    return groups.groupBy("bucket", "with_main", "i", "j").applyInPandas(compare, "node bigint, leader bigint").distinct()


def _linked_nodes(buckets: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Node and root of the components that the comparisons within buckets give.

    First one node of each bucket leads it, the one that meets most others: one aggregate, whatever the bucket's size. A bucket whose
    nodes are then in one component is settled. In the others all pairs of different components are compared.
    """
    sizes = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    met = buckets.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("met"))
    met = met.join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
    # the sum leads, a hash settles ties: a single number, which an aggregate by hash can hold
    turn = F.shiftleft(F.col("met"), 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    ranked = stored(buckets.join(met, "node").select("bucket", "node", turn.alias("turn"), "bytes").join(sizes, "bucket"), "ranked")
    first = stored(ranked.groupBy("bucket").agg(F.max_by("node", "turn").alias("leader")), "leaders")
    pairs = ranked.join(first, "bucket").where("node <> leader").select("node", "leader").distinct()
    links = stored(checked(pairs, texts, words, similarity), "checked").where("linked").select("node", "leader")
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("leader").alias("b")))
    named = ranked.drop("turn").join(roots, "node", "left_outer").withColumn("root", F.coalesce("root", "node"))
    several = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    # a bucket of two has been compared
    several = stored(several.select("bucket"), "unsettled-buckets")
    rest = stored(named.where("n > 2").join(several, "bucket"), "unsettled")
    if rest.isEmpty():
        return roots
    few = rest.where(F.col("n") <= FEW)
    other = few.select("bucket", F.col("node").alias("leader"), F.col("root").alias("other"))
    apart = few.join(other, "bucket").where("root <> other AND node < leader").select("node", "leader").distinct()
    more = stored(checked(apart, texts, words, similarity), "checked").where("linked").select("node", "leader")
    many = stored(_settled(rest.where(F.col("n") > FEW).drop("n"), texts, words, similarity), "settled")
    links = links.unionAll(more).unionAll(many)
    return connected_components(links.select(F.col("node").alias("a"), F.col("leader").alias("b")))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bands: int = BANDS, rows: int = ROWS, words: int = WORDS,
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, key (of the row), class_id (the smallest doc_id of its class) and kept (the one row kind that stays).

    Two documents are linked if the weighted Jaccard similarity of their shingles (``words`` words, weighted by their counts) is at
    least ``similarity``; classes are the connected components. Exact copies, up to case and punctuation, meet by the fingerprint of
    their words and travel as one node, however many there are. Nodes are sketched by thrown darts, and nodes that agree in all
    ranks of a band share a bucket. In each bucket every node is compared, by its whole text, with one leader. Where that leaves a
    bucket in several components, all its pairs of different components are compared, in blocks of bounded size. So a bucket of copies
    costs one comparison per node, and no link within a bucket that could join two components is lost.

    Documents without a word are one class if their texts are equal; a null text is an empty one. Rows that repeat an id and text are
    one kind: they have the same key and the same answer. A null id is greater than all others. An empty table gives no rows. Other
    columns are left out. Fingerprints have 64 bits.
    """
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = named.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", _row_key("doc_id", "text"))
    found = stored(sketched(keyed, bands, rows, words), "sketches")
    worded = found.where("bands IS NOT NULL")
    # copies have equal bands, so any row of a node stands for all
    single = worded.groupBy("node").agg(F.first("bands").alias("bands"))
    buckets = single.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", F.xxhash64("band", "value").alias("bucket"))
    sizes = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared-buckets")
    buckets = stored(buckets.join(sizes, "bucket"), "buckets")
    nodes = worded.groupBy("node").agg(F.min("key").alias("key")).join(buckets.select("node").distinct(), "node")
    texts = stored(keyed.select("key", "text").join(nodes, "key").groupBy("node").agg(F.min("text").alias("text")), "texts")
    roots = _linked_nodes(buckets, texts, words, similarity)

    # a null id sorts last: the flag comes first in the order of rows
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    firsts = found.groupBy("node").agg(F.min(row).alias("first"))
    firsts = firsts.join(roots, "node", "left_outer").withColumn("root", F.coalesce("root", "node"))
    best = firsts.groupBy("root").agg(F.min("first").alias("best"))
    classes = firsts.join(best, "root").select("node", F.col("best.doc_id").alias("class_id"), F.col("best.key").alias("class_key"))
    joined = found.join(classes, "node")
    return joined.select("doc_id", "key", "class_id", (F.col("key") == F.col("class_key")).alias("kept"))


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without near-duplicates: of each class the document with the smallest id stays, once; all its columns are kept."""
    found = near_duplicates(docs, text, doc_id, **options)
    gone = found.where("NOT kept").select(F.col("key").alias("_gone")).distinct()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.withColumn("_row_text", whole).withColumn("_row_key", _row_key(f"`{doc_id}`", "_row_text"))
    kept = rows.join(gone, F.col("_row_key") == F.col("_gone"), "left_anti")
    # rows that repeat id and text have one key
    return same_columns(kept.dropDuplicates(["_row_key"]), docs.columns)
