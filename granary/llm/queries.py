"""The registered queries of the operators in this subpackage, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.bitsliced import exact_top_k
from granary.llm.common import is_held_out
from granary.llm.divergence import audit_sources
from granary.llm.graph_search import nearest
from granary.llm.html_text import main_text
from granary.llm.language import learn_profiles, predict_language
from granary.llm.line_dedup import drop_repeated_lines
from granary.llm.near_dedup import near_duplicates
from granary.llm.packing import pack_documents
from granary.llm.runs import periodic_runs
from granary.llm.sanitise import sanitise, span_text
from granary.llm.sharding import even_tree, place_documents
from granary.llm.toxicity import learn_toxicity, score_toxicity
from granary.llm.unigram import decode_ids, encode_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PACK_VOCABULARY = "word_bpe_49k.json"
PACK_END_ID = 2
PIECES = "piece_bpe_32k.model"


def _query(sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


def vocabulary(name: str) -> str:
    """The path of a public vocabulary; deployments without the package pass their own path to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


@_query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_documents(spark, sf_dir, "doc_id", "text"), vocabulary(PACK_VOCABULARY), PACK_END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query("""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         p AS (SELECT q.vec_id AS query_id, c.vec_id,
                      CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
               FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op7_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return exact_top_k(vectors, F.col("vec_id") % 20 == 0)


@_query(r"""
    WITH l AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
         e AS (SELECT doc_id, text, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM l),
         k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
         r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
         m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first AS gone FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id, text""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(_documents(spark, sf_dir, "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    held_out = is_held_out(F.col("doc_id"))
    profiles = learn_profiles(docs.where(~held_out))
    return predict_language(docs.select("doc_id", "text", held_out.alias("held_out")), profiles).select(
        "doc_id", "held_out", "lang_pred", "score")


@_query()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "class_id", "kept")


@_query()
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"), F.sha2("text", 256).alias("clean_sha256"))


@_query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~is_held_out(F.col("doc_id")))
    model = learn_toxicity(docs, labels)
    return score_toxicity(docs.withColumn("held_out", is_held_out(F.col("doc_id"))), model).select("doc_id", "held_out", "score", "predicted")


@_query()
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@_query()
def op5_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 20 == 0)


@_query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(PIECES)
    decoded = decode_ids(encode_texts(_documents(spark, sf_dir, "doc_id", "text"), path), path)
    return decoded.select("doc_id", F.shiftright(F.octet_length("ids"), 2).cast("bigint").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
                          (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@_query(r"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
         w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
         t AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
         k AS (SELECT lang, term, sum(n) AS total FROM t GROUP BY ALL HAVING sum(docs) >= 10),
         v AS (SELECT l.lang, count(k.term) AS terms, coalesce(sum(k.total), 0) AS words FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k USING (lang)
               GROUP BY l.lang),
         o AS (SELECT lang, source, sum(n) AS words FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
         g AS (SELECT s.lang, s.source, coalesce(o.words, 0) AS words FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN o USING (lang, source)),
         p AS (SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n,
                      CAST(1 + (1000000000::HUGEINT * (coalesce(t.n, 0) + 2)) // (g.words + 2 * v.terms) AS BIGINT) AS p,
                      CAST(1 + (1000000000::HUGEINT * (k.total + 2)) // (v.words + 2 * v.terms) AS BIGINT) AS q
               FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
         f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
         r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
               UNION ALL
               SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
         x AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
    SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM x WHERE part = 'pair' OR rank <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(_documents(spark, sf_dir, "text", "lang", "source")).select("lang", "source", "part", "item", "value", "rank")


SHARDS, REGIONS, RACKS = 40, 5, 2


@_query()
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = place_documents(_documents(spark, sf_dir, "doc_id", "text"), even_tree(SHARDS, REGIONS, RACKS))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_cycles(doc_id: Column, text: Column) -> Column:
    """The texts of the contract: in a tenth of the documents the words from a place on come again and again."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, words = (h - h % 10) / 10, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def cycled(w: Column) -> Column:
        n = F.size(w)
        first = F.pmod(g.cast("bigint"), F.greatest(n, F.lit(1))).cast("int")
        times = (g.cast("bigint") % 8).cast("int") + 3
        left = n - first
        period = ((left - left % times) / times).cast("int") + 1
        return F.slice(F.concat(F.slice(w, F.lit(1), first), F.flatten(F.array_repeat(F.slice(w, first + 1, period), times))), F.lit(1), n)

    # words are bound once, by the outer function
    return F.when((h % 10 == 0) & text.isNotNull(), F.array_join(F.transform(F.array(words), cycled)[0], " ")).otherwise(text)


@_query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    found = periodic_runs(docs.select("doc_id", with_cycles(F.col("doc_id"), F.col("text")).alias("text")))
    # of equal powers the first run stays, which has the least start and then the least period
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                    lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    power = 1000 * F.col("best.length")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        ((power - power % F.col("best.period")) / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
