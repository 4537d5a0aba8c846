"""From raw documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet and reads it again for the next one. All but
the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.components import stored
from granary.llm.language import UNKNOWN, learn_profiles, predict_language
from granary.llm.line_dedup import drop_repeated_lines
from granary.llm.near_dedup import keep_one_of_each
from granary.llm.packing import pack_documents
from granary.llm.queries import PACK_END_ID, PACK_VOCABULARY, vocabulary
from granary.llm.sanitise import sanitise

# What the stages do cannot be said in SQL: learned profiles, sketches, corpus statistics and token ids. Tests compare with brute force.
ORACLE_SQL: str | None = None


def _narrow(docs: DataFrame, *more: str) -> DataFrame:
    """Id, text and ``more``, with all other columns in a struct, so that no name of theirs meets one that an operator uses."""
    rest = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text", *more)]
    return docs.select("doc_id", "text", *more, *([F.struct(*rest).alias("others")] if rest else []))


def _widened(made: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` from what an operator made of its narrow form."""
    return made.select(*[F.col(name) if name in ("doc_id", "text", *more) else F.col(f"others.`{name}`") for name in docs.columns])


def _as_documents(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, unchanged but for text and the number of characters of the text as it is now."""
    whole = _widened(made, docs)
    if "n_chars" in docs.columns:
        whole = whole.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return whole


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; a missing language is filled in, by ``und`` if the table names no language to learn.

    A null text has no letter. Repeated rows stay, columns beside ``lang`` stay as they are whatever their names, an empty table stays empty.
    """
    profiles = learn_profiles(docs)
    found = predict_language(_narrow(docs, "lang"), profiles)
    # without a profile every prediction is unknown, which says nothing about the text
    found = found.where(F.col("lang_pred") != UNKNOWN if profiles.languages else F.rlike("text", F.lit(r"\p{L}")))
    return _widened(found.withColumn("lang", F.coalesce("lang", "lang_pred")), docs, "lang")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them; every document stays, with ``n_chars`` of what is left.

    A null text becomes an empty one. Rows that repeat an id are one document. Other columns stay as they are whatever their names; an empty
    table stays empty.
    """
    return _as_documents(drop_repeated_lines(_narrow(docs)), docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays, once.

    Null and empty texts are copies of each other; a null id is greater than all others. Other columns stay as they are whatever their
    names; an empty table stays empty.
    """
    return _widened(keep_one_of_each(_narrow(docs)), docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are replaced; every document stays, with ``n_chars`` of the text as it is then.

    A null text becomes an empty one. Repeated rows stay, other columns stay as they are whatever their names; an empty table stays empty.
    """
    return _as_documents(sanitise(_narrow(docs)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences whose lengths are powers of two, each from one document, with its other columns in the struct ``others``.

    A null or empty text is a sequence of the end id alone. Repeated rows are packed each for itself; an empty table gives no sequence.
    """
    return pack_documents(_narrow(docs), vocabulary(PACK_VOCABULARY), PACK_END_ID)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("pii", remove_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the documents of one data directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
