"""Personal data: patterns with positions, and words that give a protected entity away by the company they keep.

DataFrame functions only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import hash128, others
from granary.llm.components import stored

# The patterns as stated, with groups that give nothing back where giving back could not lead to a match.
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
# A word with white space, a quote or a bracket before it and an end of word behind it.
WORD = r"(?<![^\s(\"'“„«])%s(?=[\s,;:!?)\"'”»]|\.(?:\s|$)|$)"
# At least two letters or digits, with single hyphens, apostrophes and underscores inside.
ANY_WORD = WORD % r"(?=[\p{L}\p{N}]['’_-]?+[\p{L}\p{N}])[\p{L}\p{N}]++(?:['’_-][\p{L}\p{N}]++)*+"
# What the patterns above can match, checked or not, from the first character at which they can begin; shorter numbers are words.
COVERED = (r"(?<![A-Za-z0-9._%+-])" + EMAIL, r"(?<![0-9])" + IP, r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+", PHONE)

MIN_TEXTS = 3
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
FILTER_WORDS = 8192
CHUNK = 256
SPAN = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"
MADE = ("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans")


def _matches(text: Column, pattern: Column, kind: str) -> Column:
    """All matches of a pattern, leftmost first and not overlapping, with their positions in code points.

    The text between the matches gives the positions; text and matches are each found once.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))

    def step(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["match"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("value"))
        longer = F.struct(end.alias("at"), F.concat(so_far["found"], F.array(span)).alias("found"))
        return F.when(pair["match"].isNull(), so_far).otherwise(longer)

    def moved(so_far: Column, chunk: Column) -> Column:
        spans = F.transform(chunk["found"], lambda s: F.struct(
            s["kind"].alias("kind"), (s["start"] + so_far["at"]).alias("start"), (s["end"] + so_far["at"]).alias("end"), s["value"].alias("value")))
        return F.struct((so_far["at"] + chunk["at"]).alias("at"), F.concat(so_far["found"], F.array(spans)).alias("found"))

    # appending to an array copies it, so spans are gathered chunk by chunk, with places counted from the chunk's begin
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("found"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")),
                         lambda i: F.aggregate(F.slice(pairs, i * CHUNK + 1, CHUNK), begin, step))
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))
    return F.aggregate(chunks, none, moved, lambda so_far: F.flatten(so_far["found"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(span: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.char_length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(span["value"], r"\."), small)


def _is_card(span: Column) -> Column:
    digits = F.reverse(_digits(span["value"]))
    size = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    passes = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0
    return F.when(size.between(13, 19), passes).otherwise(False)


def _is_phone(span: Column) -> Column:
    return F.char_length(_digits(span["value"])).between(9, 15)


def base_spans(text: Column) -> Column:
    """Emails, addresses, cards and phones of a text, by kind and then by start. A match that fails its check is dropped."""
    none = F.array().cast(SPAN)
    email = F.when(F.contains(text, F.lit("@")), _matches(text, F.lit(EMAIL), "email")).otherwise(none)
    digits = F.rlike(text, F.lit("[0-9]"))
    ip = F.when(digits, F.filter(_matches(text, F.lit(IP), "ip"), _is_ip)).otherwise(none)
    card = F.when(digits, F.filter(_matches(text, F.lit(CARD), "card"), _is_card)).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), F.filter(_matches(text, F.lit(PHONE), "phone"), _is_phone)).otherwise(none)
    return F.concat(email, ip, card, phone)


def _entity(span: Column) -> Column:
    """One spelling for each entity: lower case, and digits alone for cards and phones."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), plain)


def _entities(text: Column) -> Column:
    """The different entities of a text, in one spelling each."""
    return F.array_sort(F.array_distinct(F.transform(base_spans(text), _entity)))


def _words(text: Column) -> Column:
    """The different words of a text in lower case, without what the patterns of protected entities cover."""
    covered = F.regexp_replace(text, "|".join(f"(?:{pattern})" for pattern in COVERED), "@")
    bare = F.when(F.rlike(text, F.lit("[0-9@]")), covered).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(ANY_WORD), F.lit(0)))


def _fixed_size_filter(terms: DataFrame) -> np.ndarray:
    """A bit for the hash of each term, in ``FILTER_WORDS`` numbers whatever their count: what it lets through is joined exactly."""
    place = F.pmod(F.xxhash64("term"), F.lit(64 * FILTER_WORDS))
    words = terms.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(term), 64) as int))")).alias("bits"))
    bits = np.zeros(FILTER_WORDS, dtype=np.int64)
    for row in words.collect():
        bits[row["word"]] = row["bits"]
    return bits


def _words_among(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The different words of each text that may be among ``terms``; one row for each."""
    bits = F.lit(_fixed_size_filter(terms))
    words = texts.select(*texts.columns, F.explode(_words(F.col("text"))).alias("term"))
    place = F.pmod(F.xxhash64("term"), F.lit(64 * FILTER_WORDS))
    here = F.get(bits, F.shiftright(place, 6).cast("int"))
    return words.where(F.getbit(here, F.pmod(F.xxhash64("term"), F.lit(64)).cast("int")) == 1)


def revealing_terms(texts: DataFrame, min_texts: int = MIN_TEXTS, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """Words that give a protected entity away: term, disclosure and action (the kind of span that replaces them).

    The entities are the base spans. A word and an entity meet in every document that holds both, however far apart. With ``P(e)``
    the share of all documents with the entity and ``P(e|t)`` the share of those with word ``t`` that hold ``e``, the disclosure is
    the part of the entity's information that the word supplies: ``1 - log P(e|t) / log P(e)``. A pair counts if it is seen in at
    least ``min_texts`` different texts, so copies of one text prove nothing. Counts cover all rows. The action is ``remove`` or, from
    ``generalise_at`` on, the kind of the entity that the word reveals most of (the first by name among equals), as ``email_term``.

    A word in more than ``P(e) ** (generalise_at - 1)`` times as many documents as its entity cannot reach ``generalise_at``: such
    pairs are left out before they are counted, which loses none.
    """
    h1, h2 = hash128(F.col("text"))
    whole = texts.select("text", h1.alias("h1"), h2.alias("h2"))
    likely = whole.where(F.rlike("text", F.lit("[0-9@+]")))
    total = texts.count()
    # the copies of a text are one row with their number
    holders = likely.select("h1", "h2", _entities(F.col("text")).alias("entities")).where(F.size("entities") > 0)
    holders = stored(holders.groupBy("h1", "h2", "entities").agg(F.count(F.lit(1)).alias("rows")), "holders")
    held = holders.select("h1", "h2", "rows", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.sum("rows").alias("holding"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts)
    # rounded up a little, as the exact rating follows
    limit = F.col("holding") * F.pow(F.lit(float(total)) / F.col("holding"), F.lit(1.0 - generalise_at)) * 1.000001
    entities = stored(entities.select("entity", "holding", limit.alias("limit")), "entities")
    # the entities of one text, so bounded by its length
    asked = held.join(entities, "entity").groupBy("h1", "h2").agg(
        F.first("rows").alias("rows"), F.max("limit").alias("limit"), F.collect_list(F.struct("entity", "holding", "limit")).alias("entities"))
    asked = stored(asked, "asked")

    words = likely.join(asked.select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", F.explode(_words(F.col("text"))).alias("term")).distinct()
    words = stored(words, "words")
    # a pair needs so many texts, so its word does; only what is left is counted in the whole corpus
    candidates = stored(words.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts).select("term"), "candidates")
    frequency = _words_among(texts.select("text"), candidates).groupBy("term").agg(F.count(F.lit(1)).alias("in_rows"))
    frequency = stored(frequency.join(candidates, "term"), "frequency")
    met = words.join(frequency, "term").join(asked, ["h1", "h2"]).where(F.col("in_rows") <= F.col("limit"))
    met = met.select("term", "in_rows", "rows", F.explode("entities").alias("e")).where(F.col("in_rows") <= F.col("e.limit"))
    pairs = met.groupBy(F.col("e.entity").alias("entity"), "term", F.col("e.holding").alias("holding"), "in_rows").agg(
        F.sum("rows").alias("both"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts)
    share = -F.log2(F.col("both") / F.col("in_rows"))
    whole_share = -F.log2(F.col("holding") / F.lit(total))
    rated = pairs.withColumn("disclosure", F.when(whole_share > 0, 1 - share / whole_share).otherwise(0.0)).where(F.col("disclosure") >= generalise_at)
    kind = F.substring_index("entity", ":", 1)
    # the greatest disclosure, then the least kind
    best = rated.groupBy("term", kind.alias("kind")).agg(F.max("disclosure").alias("disclosure")).groupBy("term").agg(
        F.min(F.struct((-F.col("disclosure")).alias("less"), "kind")).alias("best"))
    best = best.select("term", (-F.col("best.less")).alias("disclosure"), F.col("best.kind").alias("kind"))
    action = F.when(F.col("disclosure") >= remove_at, "remove").otherwise(F.concat("kind", F.lit("_term")))
    return stored(best.select("term", "disclosure", action.alias("action")), "terms")


def _count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _clear_of(spans: Column, base: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def _redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets, or by nothing if it is to be removed; overlapping spans become one."""
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(so_far: Column, span: Column) -> Column:
        gap = F.substring(text, (so_far["at"] + 1).cast("int"), (span["start"] - so_far["at"]).cast("int"))
        mark = F.when(span["kind"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        apart = F.struct(span["end"].alias("at"), F.concat(so_far["parts"], F.array(gap, mark)).alias("parts"))
        joined = F.struct(F.greatest(so_far["at"], span["end"]).alias("at"), so_far["parts"].alias("parts"))
        return F.when(span["start"] >= so_far["at"], apart).otherwise(joined)

    order = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], (a["start"] - b["start"]).cast("int")).otherwise((b["end"] - a["end"]).cast("int")))
    done = F.aggregate(order, begin, step, lambda so_far: F.concat(F.array_join(so_far["parts"], ""), F.substring(text, (so_far["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def sanitise(docs: DataFrame, text: str = "text", min_texts: int = MIN_TEXTS, generalise_at: float = GENERALISE_AT,
             remove_at: float = REMOVE_AT) -> DataFrame:
    """Find personal data in every text and replace it.

    Adds ``base_spans`` (kind, start, end, value of emails, addresses, cards and phones), ``spans`` (these, then the words that give
    an entity away, as kind ``remove`` or ``email_term``, ``ip_term``, ``card_term``, ``phone_term``), and a count for each base kind. In
    ``text`` a base span becomes its kind in brackets; a revealing word becomes the broader ``[EMAIL_TERM]``, which says what kind of entity it
    reveals, or nothing. Revealing words are replaced wherever they stand, also where the
    entity is not named, but not inside a base span; letter case does not matter.

    Positions are code points, ends exclusive. Texts are read whole, however long they are. A null text counts as empty and becomes empty. Repeated rows are treated alike, all
    rows stay, an empty table gives an empty result, and a column named like an added one gives way.
    """
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    terms = revealing_terms(texts, min_texts, generalise_at, remove_at)
    h1, h2 = hash128(F.col("text"))
    hit = _words_among(texts.select("text", h1.alias("h1"), h2.alias("h2")), terms.select("term"))
    hit = hit.select("h1", "h2", "term").distinct().join(terms, "term").groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("term", "action"))).alias("_revealing"))

    # a table of its own, so that the copies of one text can be cut in the join
    hit = stored(hit, "hits")

    rows = docs.select(*others(docs, (text, *MADE)), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_plain"))
    h1, h2 = hash128(F.col("_plain"))
    rows = rows.withColumns({"_h1": h1, "_h2": h2})
    # the hits grow with the corpus, so they are never broadcast: the plan is the same at every size
    joined = rows.join(hit.hint("merge"), (rows["_h1"] == hit["h1"]) & (rows["_h2"] == hit["h2"]), "left_outer")
    found = joined.withColumn("base_spans", base_spans(F.col("_plain")))

    before, behind = WORD.split("%s")
    words = F.concat(F.lit(f"(?iu){before}(?:"), F.array_join(F.col("_revealing.term"), "|"), F.lit(f"){behind}"))
    actions = F.map_from_entries("_revealing")
    # a spelling that only the pattern takes for the word is removed
    named = F.transform(_clear_of(_matches(F.col("_plain"), words, "remove"), F.col("base_spans")), lambda s: F.struct(
        F.coalesce(F.try_element_at(actions, F.lower(s["value"])), F.lit("remove")).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    found = found.withColumn("spans", F.concat("base_spans", F.when(F.col("_revealing").isNotNull(), named).otherwise(F.array().cast(SPAN))))
    counts = [_count_of("base_spans", kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(*others(docs, (text, *MADE)), _redacted(F.col("_plain"), F.col("spans")).alias(text), *counts, "base_spans", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
