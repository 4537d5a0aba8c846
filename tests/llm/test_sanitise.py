import hashlib
import math
import random
import re
from collections import defaultdict

from granary.llm.queries import QUERIES
from granary.llm.sanitise import revealing_terms, sanitise
from tests.llm.brute import personal, redacted

ODD = [
    "a@b.c_d@e.f.g, x@y z@-.-. @no.pe", "1.2.3.4.5 256.1.1.1 0000001.2.3.004 1.2.3.99999999999 1..2.3.4 9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 12345678901234567890 0000000000000", "+1 (555) 123-4567, +49 30 1 +12345678901234567 ++33123456789 +(1)",
    "é@x.fr über 4222222222222 ü +44 20 7946 0958.", "4111 1111 1111 1111@mail.example.com +41 4111 1111 1111 1111", "", "no data here at all",
    "x" * 20_000 + "@y.zz" + " 1.1.1.1" * 300, "a@b" + ".c" * 5000,
]


def test_base_spans_equal_brute_force(spark):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(99, None), (0, ODD[0]), (None, ODD[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = sanitise(docs).collect()
    assert len(made) == len(rows)
    by_id = {r.doc_id: r for r in made}
    for i, text in rows:
        found, plain = by_id[i], text or ""
        spans = personal(plain)
        assert [(s.kind, s.start, s.end) for s in found.base_spans] == spans
        assert [s.value for s in found.spans] == [plain[start:end] for _, start, end in spans]
        assert [found.n_email, found.n_ip, found.n_card, found.n_phone] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert found.text == redacted(plain, spans)


def corpus():
    """A name that keeps company with one address in different texts, common words, and an address that stands in copies only."""
    rows = [(i, f"Note {'abcdefgh'[i]}x: please ask Zorbanski at mail z.orb@corp.example.org about the {'plans reports bills notes'.split()[i % 4]}.")
            for i in range(6)]
    rows += [(10 + i, f"please ask the team about the plans and reports number {'xyz'[i % 3]}{'uvw'[i % 2]}") for i in range(60)]
    rows += [(100 + i, "Copied: Quillfeather writes from q@copy.example.org today") for i in range(5)]
    rows += [(200, "zorbanski was seen elsewhere. (Zorbanski)"), (201, None)]
    return rows


def slow_words(text):
    """The different words of a text, by plain expressions, with what the patterns of entities can cover out of the way."""
    covered = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+" \
              r"|(?<![0-9])[0-9](?:[ -]?[0-9]){12,}|\+[0-9][ ().0-9-]+[0-9]"
    word = r"(?<![^\s(\"'“„«])[^\W_]+(?:['’_-][^\W_]+)*(?![^\W_]|['’_-][^\W_])(?=[\s,;:!?)\"'”»]|\.(?:\s|$)|$)"
    found = (m.group() for m in re.finditer(word, re.sub(covered, "@", text).lower()))
    return {w for w in found if len(w) >= 2}


def slow_terms(rows, min_texts=3, generalise_at=0.8, remove_at=0.95):
    """What becomes of each word, with all counts by plain loops over whole texts."""
    met, texts, holding, frequency = defaultdict(int), defaultdict(set), defaultdict(int), defaultdict(int)
    for _, text in rows:
        text = text or ""
        entities = {f"{kind}:{text[a:b].lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', text[a:b])}" for kind, a, b in personal(text)}
        words = slow_words(text)
        for entity in entities:
            holding[entity] += 1
            for word in words:
                met[entity, word] += 1
                texts[entity, word].add(text)
        for word in words:
            frequency[word] += 1
    best = {}
    for (entity, word), both in met.items():
        if len(texts[entity, word]) >= min_texts:
            share = 1 - math.log2(both / frequency[word]) / math.log2(holding[entity] / len(rows))
            best[word] = min(best.get(word, (0, "")), (-share, entity.split(":")[0]))
    return {word: "remove" if -less >= remove_at else f"{kind}_term" for word, (less, kind) in best.items() if -less >= generalise_at}


def test_revealing_terms_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = slow_terms(rows)
    assert "zorbanski" in expected and "please" not in expected and "quillfeather" not in expected
    found = {r.term: r.action for r in revealing_terms(docs.selectExpr("coalesce(text, '') as text")).collect()}
    assert found == expected
    lower = {r.term: r.action for r in revealing_terms(docs.selectExpr("coalesce(text, '') as text"), generalise_at=0.5, remove_at=0.97).collect()}
    assert lower == slow_terms(rows, generalise_at=0.5, remove_at=0.97) and {"remove", "email_term"} <= set(lower.values())


def test_far_names_and_names_with_digits_are_found(spark):
    filler = [" ".join(f"word{(i * 7 + j) % 50}x" for j in range(120)) for i in range(40)]
    rows = [(i, f"Dear Mrs O'Brannigan-{'x' * 2}, {filler[i]} regards user7-x {filler[i + 1]} call +1 555 010 9999 today.\nAccount AB12, 10.0.0.7") for i in range(4)]
    rows += [(10 + i, filler[i]) for i in range(40)] + [(60, "user7-x and O'Brannigan-xx wrote to AB12.")]
    found = {r.term: r.action for r in revealing_terms(spark.createDataFrame(rows, "doc_id long, text string").select("text")).collect()}
    assert found == slow_terms(rows) and {"o'brannigan-xx", "user7-x", "ab12"} <= set(found)
    made = {r.doc_id: r for r in sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(name in r.text for r in made.values() for name in ("user7", "Brannigan", "AB12"))
    assert made[60].text == " and  wrote to ." if found["ab12"] == "remove" else "_TERM]" in made[60].text


def test_random_texts_equal_brute_force(spark):
    draw = random.Random(5)
    parts = ["a@b.cd", "x.y@z.org", "10.1.2.3", "4111 1111 1111 1111", "+49 30 1234567"] + [f"w{i}" for i in range(40)] + ["don't", "x-y", "-a-", "7", "2024", "it's,", "ÄÖ.", "a_b"]
    rows = [(i, draw.choice([" ", "\n"]).join(draw.choices(parts, k=draw.randint(0, 25)))) for i in range(150)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)] + [(5000, None), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for at in (0.3, 0.5):
        found = {r.term: r.action for r in revealing_terms(docs.selectExpr("coalesce(text, '') as text"), 3, at, 0.6).collect()}
        assert found == slow_terms(rows, 3, at, 0.6) and found


def test_many_spans_keep_their_places(spark):
    text = " ".join(f"m{i}@host.org" for i in range(3000))
    made = sanitise(spark.createDataFrame([(1, text)], "doc_id long, text string")).head()
    assert [(s.kind, s.start, s.end) for s in made.base_spans] == personal(text) and made.n_email == 3000


def test_terms_are_replaced_wherever_they_stand(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "'k' as lang")
    made = sanitise(docs)
    assert made.columns == ["doc_id", "lang", "text", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"]
    by_id = {r.doc_id: r for r in made.collect()}
    assert len(by_id) == len(rows)
    action = slow_terms(rows)["zorbanski"]
    assert [(s.kind, s.start, s.end) for s in by_id[200].spans] == [(action, 0, 9), (action, 31, 40)]
    assert "orbanski" not in "".join(r.text for r in by_id.values())
    for i, text in rows:
        spans = [(s.kind, s.start, s.end) for s in by_id[i].spans]
        assert by_id[i].text == redacted(text or "", spans) and spans[:len(by_id[i].base_spans)] == personal(text or "")
    assert by_id[100].text == "Copied: Quillfeather writes from [EMAIL] today" and by_id[10].spans == []


def test_empty_table(spark):
    assert sanitise(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_digests(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op4_pii"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        joined = ",".join(f"{kind}:{start}:{end}" for kind, start, end in personal(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined or r.spans.startswith(joined)


def test_plan_has_no_python(spark, data):
    made = sanitise(spark.read.parquet(f"{data}/documents.parquet"))
    text = made._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
