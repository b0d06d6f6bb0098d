"""Personal data: base spans against the patterns as given, and terms that reveal an entity."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from plumbline.llm.sanitise import listed, personal_spans, sanitise

SCHEMA = "doc_id long, text string"
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(GIVEN.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "", re.ASCII) if kind == "email" or passes(kind, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_spans_match_the_given_patterns(frame):
    random.seed(5)
    bits = ["a@b.co", "x%y@", "@", ".", "1.2.3.4", "300.1.1.1", "007.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+", "12", "-", " ", "é", "😀", "\n", "_", "5500005555555559", "word", "a.b-c", "(", ")"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "1" * 30_000, "a" * 30_000, "1 " * 20_000, "+" * 5000, "a@b.c" * 500, "9.9" * 3000]
    rows = list(enumerate(texts))
    spans = personal_spans(frame(rows, SCHEMA), support=10**9)
    got = {r.doc_id: r.s for r in spans.select("doc_id", listed(F.col("spans")).alias("s")).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_terms_beside_an_entity_are_generalised_or_removed(frame):
    rows = [(i, f"plain words of everyone by number at {i}") for i in range(200)]
    rows += [(1000 + i, f"plain words by Quillfeather at quill@mail.example.com of everyone {i}") for i in range(3)]
    rows += [(2000, "Quillfeather said words"), (3000, None), (None, "see quill@mail.example.com")]
    frame_ = frame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, spans int, row_key string")
    got = {r.doc_id: r.text for r in sanitise(frame_).collect()}
    assert got[1000] == "plain words by [TERM] at [EMAIL] of everyone 0"
    assert got[2000] == "Quillfeather said words" and got[3] == rows[3][1] and got[3000] is None and got[None] == "see [EMAIL]"
    assert sanitise(frame_).columns == frame_.columns


def test_empty_table_and_repeated_rows(frame):
    assert personal_spans(frame([], SCHEMA)).collect() == []
    assert len(personal_spans(frame([(1, "a@b.co"), (1, "a@b.co"), (1, "c")], SCHEMA)).collect()) == 3
    assert sorted(r.text for r in sanitise(frame([(1, "a@b.co"), (1, "a@b.co"), (1, "c")], SCHEMA)).collect()) == ["[EMAIL]", "[EMAIL]", "c"]


def test_copies_count_once(frame):
    rows = [(i, f"plain words of everyone by number at {i}") for i in range(200)]
    rows += [(1000 + i, f"plain words by Quillfeather at quill@mail.example.com of everyone {i % 4}") for i in range(120)]
    got = {r.text for r in sanitise(frame(rows, SCHEMA)).where("doc_id >= 1000").collect()}
    assert got == {f"plain words by  at [EMAIL] of everyone {i}" for i in range(4)}


def test_far_terms_and_all_their_places_in_texts_that_hold_the_entity(frame):
    far = " ".join(["plain words of everyone"] * 20)
    rows = [(i, f"plain words of everyone by number at {i}") for i in range(200)]
    rows += [(1000 + i, f"Quillfeather {far} quill@mail.example.com {far} Quillfeather, {i}") for i in range(4)]
    got = {r.text for r in sanitise(frame(rows, SCHEMA)).where("doc_id >= 1000").collect()}
    assert got == {f" {far} [EMAIL] {far} , {i}" for i in range(4)}


def test_columns_of_any_name_keep_their_values(spark):
    """Also names that the work itself uses."""
    schema = "doc_id long, row_key string, row_spans int, spans string, _row0 string, _key0 int, _own_spans0 string, entities string, text string, `a.b` int"
    rows = [(1, "mine", 5, "s", "r", 7, "o", "e", "mail me at jo@x.org", 3), (2, None, None, None, None, None, None, None, None, None)]
    got = {r["doc_id"]: r for r in sanitise(spark.createDataFrame(rows, schema)).collect()}
    assert tuple(got[2]) == rows[1]
    assert tuple(got[1]) == (*rows[0][:8], "mail me at [EMAIL]", 3)


def test_places_of_many_matches(spark):
    import re

    from pyspark.sql import functions as F

    from plumbline.llm.sanitise import WORD, _places

    texts = ["", "x", "no é \U0001f600 word " * 70, " ".join(f"w{'ab' * (i % 3 + 1)}" for i in range(1000)), "aa " * 64, "aa " * 65, "1 2 3"]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select("text", _places(F.col("text"), WORD).alias("p")).collect()
    for r in found:
        expected = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W\d_]{2,}", r["text"])]
        assert [tuple(s) for s in r["p"]] == expected
