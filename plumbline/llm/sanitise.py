"""Personal data: base patterns, and terms that give a protected entity away (information-theoretic sanitisation).

Base spans are e-mail addresses, IP addresses, card numbers and telephone numbers. Each distinct value is a protected
entity. A term is any word of two letters or more in a text that holds the entity. The corpus tells how much it reveals:

    disclosure(t, e) = PMI(t; e) / IC(e) = log(N c(t, e) / (df(t) df(e))) / log(N / df(e))

with N different texts, df(e) that hold the entity, df(t) that hold the term, and c(t, e) that hold both. All four count
whole texts by their hashes, so that copies of a document count once. It is 1 if a term occurs nowhere but together with
the entity, and about 0 if the two are independent. Terms seen together with an entity in at least ``support`` different
texts are removed at a disclosure of ``remove`` and generalised from ``generalise`` on, at all their places in the texts
that hold the entity. Everything is DataFrame work: regular expressions, arrays, counts and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.lineage import written

# The base patterns. Possessive quantifiers and the conditions in front only save time and stack: a match can
# start inside a run of its own characters only where the match before it ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = ("email", "ip", "card", "phone", "term")
#: What a text must hold for a pattern to be worth trying.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
WORD = r"\p{L}[\p{L}\p{M}]++"
BROADCAST_TERMS = 200_000
#: Matches whose places are summed up together.
PART = 64

SPAN = "struct<start:int,end:int,value:string>"


def _places(text: Column, pattern: str) -> Column:
    """Start, end (code points) and value of every match: lengths of matches and of what lies between them, summed up.

    Sums run over parts of PART matches, whose own sums are taken first, so that long texts take time in proportion.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("found"), F.slice(between, F.lit(1), F.size(found)).alias("between"))
    size = lambda x: F.length(x["between"]) + F.length(x["found"])

    def in_parts(pairs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / PART).cast("int"))
        parts = F.transform(numbers, lambda k: F.slice(pairs, k * PART + 1, F.lit(PART)))
        return F.transform(parts, lambda part: F.struct(part.alias("pairs"), F.aggregate(part, F.lit(0), lambda n, x: n + size(x)).alias("size")))

    def before(done: Column, part: Column) -> Column:
        return F.struct((done["at"] + part["size"]).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts"))

    def add(done: Column, x: Column) -> Column:
        begin = done["at"] + F.length(x["between"])
        end = begin + F.length(x["found"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["found"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    def placed(parts: Column) -> Column:
        starts = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), before, lambda done: done["starts"])
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.flatten(F.zip_with(parts, starts, lambda part, at: F.aggregate(part["pairs"], begin(at), add, lambda done: done["out"])))

    # bound to a name by a transform over one element, so that no step is taken twice
    once = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)
    nothing = F.array().cast(f"array<{SPAN}>")
    return once(pairs, lambda p: F.when(F.size(p) == 0, nothing).otherwise(once(in_parts(p), placed)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(f"^{_PART}(?:[.]{_PART}){{3}}$")
    size = F.length(_digits(value))
    return size.between(14, 19) & _luhn(_digits(value)) if kind == "card" else size.between(10, 15)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one kind, leftmost and not overlapping; matches that fail the kind's test are dropped, not retried."""
    spans = F.filter(_places(text, PATTERNS[kind]), lambda s: _valid(kind, s))
    likely = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else text.rlike("[0-9](?:[ -]?[0-9]){13}")
    return F.when(likely, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _entity(kind: Column, value: Column) -> Column:
    return F.concat(kind, F.lit(":"), F.when(kind == "email", F.lower(value)).otherwise(F.regexp_replace(value, "[ ().-]", "")))


def found_spans(documents: DataFrame) -> DataFrame:
    """row_key, text_key, doc_id, base spans and entities of each document, and the text where there are any."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64("text").alias("text_key"), "doc_id", "text", *(base_spans(F.col("text"), k).alias(k) for k in PATTERNS))

    def of_kind(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    every = F.concat(*map(of_kind, PATTERNS))

    entities = F.array_distinct(F.transform("spans", lambda s: _entity(s["kind"], s["value"])))
    held = F.when(F.size("spans") > 0, F.col("text")).alias("text")
    return rows.withColumn("spans", every).select("row_key", "text_key", "doc_id", F.transform("spans", lambda s: s.dropFields("value")).alias("spans"), entities.alias("entities"), held)


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _document_frequency(documents: DataFrame) -> DataFrame:
    """In how many different texts each term occurs."""
    texts = documents.groupBy(F.xxhash64("text")).agg(F.first("text").alias("text"))
    return texts.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df_term"))


def disclosing_terms(documents: DataFrame, found: DataFrame, support: int = 2, generalise: float = 0.8) -> DataFrame:
    """text_key, term and the highest disclosure of the terms of each text that are at or over the threshold.

    As c is at most either df, a term can reach the threshold only up to df(t) = N (df(e) / N) ** generalise; more frequent
    ones, and terms and entities in fewer texts than the support, are dropped before they are paired.
    """
    total = max(2, found.select("text_key").distinct().count())
    texts = found.where("size(entities) > 0").groupBy("text_key").agg(F.first("text").alias("text"), F.first("entities").alias("entities"))
    texts = written(texts, "texts")
    held = texts.select("text_key", F.explode("entities").alias("entity"))
    entities = written(held.groupBy("entity").agg(F.count("*").alias("df_entity")).where(F.col("df_entity") >= support), "entities")
    # a little over the bound, for rounding
    most = lambda df: total * (df / total) ** generalise * 1.000001
    widest = entities.agg(F.max("df_entity")).first()[0] or 0
    frequency = written(_document_frequency(documents).where(F.col("df_term").between(support, most(max(1, widest)))), "frequency")
    few = F.broadcast if frequency.count() <= BROADCAST_TERMS else lambda df: df
    words = texts.select("text_key", F.explode(_words(F.col("text"))).alias("term")).join(few(frequency), "term")
    near = words.join(held.join(entities, "entity"), "text_key").where(F.col("df_term") <= most(F.col("df_entity")))
    near = written(near, "near")
    pairs = near.groupBy("entity", "term", "df_entity", "df_term").agg(F.count("*").alias("c")).where(F.col("c") >= support)
    known = F.log(total / F.col("df_entity"))
    scored = pairs.withColumn("disclosure", F.when(known > 0, F.log(F.col("c") * total / (F.col("df_term") * F.col("df_entity"))) / known).otherwise(0.0))
    revealing = scored.where(F.col("disclosure") >= generalise).select("entity", "term", "disclosure")
    return near.join(revealing, ["entity", "term"]).groupBy("text_key", "term").agg(F.max("disclosure").alias("disclosure"))


def personal_spans(documents: DataFrame, support: int = 2, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """row_key, doc_id and spans (kind, start, end, action) of each document row, sorted by start and kind.

    One row per input row; a null text is empty. Rows equal in identifier and text get equal spans. Places count code
    points, ends are exclusive. Base spans of different kinds may overlap; terms inside base spans are left out.
    """
    found = written(found_spans(documents), "found")
    revealing = disclosing_terms(documents, found, support, generalise)
    terms = revealing.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("known"))
    rows = found.join(terms, "text_key", "left")

    def hit(s: Column) -> Column:
        action = F.when(F.col("known")[F.lower(s["value"])] >= remove, "remove").otherwise("generalise")
        return F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), action.alias("action"))

    places = F.filter(_places(F.col("text"), WORD), lambda s: F.map_contains_key("known", F.lower(s["value"])))
    base = F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"], F.lit("mask").alias("action"))).alias("base")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,action:string>>")
    rows = rows.select("row_key", "doc_id", base, F.when(F.col("known").isNotNull(), F.transform(places, hit)).otherwise(none).alias("terms"))
    free = F.filter("terms", lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(F.concat("base", free), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["action"].alias("action")))
    return rows.select("row_key", "doc_id", F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["action"].alias("action"))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def sanitise(documents: DataFrame, support: int = 2, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """documents with personal data masked by kind, revealing terms generalised to [TERM] or removed; other columns kept.

    Of spans that overlap, the one that starts first (the longest of those) is masked together with what sticks out.
    """
    own = personal_spans(documents, support, generalise, remove).where("size(spans) > 0")
    # the caller's row travels as one column, beside names that none of its columns has
    names = {c.lower() for c in documents.columns}
    row, key, own_key, own_spans = (next(n for k in range(len(names) + 1) if (n := f"_{c}{k}") not in names) for c in ("row", "key", "own_key", "own_spans"))
    own = own.select(F.col("row_key").alias(own_key), F.col("spans").alias(own_spans)).dropDuplicates([own_key])
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias(row), F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias(key))
    joined = packed.join(own, F.col(key) == F.col(own_key), "left")
    text = F.col(row)["text"]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def mask(done: Column, s: Column) -> Column:
        word = F.when(s["action"] == "remove", "").when(s["action"] == "generalise", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        fresh = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), word)
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] >= done["at"], fresh).otherwise(done["out"]).alias("out"))

    ended = F.aggregate(own_spans, start, mask, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    masked = F.when(F.col(own_spans).isNull() | text.isNull(), text).otherwise(ended)
    return joined.select(*(masked.alias("text") if c == "text" else F.col(row)[c].alias(c) for c in documents.columns))
