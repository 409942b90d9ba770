r"""Personal data: base patterns, and terms whose co-occurrence discloses who is meant.

Base spans (email, ip, card, phone) are found leftmost and without overlap per kind; a match
that fails its check (parts over 255, no Luhn sum, wrong number of digits) is dropped.

Information-theoretic sanitisation: protected entities e are the distinct base values and what recurs in them: an
address's domain and the names before its @, an ip's first three parts, the first six digits of a card or
phone.  Over all distinct texts, P(e) = n(e) / texts hold the entity, n(t) the term t, and n(t, e) hold e and, anywhere
outside of base spans, t.  A term discloses an entity if the smoothed P(e | t) =
(n(t, e) + PRIOR * P(e)) / (n(t) + PRIOR) reaches ``DISCLOSED``: who reads the term can tell the entity,
and log2 P(e | t) / P(e) bits with it.  So a term that two texts share with an entity, and no other
text holds, discloses it; one that a single text holds is no evidence (else every word that is
unique to a text with an address would be taken), unless P(e) is 1/4 or more.  Such a term is a span of kind ``term`` wherever a text holds it; in sanitised
text it is removed if it gives away ``REMOVED`` bits and else generalised to its kind of word.

The counts are exact, and what can't reach the score is left out before it is counted, without loss: n(t, e) is at
most h(t), the holders' texts with t, so terms with a small h(t) go first, then those with h(t) too small for
their n(t).  Entities held by the same texts are one class, and so are terms, so a group of near copies
with a hundred addresses and a thousand words of its own is one pair, not all of them.  Terms and texts
are 64-bit hashes.  Texts are never shuffled for a filter: a broadcast of ``SLOTS`` hash slots at most lets
through what may be wanted, and only that is joined exactly.

DataFrame and SQL functions only.  Spans come from one replacement that marks the matches and one split at
the marks; the pieces are walked in runs of ``RUN``, so lists of matches aren't copied for every match.  Patterns are possessive where that
can't change a match: Java then needs no stack for very long runs.

Defined results: null text is empty (no spans), null ids and repeated rows are rows like any
other, an empty table gives no rows; marker characters U+0001 to U+0003 in a text are ordinary
and count as one code point each.  Extra columns are not read by ``find`` and kept by
``sanitise`` (names that begin with __pii are its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.llm._store import likely, settle, slots

KINDS = ("email", "ip", "card", "phone")
PRIOR = 2.0
DISCLOSED = 0.5
REMOVED = 12.0
#: Pieces of a text walked at once; even, so that every run begins outside of a match.
RUN = 512

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    # a match begins where a run does or where the last match ended: other starts can't succeed
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "phone": "+"}
_WORD = r"[\p{L}\p{N}_]++"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nine taken off what exceeds nine."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(p.try_cast("decimal(38,0)"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(x)).between(16, 19) & _luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


def _plain(text: Column) -> Column:
    """Text without null and with marker characters replaced, one for one."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.rlike("[\x01\x02]"), F.translate(text, "\x01\x02", "\x03\x03")).otherwise(text)


def _pieces(text: Column, pattern: str) -> Column:
    """Alternately what lies outside of a match and a match."""
    return F.split(F.regexp_replace(text, f"({pattern})", "\x01$1\x02"), "[\x01\x02]")


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """Array of (start, end, value) of a kind's matches that pass their check."""
    keep = keep or (lambda x: _valid(kind, x))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = lambda at: F.struct(at.alias("at"), F.lit(False).alias("odd"), none.alias("out"))

    def step(s: Column, p: Column) -> Column:
        to = s["at"] + F.length(p)
        found = F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), to.alias("end"), p.alias("value"))))
        return F.struct(to.alias("at"), (~s["odd"]).alias("odd"), F.when(s["odd"] & keep(p), found).otherwise(s["out"]).alias("out"))

    def walk(pieces: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / RUN).cast("int")), lambda i: F.slice(pieces, i * RUN + 1, F.lit(RUN)))
        join = lambda s, run: F.aggregate(run, start(s["at"]), step, lambda inner: F.struct(inner["at"].alias("at"), F.concat(s["out"], inner["out"]).alias("out")))
        return F.aggregate(runs, F.struct(F.lit(0).alias("at"), none.alias("out")), join, lambda s: s["out"])

    walked = F.transform(F.array(_pieces(text, pattern)), walk)[0]  # the pieces are made once
    need = _NEEDS.get(kind)
    there = F.instr(text, need) > 0 if need else text.rlike(r"[0-9][\x20-]?[0-9]" if kind == "card" else r"[0-9]\.[0-9]") if kind in KINDS else F.lit(True)
    return F.when(there, walked).otherwise(none)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with an array column of (start, end, value) for each kind; positions are code points."""
    plain = docs.withColumn("_plain", _plain(F.col(text)))
    return plain.withColumns({kind: _spans(F.col("_plain"), kind, _PATTERNS[kind]) for kind in KINDS}).drop("_plain")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _protected(kind: str) -> Column:
    """Hashes of a kind's values and of what recurs in them."""
    spans = F.col(kind)
    values = F.transform(spans, lambda s: F.xxhash64(s["value"]))
    named = lambda name, parts: F.transform(parts, lambda p: F.xxhash64(F.lit(name), p))
    if kind == "email":
        domains = F.transform(spans, lambda s: F.lower(F.substring_index(s["value"], "@", -1)))
        names = F.flatten(F.transform(spans, lambda s: F.regexp_extract_all(F.lower(F.substring_index(s["value"], "@", 1)), F.lit("([a-z]{2,})"))))
        return F.concat(values, named("domain", domains), named("name", names))
    if kind == "ip":
        return F.concat(values, named("net", F.transform(spans, lambda s: F.substring_index(s["value"], ".", 3))))
    return F.concat(values, named(kind, F.transform(spans, lambda s: F.substring(_digits(s["value"]), 1, 6))))


def holders(based: DataFrame) -> DataFrame:
    """(text_hash, entities, terms) of the rows of base_spans() with any span: hashes of the protected entities
    and of the words outside of the spans."""
    every = F.concat(*[F.col(k) for k in KINDS])
    words = F.filter(F.array_distinct(_words(_without_base(F.col("text")))), lambda w: ~w.isin(*KINDS))
    return based.where(F.size(every) > 0).select(F.xxhash64("text").alias("text_hash"), F.array_distinct(F.concat(*map(_protected, KINDS))).alias("entities"), _hashes(words).alias("terms"))


def _classes(member: str, rows: DataFrame) -> DataFrame:
    """(member, n, cls): how many texts hold it, and a class for all that are held by the same texts."""
    held = rows.groupBy(member).agg(F.count("*").alias("n"), F.bit_xor("text_hash").alias("x"), F.bit_xor(F.xxhash64("text_hash", F.lit(7))).alias("y"))
    return held.select(member, "n", F.xxhash64("n", "x", "y").alias("cls"))


def count_terms(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(t, n_term): distinct texts that hold each wanted term (t), among rows of (text_hash, text); a few others too."""
    near = slots(wanted, "t")
    copies = settle(rows.groupBy("text_hash").agg(F.count("*").alias("copies")).where("copies > 1"), "pii-copies")
    repeated = slots(copies, "text_hash")

    def exploded(some: DataFrame) -> DataFrame:
        words = some.select("text_hash", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
        return likely(words.select("text_hash", F.xxhash64("word").alias("t")), F.col("t"), near)

    # a text that surely stands alone counts as it is, the others once per distinct text
    alone = exploded(likely(rows, F.col("text_hash"), repeated, "left_anti")).groupBy("t").agg(F.count("*").alias("n"))
    others = exploded(likely(rows, F.col("text_hash"), repeated)).distinct().groupBy("t").agg(F.count("*").alias("n"))
    return alone.unionByName(others).groupBy("t").agg(F.sum("n").alias("n_term"))


def disclosure(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(t, bits): the disclosing terms, by hash.  found: see holders(); rows: (text_hash, text) of all texts."""
    n_texts = rows.select("text_hash").distinct().count()
    held = settle(found.dropDuplicates(["text_hash"]), "pii-holders")
    by_entity = held.select("text_hash", F.explode("entities").alias("entity"))
    entities = _classes("entity", by_entity).withColumn("p_entity", F.col("n") / F.lit(max(1, n_texts)))
    # n(t, e) is at most n(e) and n(t): what can't reach the score at equality is left out, no term is lost by it
    entities = settle(entities.where((F.col("n") + PRIOR * F.col("p_entity")) / (F.col("n") + PRIOR) >= DISCLOSED), "pii-entities")
    most = entities.agg(F.max("p_entity")).first()[0] or 0.0
    by_term = held.select("text_hash", F.explode("terms").alias("t"))
    able = by_term.groupBy("t").agg(F.count("*").alias("h")).where(F.col("h") * (1 - DISCLOSED) >= PRIOR * (DISCLOSED - most))
    able = settle(able, "pii-able")
    wanted = able.join(count_terms(rows, able), "t").where(F.col("h") + PRIOR * most >= DISCLOSED * (F.col("n_term") + PRIOR))
    wanted = settle(wanted.select("t", "n_term"), "pii-wanted")

    those = likely(by_term, F.col("t"), slots(wanted, "t")).join(wanted.select("t"), "t")
    terms = settle(_classes("t", those).select("t", "cls").join(wanted, "t"), "pii-term-classes")
    held_terms = those.join(terms.select("t", F.col("cls").alias("term_cls")), "t").select("text_hash", "term_cls").distinct()
    held_entities = by_entity.join(entities.select("entity", F.col("cls").alias("entity_cls")), "entity").select("text_hash", "entity_cls").distinct()
    both = held_terms.join(held_entities, "text_hash").groupBy("term_cls", "entity_cls").agg(F.count("*").alias("n_both"))
    known = entities.select(F.col("cls").alias("entity_cls"), "p_entity").distinct()
    scored = both.join(known, "entity_cls").join(terms.withColumnRenamed("cls", "term_cls"), "term_cls").withColumn("p", (F.col("n_both") + PRIOR * F.col("p_entity")) / (F.col("n_term") + PRIOR))
    return scored.where(F.col("p") >= DISCLOSED).groupBy("t").agg(F.max(F.log2(F.col("p") / F.col("p_entity"))).alias("bits"))


def disclosing(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(_hash, term, bits, instead): the disclosing terms of each text that holds any; instead is
    what generalises the term, or empty to remove it.  found: see holders()."""
    rows = docs.select(F.col(text).alias("text")).where("text is not null").select(F.xxhash64("text").alias("text_hash"), "text")
    terms = settle(disclosure(found, rows), "pii-terms")
    words = rows.select("text_hash", F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).withColumn("t", F.xxhash64("term"))
    holds = likely(words, F.col("t"), slots(terms, "t")).join(terms, "t").select(F.col("text_hash").alias("_hash"), "term", "bits").distinct()
    kind = F.when(F.col("term").rlike(r"^\p{N}+$"), "<NUMBER>").otherwise("<WORD>")
    return settle(holds.withColumn("instead", F.when(F.col("bits") < REMOVED, kind).otherwise("")), "pii-disclosing")


def _swap(kind: str, to: str):
    return lambda p, i: F.when((i % 2 == 1) & _valid(kind, p), F.lit(to)).otherwise(p)


def _without_base(text: Column) -> Column:
    """Text with a space for every base span."""
    text = _plain(text)
    for kind in KINDS:
        text = F.array_join(F.transform(_pieces(text, _PATTERNS[kind]), _swap(kind, " ")), "")
    return text


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, terms): per document doc_id and the arrays email, ip, card, phone and term of
    (start, end, value); and what disclosing() returns."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    terms = disclosing(settle(holders(base_spans(rows)), "pii-found"), rows)
    held = settle(terms.groupBy("_hash").agg(F.collect_set("term").alias("_terms")), "pii-held")
    some, hashed = slots(held, "_hash"), rows.withColumn("_hash", F.xxhash64("text"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    plain = base_spans(likely(hashed, F.col("_hash"), some, "left_anti").drop("_hash")).withColumn("term", none)
    marked = base_spans(likely(hashed, F.col("_hash"), some).join(held.hint("merge"), "_hash", "left").drop("_hash"))
    spans = _spans(_plain(F.col("text")), "term", _WORD, lambda x: F.array_contains("_terms", F.lower(x)))
    marked = marked.withColumn("term", F.when(F.col("_terms").isNotNull(), spans).otherwise(none)).drop("_terms")
    return plain.unionByName(marked), terms


def _replaced(docs: DataFrame, text: str) -> DataFrame:
    """docs with base values replaced by their kind."""
    for kind in KINDS:
        now, need = _plain(F.col(text)), _NEEDS.get(kind)
        there = F.instr(now, need) > 0 if need else now.rlike(r"[0-9][\x20-]?[0-9]" if kind == "card" else r"[0-9]\.[0-9]")
        docs = docs.withColumn(text, F.when(there, F.array_join(F.transform(_pieces(now, _PATTERNS[kind]), _swap(kind, f"<{kind.upper()}>")), "")).otherwise(F.col(text)))
    return docs


def sanitise(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """docs with base values replaced by <EMAIL>, <IP>, <CARD>, <PHONE> and disclosing terms
    (of disclosing(), over the same texts) generalised or removed."""
    held = terms.groupBy(F.col("_hash").alias("__pii_hash")).agg(F.map_from_entries(F.collect_set(F.struct("term", "instead"))).alias("__pii_instead"))
    held = settle(held, "pii-instead")
    some, hashed = slots(held, "__pii_hash"), docs.withColumn("__pii_hash", F.xxhash64(text))
    plain = _replaced(likely(hashed, F.col("__pii_hash"), some, "left_anti"), text)
    marked = _replaced(likely(hashed, F.col("__pii_hash"), some).join(held.hint("merge"), "__pii_hash", "left"), text)
    swapped = F.transform(_pieces(_plain(F.col(text)), _WORD), lambda p, i: F.when(i % 2 == 1, F.coalesce(F.try_element_at("__pii_instead", F.lower(p)), p)).otherwise(p))
    marked = marked.withColumn(text, F.when(F.col("__pii_instead").isNotNull(), F.array_join(swapped, "")).otherwise(F.col(text)))
    return plain.select(*docs.columns).unionByName(marked.select(*docs.columns))


def listed(arrays: list[str]) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    one = lambda kind: lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", *[F.transform(F.sort_array(k), one(k)) for k in arrays])
