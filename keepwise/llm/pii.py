r"""Personal data: base patterns plus information-theoretic sanitisation.

Base spans (e-mail, IP address, card number, phone number) are the leftmost
non-overlapping matches of fixed patterns that pass a check (parts up to 255,
13 to 19 digits with a Luhn sum, 9 to 15 digits). They are the protected
entities. Words of their texts can give them away even when they are masked,
so the corpus is asked how much each word reveals: with N texts, of which n(k)
hold an entity of kind k, n(t) hold term t outside base spans and n(k, t) hold
both,

    disclosure(k, t) = log2(n(k, t) N / (n(t) n(k))) / log2(N / n(k)),

the pointwise mutual information over the information content of the kind: 1
if the term never occurs without it, 0 if it tells nothing. Wherever they stand,
in texts with or without an entity, terms are generalised to the kind's name
from ``GENERALISE`` on and removed from ``REMOVE`` on, provided that chance
does not explain the counts: the Chernoff bound on the odds that as many of
the term's different texts hold the kind, times the pairs of kind and term
examined, is at most ``CHANCE`` (copies of one text count once). So a name in
enough texts with its own one address is treated, a word seen once is not.

All work is DataFrame and SQL functions. Patterns are the stated ones with
possessive repeats and look-behinds, which match the same spans in linear
time. Counts are combined before their shuffle; the distinct terms of every
text meet the table of revealing terms in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialise, shuffled

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Terms expected to be marked by chance, over all pairs of kind and term.
CHANCE = 0.01
MIN_TERM_LETTERS = 3
GENERALISE = 0.8
REMOVE = 0.95
#: Terms found, over all texts (some 60 bytes each), up to which their table may be a broadcast.
BROADCAST_HITS = 200_000

_LOCAL = "[A-Za-z0-9._%+-]"
#: The stated patterns. A match can begin only where its first run begins or where the previous match ended,
#: so trying other positions (quadratic on long runs) is skipped by the look-behind.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Cheap conditions that any text with a valid match of the kind fulfils.
_GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"(?:[0-9][ -]?+){12}[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
_PART = "0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPAN = "array<struct<kind:string,start:int,stop:int,found:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return x.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    n = F.length(_digits(x))
    return n.between(9, 15) if kind == "phone" else n.between(13, 19) & F.when(n.between(13, 19), luhn(_digits(x)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _pieces(items: Column) -> Column:
    """An array cut into arrays of the square root of its size."""
    n = F.size(items)
    k = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double"))).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((n - 1) / k).cast("int"))),
                       lambda c: F.slice(items, c * k + 1, k))


def _in_pieces(items: Column, size, step, empty: Column) -> Column:
    """``step`` run over an array from the left, appending to a list, in time
    that stays near linear: a list grown item by item is copied for each, so the
    items are cut into pieces, each with a list of its own. ``size`` gives the
    length of an item; a piece starts at the sum of the lengths before it.
    ``step`` maps (struct of at and out, item) to the next struct."""

    def run(pieces):
        lengths = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + size(x)))
        state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        begins = F.aggregate(lengths, state, lambda a, n: F.struct(
            (a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(pieces, begins, lambda p, begin: F.aggregate(
            p, F.struct(begin.alias("at"), empty.alias("out")), step, lambda a: a["out"])))

    return _let(items, lambda it: _let(_pieces(it), run))


def _matches(text: Column, pattern: Column, hit, empty: Column) -> Column:
    """``hit(found, start, stop)`` of every match, in order and code points.
    The texts between matches (a split by the pattern) and the matches, laid
    end to end, give every position."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))

    def length(x):
        return F.length(x["gap"]) + F.length(F.coalesce(x["hit"], F.lit("")))

    def step(acc, x):
        start, stop = acc["at"] + F.length(x["gap"]), acc["at"] + length(x)
        return F.struct(stop.alias("at"), F.when(x["hit"].isNotNull(), F.concat(
            acc["out"], F.array(hit(x["hit"], start, stop)))).otherwise(acc["out"]).alias("out"))

    return _in_pieces(parts, length, step, empty)


def base_spans(text: Column, kind: str) -> Column:
    """Spans (kind, start, stop, found) of one kind in code points, in order."""
    empty = F.array().cast(_SPAN)
    found = _matches(text, F.lit(PATTERNS[kind]), lambda found, start, stop: F.struct(
        F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), found.alias("found")), empty)
    return F.when(_GATES[kind](text), F.filter(found, lambda s: _valid(kind, s["found"]))).otherwise(empty)


def all_base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind as listed, then start."""
    return F.concat(*[base_spans(F.coalesce(text, F.lit("")), k) for k in KINDS])


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def _terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"\P{L}++")), lambda t: F.length(t) >= MIN_TERM_LETTERS)


def _outside(text: Column, spans: Column) -> Column:
    """``text`` with a blank for each base span."""
    return redact(text, F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["stop"], F.lit(" ").alias("label")))))


def _neighbours(texts: DataFrame) -> DataFrame:
    """Rows (digest, copies, kind, term): the distinct terms outside the base spans of
    each of ``texts`` (digest, copies, text, spans) with each kind the text holds."""
    kinds = F.array_distinct(F.transform("spans", lambda s: s["kind"]))
    terms = texts.select("digest", "copies", kinds.alias("kinds"), F.explode(_terms(_outside(F.col("text"), F.col("spans")))).alias("term"))
    return terms.select("digest", "copies", F.explode("kinds").alias("kind"), "term")


def mark(docs: DataFrame, keep) -> DataFrame:
    """Written once: row (struct of the ``keep`` columns), spans, key (of the
    text), the text if not kept, and for rows with base spans text and digest."""
    spans = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), F.col("text"),
                        all_base_spans(F.col("text")).alias("spans"), F.sha2("text", 256).alias("sha"))
    some = F.size("spans") > 0
    text = F.when(some, F.col("text")) if "text" in keep else F.col("text")
    return materialise(spans.select("row", "spans", text.alias("text"), F.when(some, F.col("sha")).alias("digest"),
                                    F.unhex("sha").alias("key")), "spans")


def term_counts(docs: DataFrame) -> DataFrame:
    """Texts holding each term, over the whole corpus: (term, n_term)."""
    return docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def revealing_terms(docs: DataFrame, entity_texts: DataFrame, beside: DataFrame) -> DataFrame:
    """(kind, term, disclosure) of the terms whose disclosure reaches
    ``GENERALISE``, from the co-occurrence counts of the whole corpus."""
    total = docs.where("text is not null").count()
    kinds = entity_texts.select("copies", F.explode(F.array_distinct(F.transform("spans", lambda s: s["kind"]))).alias("k"))
    holding = {r["k"]: r["n"] for r in kinds.groupBy("k").agg(F.sum("copies").alias("n")).collect()}  # four rows
    if not holding:
        return beside.select("kind", "term", F.lit(0.0).alias("disclosure")).where("false")
    n_kind = F.element_at(F.create_map(*[F.lit(x) for k, n in holding.items() for x in (k, int(n))]), F.col("kind"))
    joint = materialise(beside.groupBy("kind", "term").agg(F.sum("copies").alias("n_joint"), F.count(F.lit(1)).alias("n_texts")),
                        "joint")
    within = entity_texts.select("copies", F.explode(F.array_except(
        _terms(F.col("text")), _terms(_outside(F.col("text"), F.col("spans"))))).alias("term"))
    counts = (shuffled(joint).join(term_counts(docs), "term")
              .join(within.groupBy("term").agg(F.sum("copies").alias("n_within")), "term", "left")
              .withColumn("n_term", F.col("n_term") - F.coalesce("n_within", F.lit(0))))
    n = F.lit(float(total))
    information = F.log2(n / n_kind)
    mutual = F.log2(F.col("n_joint") * n / (F.col("n_term") * n_kind))
    # texts of the term, copies with the kind once, and how far their share with the kind is from the corpus'
    texts = F.col("n_texts") + F.col("n_term") - F.col("n_joint")
    share, rate = F.col("n_texts") / texts, n_kind / n
    apart = share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    supported = (share > rate) & (texts * apart >= F.log(F.lit(max(1, joint.count()) / CHANCE)))
    # a kind that every text holds carries no information, and no term can disclose it
    return counts.where(supported).select("kind", "term", F.when(information > 0, mutual / information).otherwise(0.0)
                                          .alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def _occurrences(text: Column, hits: Column, spans: Column) -> Column:
    """Spans (start, stop, kind, disclosure) of every occurrence of the terms
    ``hits`` (term, kind, disclosure) as whole words outside the base spans."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.array_distinct(F.transform(
        hits, lambda h: h["term"])), "|"), F.lit(r")(?!\p{L})"))
    words = _matches(text, pattern, lambda found, start, stop: F.struct(
        F.lower(found).alias("term"), start.alias("start"), stop.alias("stop")),
        F.array().cast("array<struct<term:string,start:int,stop:int>>"))
    free = F.filter(words, lambda w: ~F.exists(spans, lambda s: (s["start"] < w["stop"]) & (s["stop"] > w["start"])))
    return F.flatten(F.transform(free, lambda w: F.transform(
        F.filter(hits, lambda h: h["term"] == w["term"]),
        lambda h: F.struct(w["start"].alias("start"), w["stop"].alias("stop"), h["kind"].alias("kind"),
                           h["disclosure"].alias("disclosure")))))


def find(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Rows (row, base, terms): the ``keep`` columns, the base spans and the
    spans of revealing terms (kind, term, disclosure, start, stop)."""
    marked = mark(docs, keep)
    some = marked.where("digest is not null")
    entity_texts = materialise(some.groupBy("digest").agg(F.first("text").alias("text"), F.first("spans").alias("spans"),
                                                          F.count(F.lit(1)).alias("copies")), "entities")
    terms = materialise(revealing_terms(docs, entity_texts, _neighbours(entity_texts)), "terms")
    words = docs.where("text is not null").select(F.unhex(F.sha2("text", 256)).alias("key"),
                                                  F.explode(_terms(F.col("text"))).alias("term"))
    hits = materialise(words.join(terms, "term").groupBy("key").agg(
        F.collect_set(F.struct("term", "kind", "disclosure")).alias("hits")), "hits")
    # lists of alike terms are many times their files: their true number decides whether they may be a broadcast
    if (hits.agg(F.sum(F.size("hits"))).first()[0] or 0) > BROADCAST_HITS:
        hits = shuffled(hits)
    text = F.coalesce(F.col("text"), F.col("row.text")) if "text" in keep else F.col("text")
    shape = "array<struct<start:int,stop:int,kind:string,disclosure:double>>"
    empty = F.array().cast(shape)
    spots = F.when(F.col("hits").isNotNull(), F.sort_array(_occurrences(text, F.col("hits"), F.col("spans")))).otherwise(empty)
    found = marked.where("key is not null").join(hits, "key", "left").select("row", "spans", spots.cast(shape).alias("terms"))
    return found.unionByName(marked.where("key is null").select("row", "spans", empty.alias("terms")))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans
    (all spans: the base kinds as listed, then ``term``). A null text is an
    empty one, without spans. Repeated rows stay repeated; texts of any length
    are read whole; spans of equal start stand by kind; other columns are not
    read; an empty table gives none."""
    found = find(docs)
    per_kind = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    terms = F.array_distinct(F.transform("terms", lambda t: F.struct(F.lit(TERM).alias("kind"), t["start"], t["stop"])))
    base = digest(F.col("spans"))
    return found.select(F.col("row.doc_id").alias("doc_id"), *per_kind, F.sha2(base, 256).alias("base_sha256"),
                        F.concat_ws(",", F.when(base != "", base), F.when(F.size("terms") > 0, digest(terms))).alias("spans"))


def redact(text: Column, marks: Column) -> Column:
    """``text`` with each mark (start, stop, label; sorted by start) replaced
    by its label; overlapping marks are covered once, by the first label."""

    def run(pieces):
        ends = F.transform(pieces, lambda p: F.array_max(F.transform(p, lambda m: m["stop"])))
        state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        # a piece begins where the marks before it end, and is cut out of the text once
        begins = F.aggregate(ends, state, lambda a, n: F.struct(
            F.greatest(a["at"], n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        done = F.zip_with(pieces, begins, lambda p, begin: _let(
            F.substring(text, begin + 1, F.greatest(F.lit(0), F.array_max(F.transform(p, lambda m: m["stop"])) - begin)),
            lambda own: F.aggregate(p, F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out")), lambda acc, m: F.struct(
                F.greatest(acc["at"], m["stop"]).alias("at"),
                F.when(m["start"] >= acc["at"], F.concat(acc["out"], F.array(
                    F.substring(own, acc["at"] - begin + 1, m["start"] - acc["at"]), m["label"]))).otherwise(acc["out"]).alias("out")),
                lambda acc: F.array_join(acc["out"], ""))))
        return F.concat(F.array_join(done, ""), F.substring(text, F.array_max(ends) + 1, F.length(text)))

    return F.when(F.size(marks) > 0, _let(marks, lambda it: _let(_pieces(it), run))).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``: base spans become the
    kind in brackets, revealing terms the kind's name or, where they disclose
    it almost surely, nothing. Other columns and all rows stay."""
    found = find(docs, docs.columns)
    base = F.transform("spans", lambda s: F.struct(s["start"], s["stop"], F.concat(
        F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label")))
    terms = F.transform("terms", lambda t: F.struct(t["start"], t["stop"], F.when(
        t["disclosure"] >= REMOVE, "").otherwise(t["kind"]).alias("label")))
    marks = F.array_sort(F.concat(base, terms))
    out = found.select("row", marks.alias("marks"))
    return out.select(*[(redact(F.col("row.text"), F.col("marks")) if c == "text" else F.col("row")[c]).alias(c)
                        for c in docs.columns])
