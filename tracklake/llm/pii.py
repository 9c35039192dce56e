"""Information-theoretic sanitisation of personal data (operator 4).

Addresses, IP numbers, card numbers and phone numbers found by pattern are the
protected entities, and so are the parts of them that recur: a mail address's
name and host, an IP number's block of 256, the first six digits of cards and
phone numbers. The other words of a document that holds one may reveal it,
wherever they stand. The share of an entity's information that a term gives
away is, with counts of distinct texts over the whole corpus,

    ratio = PMI(term, entity) / IC(entity)
          = log(n_both * N / (n_term * n_entity)) / log(N / n_entity)

(1 if the term occurs in no text without the entity). Copies of a text are one
text in every count, so copying a document changes nothing. Terms that share
``SUPPORT`` distinct texts or more with the entity (one text alone says nothing
about what its words have to do with each other) are removed when the ratio
reaches ``REMOVE`` and replaced by a general mark from ``GENERALISE`` on, at
every place in each document that holds both. A term is any word of letters,
marks and digits outside the entities, in any case. Documents without an entity
stay as they are. Entities are replaced by the mark of their kind.

Terms are pruned before they meet entities, by bounds that lose none: a ratio
of ``GENERALISE`` needs n_term <= n_both * (N / n_entity) ** (1 - GENERALISE),
and n_both is at most n_entity, so no entity reaches it with a term in more than
max(n_entity ** GENERALISE) * N ** (1 - GENERALISE) texts; and a term needs
``SUPPORT`` texts with entities.

Everything is DataFrame expressions, with work close to linear in a text's
length: offsets are running sums over blocks, and pieces are cut from a copy of
the text with four bytes a code point. Texts without ``@`` and digits are passed
on untouched.

Results on odd input: a null text has no spans and stays null; spans of
different kinds may overlap, and overlapping spans get the mark of the first;
an entity in every text carries no information, so its terms stay; rows with
equal text get equal spans; null doc_ids are ids as any; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import clean_text, materialize

# The kinds in their order, and what counts as one. The patterns
# match as their plain forms do, leftmost first; what is added (possessive
# repeats, starts at the start of a run) only keeps long runs linear.
KINDS = ("email", "ip", "card", "phone", "term")
_MAIL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = (
    rf"(?:\G|(?<!{_MAIL})){_MAIL}++@{_HOST}++(?:\.{_HOST}++)++",
    r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    r"[0-9]++(?:[\x20-][0-9]++)*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WORD = r"[\p{L}\p{M}\p{N}]++"
SUPPORT, GENERALISE, REMOVE = 2, 0.8, 0.95
#: Most rows of a small table that are broadcast (some 100 bytes each); larger
#: ones are joined by shuffle.
BROADCAST_ROWS = 500_000

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of whole numbers from 0 on, ``op`` over those before
    it (0 for the first). Sums or maxima grow by appending, which copies, so they
    run within blocks of the square root of the size, and over the blocks."""
    def grow(a: Column) -> Column:
        return F.aggregate(a, F.array(F.lit(0)), lambda r, x: F.array_append(r, op(F.element_at(r, -1), x)))

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        starts = F.sequence(F.lit(1), F.size(v), width)
        inner = F.transform(starts, lambda at: grow(F.slice(v, at, width)))
        return let(inner, lambda rows: let(
            grow(F.transform(rows, lambda r: F.element_at(r, -1))),
            lambda before: F.flatten(F.transform(rows, lambda r, i: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda x: op(before[i], x)))),
        ))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(blocks(v)))


def wide(text: Column) -> Column:
    """The text as four bytes a code point."""
    return F.encode(text, "UTF-32")


def piece(wide_text: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to ``end``; does not read what is before."""
    return F.decode(F.substring(wide_text, start * 4 + 1, (end - start) * 4), "UTF-32")


def finds(text: Column, pattern: str, ok, kind: int, value) -> Column:
    """Matches that pass ``ok``: array of (start, kind, end, value)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def spans(pairs: Column) -> Column:
        ends = running(F.transform(pairs, lambda x: x["gap"] + F.length(x["found"])), lambda a, b: a + b)
        placed = F.zip_with(pairs, ends, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + x["gap"] + F.length(x["found"])).alias("end"), x["found"].alias("value")
        ))
        return F.transform(F.filter(placed, lambda s: ok(s["value"])), lambda s: F.struct(s["start"], s["kind"], s["end"], value(s["value"]).alias("value")))

    zipped = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
    return F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(let(zipped, spans).cast(_SPANS))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """The protected entities of a text, by start and then kind."""
    # Zeros alone, or leading zeros that are never given back and 1 to 255.
    octet = "(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?))"
    always = F.lit(True)
    found = [
        finds(text, PATTERNS[0], lambda m: always, 0, lambda m: F.lower(m)),
        finds(text, PATTERNS[1], lambda m: m.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), 1, lambda m: m),
        finds(text, PATTERNS[2], lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)), 2, _digits),
        finds(text, PATTERNS[3], lambda m: F.length(_digits(m)).between(9, 15), 3, _digits),
    ]
    none = F.array().cast(_SPANS)
    mail = F.when(F.contains(text, F.lit("@")), found[0]).otherwise(none)
    rest = F.when(text.rlike("[0-9]"), F.concat(*found[1:])).otherwise(none)
    return F.array_sort(F.concat(mail, rest))


def may_hold(text: Column) -> Column:
    """Whether a text has an ``@`` or a digit; without one it has no entity."""
    return F.coalesce(text.rlike("[0-9@]"), F.lit(False))


def entities_of(spans: Column) -> Column:
    """The distinct protected entities of spans, and the parts that may recur."""
    value = lambda s: s["value"]

    def named(kind: int, mark: str, of) -> Column:
        return F.transform(F.filter(spans, lambda s: s["kind"] == kind), lambda s: F.concat(F.lit(f"{mark}:"), of(value(s))))

    return F.array_distinct(F.concat(
        F.transform(spans, lambda s: F.concat(s["kind"].cast("string"), F.lit(":"), s["value"])),
        named(0, "name", lambda v: F.substring_index(v, "@", 1)),
        named(0, "host", lambda v: F.substring_index(v, "@", -1)),
        named(1, "block", lambda v: F.substring_index(v, ".", 3)),
        named(2, "issuer", lambda v: F.substring(v, 1, 6)),
        named(3, "prefix", lambda v: F.substring(v, 1, 6)),
    ))


def _passed(spans: Column) -> Column:
    """For each span the furthest end of those before it."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest)


def outside(text: Column, spans: Column) -> Column:
    """(start, text) of the stretches that lie in no span."""

    def cut(w: Column) -> Column:
        gaps = F.zip_with(spans, _passed(spans), lambda s, at: F.struct(at.alias("start"), s["start"].alias("end")))
        last = F.struct(F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0)).alias("start"), F.length(text).alias("end"))
        held = F.filter(F.concat(gaps, F.array(last)), lambda g: g["end"] > g["start"])
        return F.transform(held, lambda g: F.struct(g["start"], piece(w, g["start"], g["end"]).alias("text")))

    return let(wide(text), cut)


def terms_of(text: Column, spans: Column) -> Column:
    """The distinct terms of a text outside its spans, in lower case."""
    words = F.transform(outside(text, spans), lambda g: F.regexp_extract_all(F.lower(g["text"]), F.lit(WORD), F.lit(0)))
    return F.array_distinct(F.flatten(words))


def term_spans(text: Column, spans: Column, marks: Column) -> Column:
    """A span for each place of the terms that ``marks`` maps to their mark."""

    def found(g: Column) -> Column:
        words = finds(g["text"], WORD, lambda w: F.map_contains_key(marks, F.lower(w)), KINDS.index("term"), lambda w: marks[F.lower(w)])
        moved = lambda w: F.struct(
            (g["start"] + w["start"]).alias("start"), w["kind"].alias("kind"), (g["start"] + w["end"]).alias("end"), w["value"].alias("value")
        )
        return F.transform(words, moved)

    return F.flatten(F.transform(outside(text, spans), found))


def small(df: DataFrame, name: str) -> DataFrame:
    """The table written, and broadcast in joins if it is small."""
    kept = materialize(df, name)
    return F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept


def held_pairs(contexts: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """(text_hash, entity, n_entity, term, n_term) of each distinct text and
    the terms rare enough to disclose its entity."""
    held = contexts.select("text_hash", F.explode("entities").alias("entity")).join(entities, "entity").distinct()
    said = contexts.select("text_hash", F.explode("terms").alias("term")).join(terms, "term").distinct()
    return held.join(said, "text_hash").where(F.col("n_term") <= F.col("most"))


def disclosing_terms(docs: DataFrame, contexts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, term, ratio) of the terms at or above ``GENERALISE``, and the
    entities and terms that may be such, with their counts.

    ``contexts`` has the entities and terms of each text that has any, copies
    included; ``docs`` is the corpus over which terms are counted."""
    hashed = docs.select("text", F.xxhash64(clean_text("text")).alias("text_hash"))
    copies = materialize(hashed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "text-copies")
    more = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()[0]
    n = float(docs.count() - more)
    in_texts = contexts.select("text_hash", F.explode("entities").alias("entity")).distinct().groupBy("entity")
    entities = in_texts.agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    most = F.pow("n_entity", F.lit(GENERALISE)) * F.lit(max(n, 1.0) ** (1 - GENERALISE)) * (1 + 1e-9)
    entities = small(entities.withColumn("most", most), "shared-entities")
    bound = entities.agg(F.max("most")).first()[0] or 0.0
    near = contexts.select("text_hash", F.explode("terms").alias("term")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    wanted = small(near.where(F.col("n").between(SUPPORT, bound)), "candidate-terms")
    # Each text counts once: its copies share its weight.
    copies = F.broadcast(copies) if copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else copies
    weighed = hashed.join(copies, "text_hash", "left").withColumn("weight", F.lit(1.0) / F.coalesce("copies", F.lit(1)))
    words = weighed.select("weight", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(clean_text("text")), F.lit(WORD), F.lit(0)))).alias("term"))
    counted = words.join(wanted.select("term"), "term", "left_semi").groupBy("term").agg(F.round(F.sum("weight")).alias("n_all"))
    # What a span leaves of a word is no word of the whole text, so it may be missing there.
    n_term = F.greatest(F.col("n").cast("double"), F.coalesce("n_all", F.lit(0.0)))
    terms = wanted.join(counted, "term", "left").select("term", n_term.alias("n_term")).where(F.col("n_term") <= bound)
    terms = small(terms, "rare-terms")
    pairs = held_pairs(contexts, entities, terms).groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term")
    )
    information = F.log(F.lit(n) / F.col("n_entity"))
    pmi = F.log(F.col("n_both") * F.lit(n) / (F.col("n_entity") * F.col("n_term")))
    ratio = F.when(information > 0, F.round(pmi / information, 9)).otherwise(F.lit(0.0))
    flagged = pairs.where(F.col("n_both") >= SUPPORT).select("entity", "term", ratio.alias("ratio")).where(F.col("ratio") >= GENERALISE)
    return small(flagged, "disclosing-terms"), entities, terms


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their marks; ``value`` of a term
    span is its mark."""

    def mark(s: Column) -> Column:
        out = s["value"]
        for k, name in enumerate(KINDS[:-1]):
            out = F.when(s["kind"] == k, F.lit(f"[{name.upper()}]")).otherwise(out)
        return out

    def put(w: Column) -> Column:
        parts = F.zip_with(spans, _passed(spans), lambda s, at: F.when(s["start"] >= at, F.concat(piece(w, at, s["start"]), mark(s))).otherwise(""))
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), piece(w, end, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(wide(text), put))


def sanitise(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with the entities and disclosing terms of ``text`` replaced,
    and a column ``name``: all spans found in the given text, by start and then
    kind. A column of that name in ``docs`` is replaced."""
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    text = F.col("whole.text")
    whole = docs.select(F.struct(*kept).alias("whole"))
    plain = whole.where(~may_hold(text)).withColumn("spans", F.array().cast(_SPANS))
    marked = whole.where(may_hold(text)).withColumn("spans", base_spans(clean_text(text))).withColumn("text_hash", F.xxhash64(text))
    found = marked.where(F.size("spans") > 0).select(
        "text_hash", entities_of(F.col("spans")).alias("entities"), terms_of(text, F.col("spans")).alias("terms")
    )
    contexts = materialize(found, "entity-contexts")
    flagged, entities, terms = disclosing_terms(docs.select("text"), contexts)
    # One mark a term: by the entity that it reveals most.
    best = held_pairs(contexts, entities, terms).join(flagged, ["entity", "term"]).groupBy("text_hash", "term").agg(F.max("ratio").alias("ratio"))
    mark = F.when(F.col("ratio") >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]"))
    marks = F.map_from_entries(F.collect_list(F.struct("term", mark.alias("mark"))))
    added = small(best.groupBy(F.col("text_hash").alias("t_hash")).agg(marks.alias("marks")), "term-marks")
    more = F.when(F.col("marks").isNotNull(), term_spans(text, F.col("spans"), F.col("marks"))).otherwise(F.array().cast(_SPANS))
    joined = marked.join(added, F.col("text_hash") == F.col("t_hash"), "left").select("whole", F.array_sort(F.concat("spans", more)).alias("spans"))
    out = plain.unionByName(joined)
    return out.select(*(masked(text, F.col("spans")).alias(c) if c.lower() == "text" else F.col("whole")[c].alias(c) for c in kept), F.col("spans").alias(name))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + F.lit(1))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
