"""Personal data in texts, and terms that give it away.

Patterns find the base spans: mail addresses, IP numbers, payment cards, phone numbers. Each value found is a protected
entity. Words that stand near an entity are its terms; over the whole corpus, the information that a term
reveals about an entity is their pointwise mutual information, log2(N n(c, t) / (n(c) n(t))), with counts of documents.
A term whose information reaches a share of the entity's own, log2(N / n(c)), and is seen with it in
enough distinct contexts, or in each document of an entity that fewer documents hold, discloses it: in every document that holds the entity, it becomes a span too. When the text is rewritten, base spans
become the name of their kind, disclosing terms a general word, and terms that reveal an entity
altogether are removed.

Only DataFrame functions are used; their work is linear in a text and its matches, but for the length of its terms' pattern. Spans count code points, their end is exclusive. Copies of a context count as one
context, so copied documents alone disclose nothing.

Defined results: a null or blank text has no spans; spans of different kinds may overlap, those of one kind don't; terms that overlap base spans are not
reported; rows that repeat are judged alike; a null doc_id is a value like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
BASE, SPANS, TERMS = "__base", "__spans", "__terms"
SAME = "doc_id <=> __id AND __key = __mark"
# Each finds what the plain pattern finds, leftmost first, in time linear in the text: a run of characters is
# tried once, from its beginning or from where the last match ended, and never given back. A card is a whole chain of digits of
# the wanted length; a chain of another length is dropped in any case.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|0)"
WORD = r"\p{L}{3,}"
SPACES = r"[\x20\x09-\x0D]"
CONTEXT = 80
SHARE = 0.8
REMOVE = 0.999
SUPPORT = 3
WIDTH = 128
PART = 1024
LAST = 2**31 - 1
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Whether the digits' sum, every second one from the right doubled, is a multiple of ten."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda c: c.try_cast("int"))
    figures = F.filter(figures, lambda c: c.isNotNull())
    each = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return passes_luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def valid_spans(spans: Column, kind: str) -> Column:
    return F.filter(F.coalesce(spans, F.array().cast(SPAN)), lambda s: valid(kind, s["value"]))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, start: int, step: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """At each place of an array of ints what `step` makes of all values before it; `start` must change nothing under `step`.

    An array that grows by one element is copied each time, so it is cut into parts whose totals are scanned first.
    """
    def inside(part: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, state, lambda s, v: F.struct(
            step(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]

    def in_parts(x: Column) -> Column:
        last = F.floor(F.greatest(F.size(x) - 1, F.lit(0)) / WIDTH).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(x, i * WIDTH + 1, F.lit(WIDTH)))
        totals = lambda p: F.transform(p, lambda part: F.aggregate(part, F.lit(start), step))
        return bound(parts, lambda p: F.flatten(F.zip_with(p, scan(totals(p), start, step, levels - 1), inside)))

    return bound(values, in_parts) if levels > 1 else inside(values, F.lit(start))


def parts_of(text: Column) -> Column:
    """A text in parts of PART characters, so that a place in it is found without reading all before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))


def cut(parts: Column, first: Column, last: Column) -> Column:
    """The characters from `first` to `last`, exclusive, of a text in parts."""
    low = F.floor(first / PART).cast("int")
    joined = F.array_join(F.slice(parts, low + 1, F.floor(last / PART).cast("int") - low + 1), "")
    return F.substring(joined, first - low * PART + 1, last - first)


def matches_at(text: Column, found: Column, pattern: Column, rank: int, kind: str) -> Column:
    """Spans of the matches `found`: their places follow from the lengths of what lies between."""
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))

    def placed(pieces: Column) -> Column:
        ahead = scan(F.transform(pieces, lambda p: p["gap"] + F.length(p["value"])), 0, lambda s, n: s + n)
        return F.zip_with(pieces, ahead, lambda p, at: F.struct(
            (at + p["gap"]).alias("start"), F.lit(rank).alias("rank"), (at + p["gap"] + F.length(p["value"])).alias("end"),
            F.lit(kind).alias("kind"), p["value"].alias("value")))

    pieces = F.zip_with(between, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    return F.when(F.size(found) > 0, bound(pieces, placed).cast(SPAN)).otherwise(F.array().cast(SPAN))


def apart_from_base(base: Column, terms: Column) -> Column:
    """The base spans and those of `terms` that overlap none of them, by start, then kind."""
    furthest = lambda s, v: F.greatest(s, v)
    nearest = lambda s, v: F.least(s, v)
    is_base = lambda s: s["kind"] != TERM

    def kept(spans: Column) -> Column:
        ended = scan(F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), 0, furthest)
        begins = F.reverse(scan(F.reverse(F.transform(spans, lambda s: F.when(is_base(s), s["start"]).otherwise(LAST))), LAST, nearest))
        room = F.zip_with(ended, begins, lambda low, high: F.struct(low.alias("low"), high.alias("high")))
        judged = F.zip_with(spans, room, lambda s, r: F.when(is_base(s) | ((r["low"] <= s["start"]) & (s["end"] <= r["high"])), s))
        return F.filter(judged, lambda s: s.isNotNull())

    return bound(F.array_sort(F.concat(base, terms)), kept)


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with their base spans by start, then kind."""
    here = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.withColumns({f"__{k}": F.when(here.rlike(HINTS[k]), F.regexp_extract_all(here, F.lit(PATTERNS[k]), F.lit(0))) for k in KINDS})
    placed = found.withColumns({
        f"__{k}": F.when(F.size(f"__{k}") > 0, matches_at(here, F.col(f"__{k}"), F.lit(PATTERNS[k]), rank, k)) for rank, k in enumerate(KINDS)})
    kept = [valid_spans(F.col(f"__{k}"), k) for k in KINDS]
    return placed.withColumn(BASE, F.array_sort(F.concat(*kept))).drop(*[f"__{k}" for k in KINDS])


def entity(span: Column) -> Column:
    """A value under its kind, however it is written."""
    value = F.when(span["kind"].isin("card", "phone"), digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def words_around(parts: Column, span: Column, reach: int) -> Column:
    """Distinct words within `reach` characters of a span of a text in parts, without cut ones."""
    low = F.greatest(span["start"] - reach, F.lit(0))
    left = cut(parts, low, span["start"])
    left = F.when(low > 0, F.regexp_replace(left, rf"^.*?{SPACES}", "")).otherwise(left)
    right = F.regexp_replace(cut(parts, span["end"], span["end"] + reach), rf"{SPACES}\S*$", "")
    return F.array_distinct(F.regexp_extract_all(F.lower(F.concat(left, F.lit(" "), right)), F.lit(WORD), F.lit(0)))


def text_mark(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def base_table(docs: DataFrame, text: str = "text", reach: int = CONTEXT) -> DataFrame:
    """(doc_id, mark, base, mentions) of the documents with base spans: the one pass of the patterns over all texts.

    `mentions` are the spans' entities with the words around them.
    """
    mentions = bound(parts_of(F.col(f"`{text}`")), lambda parts: F.transform(BASE, lambda s: F.struct(
        entity(s).alias("entity"), words_around(parts, s, reach).alias("words"))))
    return (
        with_base_spans(docs.select("doc_id", f"`{text}`"), text).where(F.size(BASE) > 0)
        .select("doc_id", text_mark(text).alias("mark"), F.col(BASE).alias("base"), mentions.alias("mentions"))
    )


def entity_contexts(marked: DataFrame) -> DataFrame:
    """(doc_id, mark, entity, terms, context): per document and entity its surrounding words."""
    mentions = marked.select("doc_id", "mark", F.explode("mentions").alias("m"))
    return mentions.groupBy("doc_id", "mark", F.col("m.entity").alias("entity")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("m.words")))).alias("terms")).withColumn("context", F.xxhash64("terms"))


def term_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, n_t): how many documents hold a word."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit(WORD), F.lit(0)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))


def disclosing_terms(docs: DataFrame, contexts: DataFrame, text: str = "text", share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """(entity, term, ratio): the terms that reveal at least `share` of an entity's information."""
    total = docs.count()
    n_c = contexts.groupBy("entity").agg(F.count("*").alias("n_c"))
    together = (
        contexts.select("entity", "context", F.explode("terms").alias("term"))
        .groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_ct"), F.count("*").alias("contexts"))
        .join(n_c, "entity").where(F.col("contexts") >= F.least(F.lit(support), "n_c"))
    )
    pmi = F.log2(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c") * F.col("n_t")))
    own = F.log2(F.lit(float(total)) / F.col("n_c"))
    return (
        together.join(term_documents(docs, text), "term")
        .where(own > 0).withColumn("ratio", pmi / own).where(F.col("ratio") >= share)
        .select("entity", "term", "ratio")
    )


def found_spans(docs: DataFrame, text: str = "text", reach: int = CONTEXT, share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """(__id, __mark, BASE, SPANS, TERMS) of the documents with spans, one row for each doc_id and text.

    BASE are the spans of the patterns, SPANS these and the disclosing terms, by start, then kind; TERMS are the terms with
    the share that they reveal. Texts are read again only where a term was found.
    """
    folder = scratch_folder(docs.sparkSession, "pii")
    marked = written(base_table(docs, text, reach), f"{folder}/base")
    contexts = written(entity_contexts(marked), f"{folder}/contexts")
    disclosing = written(disclosing_terms(docs, contexts, text, share, support), f"{folder}/terms")
    terms = (
        contexts.select("doc_id", "mark", "entity").join(disclosing, "entity")
        .groupBy("doc_id", "mark", "term").agg(F.max("ratio").alias("ratio"))
        .groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("term", "ratio"))).alias(TERMS))
        .select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), TERMS)
    )
    terms = written(terms, f"{folder}/documents")
    here = F.coalesce(F.col("__text"), F.lit(""))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.transform(TERMS, lambda t: t["term"]), "|"), F.lit(r")(?!\p{L})"))
    # Only texts that can have an entity are moved.
    hinted = docs.where(F.col(f"`{text}`").rlike("|".join(HINTS.values())))
    texts = hinted.select("doc_id", F.col(f"`{text}`").alias("__text"), text_mark(text).alias("__key"))
    placed = (
        texts.join(terms, F.expr(SAME)).withColumn("__pattern", pattern)
        .withColumn("__found", F.regexp_extract_all(here, F.col("__pattern"), F.lit(0)))
        .select("__id", "__mark", TERMS, matches_at(here, F.col("__found"), F.col("__pattern"), len(KINDS), TERM).alias("placed"))
        .dropDuplicates(["__id", "__mark"])
    )
    base = marked.dropDuplicates(["doc_id", "mark"]).select("doc_id", F.col("mark").alias("__key"), F.col("base").alias(BASE))
    spans = F.when(F.size("placed") > 0, apart_from_base(F.col(BASE), F.col("placed"))).otherwise(F.col(BASE))
    joined = base.join(placed, F.expr(SAME), "left").select("doc_id", "__key", BASE, TERMS, spans.alias(SPANS))
    return written(joined.select(F.col("doc_id").alias("__id"), F.col("__key").alias("__mark"), BASE, SPANS, TERMS), f"{folder}/found")


def with_spans(docs: DataFrame, text: str = "text", keep_text: bool = True, **options) -> DataFrame:
    """`docs` with BASE, SPANS and TERMS; without the texts where these are not wanted any more."""
    found = found_spans(docs, text, **options)
    rows = docs.withColumn("__key", text_mark(text))
    joined = (rows if keep_text else rows.drop(text)).join(found, F.expr(SAME), "left").drop("__id", "__mark", "__key")
    return joined.withColumns({c: F.coalesce(c, F.array().cast(SPAN)) for c in (BASE, SPANS)})


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replacement(span: Column, terms: Column, remove: float) -> Column:
    """What stands for a span: its kind, or for a term a general word or nothing."""
    ratio = F.aggregate(F.filter(terms, lambda t: t["term"] == F.lower(span["value"])), F.lit(0.0), lambda m, t: F.greatest(m, t["ratio"]))
    general = F.when(span["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    return F.when(span["kind"] != TERM, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).when(ratio >= remove, "").otherwise(general)


def sanitised(docs: DataFrame, text: str = "text", remove: float = REMOVE, **options) -> DataFrame:
    """`docs` with personal data and disclosing terms out of their texts; `n_chars`, where there is one, follows."""
    columns = docs.columns
    here = F.col(f"`{text}`")
    found = with_spans(docs, text, **options)

    def rebuilt(parts: Column) -> Column:
        done = scan(F.transform(SPANS, lambda s: s["end"]), 0, lambda s, end: F.greatest(s, end))
        pieces = F.zip_with(SPANS, done, lambda s, at: F.when(s["start"] >= at, F.concat(cut(parts, at, s["start"]), replacement(s, F.col(TERMS), remove))))
        last = F.array_max(F.transform(SPANS, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), F.substring(here, last + 1, F.length(here)))

    new = F.when(F.size(SPANS) > 0, bound(parts_of(here), rebuilt)).otherwise(here)
    done = found.withColumn("__new", new)
    kinds = dict(docs.dtypes)
    return done.select(*[
        F.col("__new").alias(c) if c == text
        else F.when(F.size(SPANS) > 0, F.length("__new")).otherwise(F.col("n_chars")).cast(kinds[c]).alias(c) if c == "n_chars"
        else F.col(f"`{c}`") for c in columns])
