"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base entities (email, ip, card, phone) are leftmost non-overlapping matches. They are the seeds. Each occurrence of a seed, or of
another token with a digit or an at sign, has lexical patterns: the two words before it, and the word on either side, whole words of any length.
Groups of digits with single spaces between them are one token, so identifiers written in groups are found whole. Patterns and
instances form a graph. In each round a pattern's confidence in a kind is the weight of its instances of that kind over all its
instances, plus one; an unlabelled instance that has the looks of a kind takes the kind from its confident patterns, and counts as
evidence in the next round. Instances above the limit are added wherever they occur outside base spans. Counts are over distinct
instances, so copies of a document are no evidence.

Positions are code points, the end exclusive. Time grows with the length of a text and the number of its tokens, not with their product. A null text is empty. Rows are told apart by a row number, so repeated rows and
repeated or null ids are handled each for itself. An empty table gives an empty result. Other columns are kept where the whole
row is returned, whatever their names.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressbeat.llm.common import free_name, let, materialize, numbered, text_of, words_of

KINDS = ("email", "ip", "card", "phone")
GAP = r"\x20\x09-\x0D"
_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# the contract's patterns in forms that start only where a run starts and never step back, so long runs cost their length
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Groups of two to five digits, a space between them; or any word with a digit or an at sign.
TOKEN = rf"(?<![^{GAP}])(?:\(?[0-9]{{2,5}}+\)?(?: [0-9]{{2,5}}+){{1,4}}+(?:-[0-9]{{2,5}}+){{0,2}}+(?![^{GAP}.,;:!?)])|[^{GAP}0-9@]*+[0-9@][^{GAP}]*+)"
#: What an added instance of a kind must look like.
LOOKS = {
    "email": r"^[^@]+@[^@]+$|^[^@]+(?:\(at\)|\[at\])[^@]+$",
    "ip": r"^[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3}$",
    "card": r"^(?:[0-9][ .-]?){12,19}$",
    "phone": r"^[(+]?(?:[0-9][ ().-]{0,2}){7,15}$",
}
ROUNDS, MIN_SEEDS, MIN_PATTERN, MIN_INSTANCE = 3, 3, 0.7, 0.8
SPAN = "array<struct<kind: string, start: int, end: int, value: string, before: string, after: string>>"
BLOCK = 128
CHUNK = 1024


def scanned(n: Column, first: Column, step) -> Column:
    """The items of ``step(state, i)``, a struct of the next state and an item, for i from 0 to n - 1.

    The list grows in blocks, since each append copies what it appends to.
    """

    def numbers(low: Column, high: Column) -> Column:
        return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    def block(state: Column, b: Column) -> Column:
        none = F.struct(state.alias("state"), F.slice(F.array(step(state, F.lit(0))["item"]), 1, 0).alias("items"))

        def add(acc: Column, i: Column) -> Column:
            return let(step(acc["state"], i), lambda x: F.struct(x["state"].alias("state"), F.concat(acc["items"], F.array(x["item"])).alias("items")))

        return F.aggregate(numbers(b * BLOCK, F.least(n, (b + 1) * BLOCK) - 1), none, add)

    empty = F.struct(first.alias("state"), F.slice(F.array(F.array(step(first, F.lit(0))["item"])), 1, 0).alias("blocks"))

    def join(acc: Column, b: Column) -> Column:
        return let(block(acc["state"], b), lambda x: F.struct(x["state"].alias("state"), F.concat(acc["blocks"], F.array(x["items"])).alias("blocks")))

    return F.aggregate(numbers(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), empty, join, lambda acc: F.flatten(acc["blocks"]))


def luhn(value: Column) -> Column:
    def total(backwards):
        def add(acc, i):
            digit = F.call_function("substring", backwards, i, F.lit(1)).cast("int")
            doubled = F.when(i % 2 == 0, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)
            return acc + doubled

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0

    return let(F.reverse(F.regexp_replace(value, "[^0-9]", "")), total)


def fits(kind: str, value: Column) -> Column:
    """Whether a match of a kind's pattern is an entity."""
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def last_words(text: Column, n: int) -> Column:
    """The last ``n`` words of a text, a space between them; one that reaches the end of the text is a word too."""
    return let(words_of(text), lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), n), " "))


def first_word(text: Column) -> Column:
    return F.coalesce(F.get(words_of(text), F.lit(0)), F.lit(""))


def found(text: Column, pattern: str, kind: str) -> Column:
    """The matches of a pattern with their places and the words around them, from the matches and the pieces between them."""

    def placed(matches, pieces):
        def at(parts, i):
            return F.coalesce(F.get(parts, i), F.lit(""))

        def step(state, i):
            begin = state + F.length(F.get(pieces, i))
            end = begin + F.length(F.get(matches, i))
            # enough of the text around a match for two words before it and one after it, unless two matches are nearer
            before = F.concat(at(matches, i - 2), at(pieces, i - 1), at(matches, i - 1), F.get(pieces, i))
            after = F.concat(at(pieces, i + 1), at(matches, i + 1))
            words = F.struct(last_words(before, 2).alias("before"), first_word(after).alias("after"))
            span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), F.get(matches, i).alias("value"), words["before"].alias("before"), words["after"].alias("after"))
            return F.struct(end.alias("state"), span.alias("item"))

        return scanned(F.size(matches), F.lit(0), step)

    def located(matches):
        none = F.array().cast(SPAN)
        return F.when(F.size(matches) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda pieces: placed(matches, pieces)))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def base_spans(text: Column) -> Column:
    """The base entities, by kind as listed and then by start."""

    def entity(kind, s):
        return fits(kind, s["value"])

    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    parts = []
    for kind in KINDS:
        spans = F.filter(found(text, PATTERNS[kind], kind), partial(entity, kind))
        parts.append(F.when(needs.get(kind, text.rlike("[0-9]")), spans).otherwise(F.array().cast(SPAN)))
    return F.concat(*parts)


def other_tokens(text: Column) -> Column:
    """Tokens with a digit or an at sign, without the signs around them."""

    def bare(s):
        lead = F.regexp_extract(s["value"], r"^[^\p{L}\p{N}+(]*+", 0)
        rest = F.regexp_replace(s["value"], r"^[^\p{L}\p{N}+(]++", "")
        tail = F.regexp_extract(rest, r"(?<=[\p{L}\p{N})])[^\p{L}\p{N})]++$", 0)
        core = F.regexp_replace(rest, r"(?<=[\p{L}\p{N})])[^\p{L}\p{N})]++$", "")
        start = s["start"] + F.length(lead)
        before = F.when(lead == "", s["before"]).otherwise(last_words(F.concat(s["before"], F.lit(" "), lead), 2))
        after = F.when(tail == "", s["after"]).otherwise(tail)
        return F.struct(F.lit("").alias("kind"), start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"), before.alias("before"), after.alias("after"))

    cores = F.filter(F.transform(found(text, TOKEN, ""), bare), lambda c: F.length(c["value"]) > 3)
    return F.when(text.rlike("[0-9@]"), cores).otherwise(F.array().cast(SPAN))


def contexts(spans: Column) -> Column:
    """Each span with its two lexical patterns; a side without a word counts as an edge."""

    def patterns(s):
        before, after = F.lower(s["before"]), F.lower(s["after"])
        two = F.when(F.contains(before, F.lit(" ")), before).otherwise(F.concat(F.lit(" "), before))
        both = F.array(F.concat(F.lit("before "), two), F.concat(F.lit("around "), F.substring_index(before, " ", -1), F.lit(" _ "), after))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lower(s["value"]).alias("value"), both.alias("patterns"))

    return F.transform(spans, patterns)


def apart(occurrences: DataFrame) -> DataFrame:
    """The occurrences without the tokens that overlap a base span of their row; the spans of one text meet in one window."""
    upto = Window.partitionBy("row").orderBy("start", F.desc("kind"), "end").rowsBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"), "end").rowsBetween(Window.unboundedPreceding, 0)
    base = F.col("kind") != ""
    seen = occurrences.withColumns({"reach": F.max(F.when(base, F.col("end"))).over(upto), "next": F.min(F.when(base, F.col("start"))).over(on)})
    return seen.filter(base | (F.coalesce(F.col("reach") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True)))).drop("reach", "next")


def learned(occurrences: DataFrame) -> DataFrame:
    """(value, kind): unlabelled instances that confident patterns name, after ROUNDS rounds over the pattern-instance graph."""
    edges = materialize(occurrences.select("value", F.explode("patterns").alias("pattern"), "kind").groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "edges")
    totals = edges.groupBy("pattern").agg(F.count("*").alias("all"))
    seeds = edges.filter("kind <> ''").groupBy("value", "kind").agg(F.lit(1.0).alias("weight"))
    looks = F.array_compact(F.array(*(F.when(F.col("value").rlike(p), F.lit(k)) for k, p in LOOKS.items())))
    # only patterns with enough seeds can ever become confident at first, and only instances with the looks of a kind can be added
    open_edges = edges.filter("kind = ''").select("pattern", "value", F.explode(looks).alias("kind"))
    known = materialize(seeds, "seeds")
    for turn in range(ROUNDS):
        weights = edges.select("pattern", "value").join(known, "value").groupBy("pattern", "kind").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
        sure = weights.filter(F.col("n") >= MIN_SEEDS).join(totals, "pattern").select("pattern", "kind", (F.col("weight") / (F.col("all") + 1)).alias("sure"))
        sure = materialize(sure.filter(F.col("sure") >= MIN_PATTERN), f"patterns{turn}")
        named = open_edges.join(sure, ["pattern", "kind"]).groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("sure"))))).alias("weight"))
        added = materialize(named.filter(F.col("weight") >= MIN_INSTANCE), f"instances{turn}")
        known = seeds.unionByName(added)
    return added.groupBy("value").agg(F.max_by("kind", F.struct("weight", "kind")).alias("kind"))


def annotated(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with an array of base spans and one of added spans, and the names of these two columns."""
    row, base, more = (free_name(docs, n) for n in ("row_of_spans", "base_spans", "added_spans"))
    own = text_of(text)
    first = docs.withColumn(base, base_spans(own))
    first = first.withColumn(more, F.concat(contexts(F.col(base)), contexts(other_tokens(own))))
    held = numbered(first, row, "spans")
    occurrences = materialize(apart(held.select(F.col(row).alias("row"), F.explode(more).alias("o")).select("row", "o.*")), "occurrences")
    names = learned(occurrences).withColumnRenamed("kind", "found")
    hits = occurrences.filter("kind = ''").select("row", "value", "start", "end").join(names, "value")
    spans = hits.groupBy("row").agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end", "value", F.lit("").alias("before"), F.lit("").alias("after"))).alias("added"))
    spans = materialize(spans, "added").select(F.col("row").alias("row_of_added"), "added")
    joined = held.join(spans, held[row] == spans["row_of_added"], "left")
    added = F.coalesce(spans["added"], F.array().cast(SPAN)).alias(more)
    return joined.select(*(held[c] for c in docs.columns), held[base].alias(base), added), base, more


def listed(spans: Column) -> Column:
    order = F.transform(spans, lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(order), lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def reports(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts by kind, the digest of the base spans and the list of all spans."""

    def of_kind(kind, s):
        return s["kind"] == kind

    rows, base, more = annotated(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text")))
    count = [F.size(F.filter(base, partial(of_kind, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *count, F.sha2(listed(F.col(base)), 256).alias("base_sha256"), listed(F.concat(base, more)).alias("spans"), F.size(more).cast("bigint").alias("n_added"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``n_chars`` follows the text. Overlapping spans are one."""
    rows, base, more = annotated(docs)
    spans = F.sort_array(F.transform(F.concat(base, more), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    own = F.col("text")

    def cut(chunks, low, high):
        """The code points from ``low`` to ``high``, from the chunks they lie in."""

        def part(c):
            begin = F.greatest(low - c * CHUNK, F.lit(0))
            return F.call_function("substring", F.get(chunks, c), begin + 1, F.least(high - c * CHUNK, F.lit(CHUNK)) - begin)

        first, last = F.floor(low / CHUNK).cast("int"), F.floor((high - 1) / CHUNK).cast("int")
        return F.when(high > low, F.array_join(F.transform(F.sequence(first, F.greatest(first, last)), part), "")).otherwise(F.lit(""))

    def rebuilt(ordered):
        def over(chunks):
            def step(state, i):
                s = F.get(ordered, i)
                mark = F.when(s["start"] >= state, F.concat(cut(chunks, state, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))
                return F.struct(F.greatest(state, s["end"]).alias("state"), mark.alias("item"))

            rest = cut(chunks, F.array_max(F.transform(ordered, lambda s: s["end"])), F.length(own))
            return F.concat(F.array_join(scanned(F.size(ordered), F.lit(0), step), ""), rest)

        return let(F.regexp_extract_all(own, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), over)

    text = F.when(F.size(F.concat(base, more)) == 0, own).otherwise(let(spans, rebuilt))
    changed = rows.select(*(text.alias(c) if c == "text" else F.col(c) for c in docs.columns))
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else changed


