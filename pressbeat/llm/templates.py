"""Benchmark decontamination by templates: passages that differ from a benchmark item in numbers, names or units are found too.

Numbers, units after a number and capitalised names become typed placeholders; the rest is lower-cased and cut into runs of letters
and digits. A capitalised word inside a sentence is a name. One that begins a text, a sentence or a line may be a name or not, so
every text is read in two forms, in one of which such words are plain and in the other names; runs lie within one form. Windows of WINDOW template
tokens are hash-joined: first every STRIDE-th window of each document against the set of all item windows, which leaves the documents
that can match; then all windows of those against the items. Matches on one diagonal that follow each other make a run. A run of MIN_RUN
tokens (or the whole item, if it is shorter) whose placeholders stand for one value each is a leak. A run of WINDOW + STRIDE - 1
tokens cannot slip between the strides, and no shorter one counts, so the first join loses nothing.

A window with fewer than LITERALS words that are not placeholders (a word that begins a sentence is one here in either form) counts where its values are the same, or where it lies in a
longer stretch of one template, from its first token on or up to its last, that holds LITERALS such words. Runs over such windows
add the pairs that the other windows alone do not give; without such windows in the items nothing of this is run. A stretch is at
most as long as the longest item, so none is missed. Items of SHORTEST to WINDOW + STRIDE - 2 tokens are met whole: by their template if they hold
LITERALS plain words, else by their values. Items of one or two tokens are not passages and match nothing.

A null text or item is empty and matches nothing. A text of any length is read whole. A document without an id cannot be named: it is never
reported and never removed. Rows of one id are one document for the report; repeated rows change nothing. An empty table gives an empty
report. Other columns are not read and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressbeat.llm.common import let, materialize, text_of, without

WINDOW, STRIDE, MIN_RUN, LITERALS, SHORTEST = 6, 3, 10, 3, 3
LONG = WINDOW + STRIDE - 1
# MAYBE is a name or the plain word that begins a sentence. The SQL statement marks with private-use characters, which are removed from texts
# beforehand; here control characters do it, so that texts in ASCII stay so, and those of a text become OTHER, which separates words as they do
S_NUMBER_SIGN, S_UNIT_SIGN, S_NAME_SIGN, S_MAYBE_SIGN, S_CLOSE_SIGN = PRIVATE = "\ue001", "\ue002", "\ue003", "\ue004", "\ue000"
NUMBER, UNIT, NAME, MAYBE, CLOSE = SIGNS = "\x01", "\x02", "\x03", "\x04", "\x05"
OTHER = "\x06"
UNITS = (
    "kg|g|mg|lb|lbs|oz|km|m|cm|mm|mile|miles|ft|feet|inch|inches|meter|meters|metre|metres|liter|liters|litre|litres|ml|"
    "s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|year|years|"
    "dollar|dollars|euro|euros|pound|pounds|cent|cents|percent|degrees|mph|kmh|gb|mb|kb"
)
# the same patterns twice: possessive for Java, whose plain group repeats recurse, and plain for the SQL statement
J_CAPITALS = r"(^|[^\p{L}\p{N}])(\p{Lu}\p{L}*+(?: \p{Lu}\p{L}*+)*+)"
S_CAPITALS = r"(^|[^\p{L}\p{N}])(\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)*)"
J_NAME = f"([\\p{{Ll}}\\p{{N}},;]) {MAYBE}"
S_NAME = f"([\\p{{Ll}}\\p{{N}},;]) {S_MAYBE_SIGN}"
J_NUMBER = r"([0-9]++(?:[.,][0-9]++)*+)"
S_NUMBER = r"([0-9]+(?:[.,][0-9]+)*)"
J_UNIT = f"({NUMBER}[^{CLOSE}]*+{CLOSE}) ++({UNITS})([^\\p{{L}}\\p{{N}}]|$)"
S_UNIT = f"({S_NUMBER_SIGN}[^{S_CLOSE_SIGN}]*{S_CLOSE_SIGN}) +({UNITS})([^\\p{{L}}\\p{{N}}]|$)"
J_TOKEN = f"[\\p{{L}}\\p{{N}}]++|[{NUMBER}-{MAYBE}][^{CLOSE}]*+{CLOSE}"
S_TOKEN = f"[{S_NUMBER_SIGN}-{S_MAYBE_SIGN}][^{S_CLOSE_SIGN}]*{S_CLOSE_SIGN}|[\\p{{L}}\\p{{N}}]+"
#: Windows of a text of templates, each followed by a space: one begins where the one before it ended its first STRIDE tokens, and none within a token.
J_WINDOW = f"\\G(?=((?:[^ ]++ ){{{WINDOW}}}))(?:[^ ]++ ){{{STRIDE}}}"


def tokens(text: Column) -> Column:
    """The tokens of a text; a placeholder carries its value between its sign and CLOSE."""
    signs, private = "".join(SIGNS), "".join(PRIVATE)
    clean = F.when(text.rlike(f"[{signs}{private}]"), F.translate(text, signs + private, OTHER * len(signs))).otherwise(text)
    marked = F.regexp_replace(clean, J_CAPITALS, f"$1{MAYBE}$2{CLOSE}")
    named = F.lower(F.regexp_replace(marked, J_NAME, f"$1 {NAME}"))
    numbered = F.when(named.rlike("[0-9]"), F.regexp_replace(F.regexp_replace(named, J_NUMBER, f" {NUMBER}$1{CLOSE} "), J_UNIT, f"$1 {UNIT}$2{CLOSE}$3")).otherwise(named)
    return F.regexp_extract_all(numbered, F.lit(J_TOKEN), F.lit(0))


def with_tokens(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and raw, the tokens. They are a column, since inside a lambda the texts named twice above would be made twice."""
    return rows.select(*keys, tokens(F.col(text)).alias("raw"))


def strided_grams(raw: Column) -> Column:
    """The templates of every STRIDE-th window in both forms, a space behind each token; cut from one text of all tokens, not token by token."""
    told = F.concat(F.array_join(raw, " "), F.lit(" "))
    plain = F.translate(F.regexp_replace(told, f"([{NUMBER}-{NAME}])[^{CLOSE}]*+{CLOSE}", "$1"), MAYBE + CLOSE, "")
    names = F.translate(F.regexp_replace(told, f"([{NUMBER}-{MAYBE}])[^{CLOSE}]*+{CLOSE}", "$1"), MAYBE, NAME)

    def cut(templates: Column) -> Column:
        return F.regexp_extract_all(templates, F.lit(J_WINDOW), F.lit(1))

    return F.when(F.contains(told, F.lit(MAYBE)), F.concat(cut(plain), cut(names))).otherwise(cut(plain))


def is_maybe(token: Column) -> Column:
    return F.substring(token, 1, 1) == MAYBE


def as_plain(words: Column) -> Column:
    """The form in which words that begin a sentence are plain."""
    return F.flatten(F.transform(words, lambda t: F.when(is_maybe(t), F.split(F.substring(t, F.lit(2), F.length(t) - 2), " ")).otherwise(F.array(t))))


def as_names(words: Column) -> Column:
    """The form in which they are names."""
    return F.transform(words, lambda t: F.when(is_maybe(t), F.concat(F.lit(NAME), F.substring(t, F.lit(2), F.length(t)))).otherwise(t))


def in_forms(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, form, words and wordy (whether a word is no placeholder, or one only in this form): two rows of each text."""

    def both(raw):
        plain = let(as_plain(raw), lambda w: F.struct(F.lit("plain").alias("form"), w.alias("words"), F.transform(w, is_word).alias("wordy")))
        names = F.struct(F.lit("names").alias("form"), as_names(raw).alias("words"), F.transform(raw, lambda t: is_word(t) | is_maybe(t)).alias("wordy"))
        return F.array(plain, names)

    return with_tokens(rows, keys, text).select(*keys, F.explode(both(F.col("raw"))).alias("f")).select(*keys, "f.*")


def template(token: Column) -> Column:
    return F.when(F.substring(token, -1, 1) == CLOSE, F.substring(token, 1, 1)).otherwise(token)


def window_starts(words: Column, step: int) -> Column:
    """The 1-based first places of the windows; none in a text of fewer words than a window has."""
    last = F.size(words) - WINDOW + 1
    return F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(step))).otherwise(F.array().cast("array<int>"))


def windows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, place, gram and the tokens with values of every window of ``rows.words``."""

    words = F.col("words")

    def cut(kinds):
        return F.transform(window_starts(words, 1), lambda i: F.struct(i.alias("place"), F.slice(words, i, WINDOW).alias("tokens"), F.array_join(F.slice(kinds, i, WINDOW), " ").alias("gram")))

    return rows.select(*keys, F.explode(let(F.transform(words, template), cut)).alias("w")).select(*keys, "w.*")


def gram_code(gram: Column) -> Column:
    """The code of a template as strided_grams() writes it."""
    return F.xxhash64(F.concat(gram, F.lit(" ")))


def is_word(token: Column) -> Column:
    return F.substring(token, -1, 1) != CLOSE


def sparse_windows(words: Column, longest: Column) -> Column:
    """place, size and gram of the windows of few plain words: by their values, and stretched right or left to LITERALS words."""
    kind = "array<struct<place:int,size:int>>"
    n = F.size(words)

    def stretches(at: Column) -> Column:
        def fill(known: Column, low: Column, high: Column, span) -> Column:
            return F.when(known.isNotNull() & (low <= high), F.transform(F.sequence(low, high), span).cast(kind)).otherwise(F.array().cast(kind))

        def right(k: Column) -> Column:
            end = F.get(at, k + (LITERALS - 1))
            low = F.greatest(F.coalesce(F.get(at, k - 1), F.lit(0)) + 1, end - longest + 1)
            return fill(end, low, F.least(F.get(at, k), end - WINDOW), lambda i: F.struct(i.alias("place"), (end - i + 1).alias("size")))

        def left(k: Column) -> Column:
            start = F.get(at, k - (LITERALS - 1))
            high = F.least(F.coalesce(F.get(at, k + 1), n + 1) - 1, start + longest - 1)
            return fill(start, F.greatest(F.get(at, k), start + WINDOW), high, lambda j: F.struct(start.alias("place"), (j - start + 1).alias("size")))

        order = F.when(F.size(at) > 0, F.sequence(F.lit(0), F.size(at) - 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.concat(F.flatten(F.transform(order, right)), F.flatten(F.transform(order, left))))

    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    plain = F.filter(places, lambda i: is_word(F.get(words, i - 1)))
    long = F.transform(let(plain, stretches), lambda s: F.struct(s["place"].alias("place"), s["size"].alias("size"), F.concat(F.lit("T "), F.array_join(F.transform(F.slice(words, s["place"], s["size"]), template), " ")).alias("gram")))
    few = F.filter(window_starts(words, 1), lambda i: F.size(F.filter(F.slice(words, i, WINDOW), is_word)) < LITERALS)
    same = F.transform(few, lambda i: F.struct(i.alias("place"), F.lit(WINDOW).alias("size"), F.concat(F.lit("V "), F.array_join(F.slice(words, i, WINDOW), " ")).alias("gram")))
    full = "array<struct<place:int,size:int,gram:string>>"
    return F.concat(long.cast(full), same.cast(full))


def sparse_rows(rows: DataFrame, keys: list[str], longest: int) -> DataFrame:
    def cut(words):
        return let(sparse_windows(words, F.lit(longest)), lambda spans: F.transform(spans, lambda s: F.struct(s["place"].alias("place"), s["gram"].alias("gram"), F.slice(words, s["place"], s["size"]).alias("tokens"))))

    found = rows.select(*keys, F.explode(let(F.col("words"), cut)).alias("w"))
    return found.select(*keys, "w.place", "w.gram", "w.tokens")


def reported(met: DataFrame) -> DataFrame:
    """The leaks that the matched windows make: place, tokens, item_place and item_words of a document version and an item."""
    pairs = F.zip_with("item_words", "tokens", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    line = ["doc_id", "version", "form", "item_id", "item_tokens", "diagonal"]
    met = met.select("*", (F.col("place") - F.col("item_place")).alias("diagonal"), F.filter(pairs, lambda p: F.substring(p["item"], -1, 1) == CLOSE).alias("slots"))
    # a line is no longer than its item; repeated rows of a document share their ranks
    rank = F.dense_rank().over(Window.partitionBy(*line).orderBy("item_place"))
    runs = met.select(*line, "item_place", "slots", (F.col("item_place") - rank).alias("run")).groupBy(*line, "run").agg(
        (F.max("item_place") - F.min("item_place") + WINDOW).alias("run_tokens"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
    )
    long_enough = F.col("run_tokens") >= F.least(F.lit(MIN_RUN), F.col("item_tokens"))
    values = F.size(F.array_distinct(F.transform("slots", lambda s: s["item"])))
    fit = runs.filter(long_enough & (values == F.size("slots")))
    changed = F.exists("slots", lambda s: s["item"] != s["doc"])
    return fit.groupBy("doc_id", "item_id").agg(
        F.max(F.col("run_tokens").cast("bigint")).alias("run_tokens"),
        F.max(F.col("item_tokens").cast("bigint")).alias("item_tokens"),
        F.max(values.cast("bigint")).alias("n_slots"),
        F.bool_or(changed).alias("reworded"),
    )


def short_codes(words: Column, sizes: list[int]) -> Column:
    """place, size and gram of all windows of ``sizes`` tokens: by their template if they hold LITERALS plain words, else by their values."""

    def at(size: int) -> Column:
        last = F.size(words) - size + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))

        def one(i: Column) -> Column:
            cut = F.slice(words, i, size)
            rich = F.size(F.filter(cut, is_word)) >= LITERALS
            return F.struct(i.alias("place"), F.lit(size).alias("size"), cut.alias("tokens"), F.when(rich, F.concat(F.lit("S "), F.array_join(F.transform(cut, template), " "))).otherwise(F.concat(F.lit("W "), F.array_join(cut, " "))).alias("gram"))

        return F.transform(starts, one)

    return F.concat(*(at(size) for size in sizes))


def consistent(pairs: Column) -> Column:
    """Whether each placeholder value of the item stands for one value."""
    return F.size(F.array_distinct(F.transform(pairs, lambda s: s["item"]))) == F.size(pairs)


def short_leaks(slim: DataFrame, items: DataFrame) -> DataFrame:
    """The leaks of items that are met whole."""
    sizes = sorted(r[0] for r in items.select(F.size("words")).distinct().collect())  # at most WINDOW + STRIDE - 1 - SHORTEST sizes
    own = items.select("item_id", "form", F.col("words").alias("item_words"), F.explode(short_codes(F.col("words"), sizes)).alias("w"))
    own = materialize(own.select("item_id", "form", "item_words", "w.size", "w.gram").filter(F.size("item_words") == F.col("size")), "short")
    known = materialize(own.select(F.xxhash64("gram").alias("code")).distinct(), "codes")

    def codes(words):
        return F.transform(short_codes(words, sizes), lambda s: F.xxhash64(s["gram"]))

    raw = F.col("raw")
    seen = with_tokens(slim, ["doc_id"]).select("doc_id", F.explode(F.concat(let(as_plain(raw), codes), let(as_names(raw), codes))).alias("code"))
    able = materialize(seen.join(known, "code", "left_semi").select("doc_id").distinct(), "able")
    rows = in_forms(slim.join(able, "doc_id", "left_semi"), ["doc_id"])
    met = rows.select("doc_id", "form", F.explode(let(F.col("words"), lambda w: short_codes(w, sizes))).alias("w"))
    met = met.select("doc_id", "form", "w.gram", "w.tokens").join(own, ["gram", "form"])
    pairs = F.zip_with("item_words", "tokens", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    slots = F.array_distinct(F.filter(pairs, lambda p: F.substring(p["item"], -1, 1) == CLOSE))
    fit = met.select("doc_id", "item_id", F.size("item_words").cast("bigint").alias("n"), slots.alias("slots")).filter(consistent(F.col("slots")))
    changed = F.exists("slots", lambda s: s["item"] != s["doc"])
    return fit.groupBy("doc_id", "item_id").agg(F.max("n").alias("run_tokens"), F.max("n").alias("item_tokens"), F.max(F.size("slots").cast("bigint")).alias("n_slots"), F.bool_or(changed).alias("reworded"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """One row per (doc_id, item_id) of several reports."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("run_tokens", "item_tokens", "n_slots")), F.bool_or("reworded").alias("reworded"))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per (doc_id, item_id) that leaks: run_tokens, item_tokens, n_slots, reworded (some slot has another value)."""
    every = in_forms(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of("text").alias("text")), ["item_id"]).withColumn("item_tokens", F.size("words"))
    every = materialize(every.filter(F.col("item_tokens") >= SHORTEST), "items")
    items = every.filter(F.col("item_tokens") >= LONG)
    item_keys, doc_keys = ["item_id", "form", "item_tokens"], ["doc_id", "version", "form"]
    grams_of_items = windows(items, [*item_keys, "wordy"])
    rich = F.size(F.filter(F.slice("wordy", F.col("place"), WINDOW), lambda x: x)) >= LITERALS
    grams = materialize(grams_of_items.filter(rich).drop("wordy"), "grams").withColumnsRenamed({"place": "item_place", "tokens": "item_words"})
    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text")).filter(F.col("doc_id").isNotNull())

    # the written set of item windows has a known size: a small one is broadcast, a large one is shuffled with the windows
    known = materialize(grams.select(gram_code(F.col("gram")).alias("code")).distinct(), "codes")
    raw = with_tokens(slim, ["doc_id"])
    seen = raw.select("doc_id", F.explode(strided_grams(F.col("raw"))).alias("gram")).select("doc_id", F.xxhash64("gram").alias("code"))
    able = materialize(seen.join(known, "code", "left_semi").select("doc_id").distinct(), "able")

    def forms_of(ids: DataFrame) -> DataFrame:
        return in_forms(slim.join(ids, "doc_id", "left_semi").withColumn("version", F.xxhash64("text")), ["doc_id", "version"])

    def met_windows(rows: DataFrame) -> DataFrame:
        """The windows that are an item's; most are none and go before the shuffle, if the codes are broadcast."""
        met = windows(rows, doc_keys).withColumn("code", gram_code(F.col("gram")))
        return met.join(known, "code", "left_semi").drop("code").join(grams, ["gram", "form"])

    found = [reported(met_windows(forms_of(able)))]

    if not grams_of_items.filter(~rich).isEmpty():
        found = [materialize(found[0], "found")]
        longest = items.agg(F.max("item_tokens")).first()[0]
        sparse = materialize(sparse_rows(items, item_keys, longest), "sparse").withColumnsRenamed({"place": "item_place", "tokens": "item_words"})
        known_sparse = materialize(sparse.select(F.xxhash64("gram").alias("code")).distinct(), "codes")

        def poor_codes(words):
            return let(words, lambda w: F.transform(sparse_windows(w, F.lit(longest)), lambda s: F.xxhash64(s["gram"])))

        codes_of = F.concat(poor_codes(as_plain(F.col("raw"))), poor_codes(as_names(F.col("raw"))))
        able = materialize(raw.select("doc_id", F.explode(codes_of).alias("code")).join(known_sparse, "code", "left_semi").select("doc_id").distinct(), "able")
        rows = forms_of(able)
        wide = sparse_rows(rows, doc_keys, longest).join(sparse, ["gram", "form"])
        wide = wide.select("*", F.explode(F.sequence(F.lit(0), F.size("tokens") - WINDOW)).alias("k"))
        cut = [*doc_keys, "item_id", "item_tokens", (F.col("place") + F.col("k")).alias("place"), (F.col("item_place") + F.col("k")).alias("item_place")]
        wide = wide.select(*cut, *(F.slice(c, F.col("k") + 1, WINDOW).alias(c) for c in ("tokens", "item_words")))
        whole = met_windows(rows).select(wide.columns).unionByName(wide)
        found.append(reported(whole))
    short = every.filter(F.col("item_tokens") < LONG)
    if not short.isEmpty():
        found.append(short_leaks(slim, short))
    return merged(found) if len(found) > 1 else found[0]


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage."""
    return without(docs, leaks(docs, benchmark).select("doc_id"))


def _forms(source: str, keys: str) -> str:
    clean = f"translate(coalesce(text, ''), '{S_CLOSE_SIGN}{S_NUMBER_SIGN}{S_UNIT_SIGN}{S_NAME_SIGN}{S_MAYBE_SIGN}', '')"
    marked = f"regexp_replace({clean}, '{S_CAPITALS}', '\\1{S_MAYBE_SIGN}\\2{S_CLOSE_SIGN}', 'g')"
    named = f"lower(regexp_replace({marked}, '{S_NAME}', '\\1 {S_NAME_SIGN}', 'g'))"
    numbered = f"regexp_replace({named}, '{S_NUMBER}', ' {S_NUMBER_SIGN}\\1{S_CLOSE_SIGN} ', 'g')"
    units = f"regexp_replace({numbered}, '{S_UNIT}', '\\1 {S_UNIT_SIGN}\\2{S_CLOSE_SIGN}\\3', 'g')"
    own = f"(SELECT {keys}, regexp_extract_all({units}, '{S_TOKEN}') AS raw FROM {source})"
    wordy = f"list_transform(raw, lambda t: t[-1] <> '{S_CLOSE_SIGN}' OR t[1] = '{S_MAYBE_SIGN}')"
    plain = f"flatten(list_transform(raw, lambda t: CASE WHEN t[1] = '{S_MAYBE_SIGN}' THEN string_split(t[2:-2], ' ') ELSE [t] END))"
    names = f"list_transform(raw, lambda t: CASE WHEN t[1] = '{S_MAYBE_SIGN}' THEN '{S_NAME_SIGN}' || t[2:] ELSE t END)"
    first = f"SELECT *, list_transform(words, lambda t: t[-1] <> '{S_CLOSE_SIGN}') AS wordy FROM (SELECT *, 'plain' AS form, {plain} AS words FROM {own})"
    return f"{first} UNION ALL SELECT *, 'names', {names}, {wordy} FROM {own}"


_TOKENS = f"""SELECT * EXCLUDE (raw, words, wordy), words[place] AS word, wordy[place]::INT AS wordy, words[place][-1] <> '{S_CLOSE_SIGN}' AS plain,
  CASE WHEN words[place][-1] = '{S_CLOSE_SIGN}' THEN words[place][1] ELSE words[place] END AS kind FROM (SELECT *, unnest(range(1, len(words) + 1)) AS place FROM {{source}})"""
_GRAMS = f"""SELECT {{keys}}, size, array_to_string(list_transform(words[p : p + size - 1], lambda t: CASE WHEN t[-1] = '{S_CLOSE_SIGN}' THEN t[1] ELSE t END), ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM {{source}}, (SELECT unnest([{SHORTEST}, {WINDOW}]) AS size))"""
#: Texts that share a window with an item are compared with it token by token. Tokens of one kind that follow each other on a diagonal are a stretch. A window of it counts if it holds enough plain words, has the same values,
#: or has enough plain words from its first token to the end of the stretch or from the beginning of the stretch to its last token.
LEAK_SQL = f"""
item_words AS ({_forms("benchmark", "item_id")}),
item_tokens AS ({_TOKENS.format(source="(SELECT *, len(words) AS item_tokens FROM item_words)")}),
doc_words AS ({_forms("(SELECT DISTINCT doc_id, text FROM {docs} WHERE doc_id IS NOT NULL)", "doc_id, coalesce(text, '') AS version")}),
doc_tokens AS ({_TOKENS.format(source="(SELECT * FROM doc_words WHERE len(words) > 0)")}),
item_grams AS ({_GRAMS.format(keys="item_id, form, len(words) AS item_tokens", source="item_words")}),
pairs AS (SELECT DISTINCT doc_id, version, form, item_id FROM ({_GRAMS.format(keys="doc_id, version, form", source="doc_words")}) d JOIN item_grams i USING (form, size, gram)
  WHERE item_tokens >= {SHORTEST} AND size = CASE WHEN item_tokens < {WINDOW} THEN {SHORTEST} ELSE {WINDOW} END),
met AS (SELECT d.doc_id, d.version, form, i.item_id, i.item_tokens, d.place - i.place AS diagonal, i.place AS k, i.word AS a, d.word AS b, i.plain::INT AS plain, i.wordy
  FROM pairs JOIN doc_tokens d USING (doc_id, version, form) JOIN item_tokens i USING (item_id, form) WHERE d.kind = i.kind),
places AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, version, form, item_id, diagonal ORDER BY k) AS stretch FROM met),
sizes AS (SELECT doc_id, version, form, item_id, diagonal, stretch, count(*) AS n FROM places GROUP BY ALL),
long AS (SELECT p.*, n FROM places p JOIN sizes USING (doc_id, version, form, item_id, diagonal, stretch) WHERE n >= least({WINDOW}, item_tokens)),
sums AS (SELECT *, sum(plain) OVER up AS upto, sum(wordy) OVER up AS wordy_upto, sum((a <> b)::INT) OVER up AS other, sum(plain) OVER (PARTITION BY doc_id, version, form, item_id, diagonal, stretch) AS whole,
  max(k) OVER (PARTITION BY doc_id, version, form, item_id, diagonal, stretch) AS last FROM long
  WINDOW up AS (PARTITION BY doc_id, version, form, item_id, diagonal, stretch ORDER BY k)),
ends AS (SELECT doc_id, version, form, item_id, item_tokens, diagonal, stretch, k, whole, upto - plain AS before, wordy_upto - wordy AS wordy_before, lead(wordy_upto, {WINDOW - 1}) OVER step AS wordy_end, other - (a <> b)::INT AS other_before,
  lead(upto, {WINDOW - 1}) OVER step AS upto_end, lead(other, {WINDOW - 1}) OVER step AS other_end FROM sums
  WINDOW step AS (PARTITION BY doc_id, version, form, item_id, diagonal, stretch ORDER BY k)),
good AS (SELECT *, wordy_end - wordy_before >= {LITERALS} AS rich FROM ends WHERE item_tokens >= {LONG} AND upto_end IS NOT NULL
  AND (wordy_end - wordy_before >= {LITERALS} OR other_end = other_before OR whole - before >= {LITERALS} OR upto_end >= {LITERALS})),
ranked AS (SELECT *, k - row_number() OVER (PARTITION BY path, doc_id, version, form, item_id, diagonal ORDER BY k) AS run
  FROM (SELECT *, 'rich' AS path FROM good WHERE rich UNION ALL SELECT *, 'all' FROM good)),
runs AS (SELECT doc_id, version, form, item_id, item_tokens, diagonal, min(k) AS low, max(k) + {WINDOW - 1} AS high FROM ranked
  GROUP BY path, doc_id, version, form, item_id, item_tokens, diagonal, run
  UNION ALL SELECT doc_id, version, form, item_id, any_value(item_tokens), diagonal, 1, any_value(item_tokens) FROM sums
  WHERE item_tokens < {LONG} AND last - n = 0 AND n = item_tokens GROUP BY doc_id, version, form, item_id, diagonal, stretch
  HAVING any_value(whole) >= {LITERALS} OR max(other) = 0),
slots AS (SELECT DISTINCT r.doc_id, r.version, r.form, r.item_id, r.diagonal, low, high, a, b FROM runs r JOIN met m USING (doc_id, version, form, item_id, diagonal)
  WHERE k BETWEEN low AND high AND plain = 0),
filled AS (SELECT doc_id, version, form, item_id, diagonal, low, high, count(*) AS n_pairs, count(DISTINCT a) AS n_slots, bool_or(a <> b) AS reworded FROM slots GROUP BY ALL),
leaks AS (SELECT doc_id, item_id, max(high - low + 1) AS run_tokens, max(item_tokens) AS item_tokens, max(coalesce(n_slots, 0)) AS n_slots,
  bool_or(coalesce(reworded, false)) AS reworded FROM runs LEFT JOIN filled USING (doc_id, version, form, item_id, diagonal, low, high)
  WHERE high - low + 1 >= least({MIN_RUN}, item_tokens) AND coalesce(n_pairs = n_slots, true) GROUP BY doc_id, item_id)
"""
SQL = f"WITH {LEAK_SQL.replace('{docs}', 'documents')} SELECT * FROM leaks"
