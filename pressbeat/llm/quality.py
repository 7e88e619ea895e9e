"""Quality rules whose limits come from the data: mergeable quantile sketches per language and source.

A sketch is a count per bucket of a whole-number measure; sketches merge by adding counts, so tasks, sources and languages combine
in any order with the same result. Measures below 256 have a bucket each, larger ones keep eight leading bits, which bounds a
sketch's size and its relative error. Of each (language, source) the quartiles give an upper fence. Its sketch is blended with those of its language
and of all documents, each scaled to PRIOR documents, so fences change steadily with the size of a group. The fences are joined to the documents, and a
document above any fence, or failing the base rules, is not kept. A measure that most documents have nothing of has quartiles of zero; there SLACK,
the least spread of each measure, sets the fence.

A null text has no words and fails; an empty text too. A null language or source counts as the empty name. Equal rows get equal
verdicts, ties at a fence are kept, an empty table gives an empty result. Only the named columns of the input are read, so
extra columns may have any name. Words found three in a row twice are compared by 64-bit hashes of the three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressbeat.llm.common import SPACES, free_name, let, materialize, text_of, words_of

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: measure -> the least spread above the upper quartile; shares in thousandths, word length in tenths.
SLACK = {"symbol_share": 50, "dup_line_share": 300, "capital_share": 200, "word_length": 40}
SPREADS = 4
PRIOR, UNIT = 50, 1000


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of three words that the text holds twice or more."""

    def among(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(sorted_: Column) -> Column:
            def equal(x, k):
                return (x["h"] == F.get(sorted_, k - 1)["h"]) | (x["h"] == F.get(sorted_, k + 1)["h"])

            at = F.sort_array(F.transform(F.filter(sorted_, equal), lambda x: x["i"]))
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
            step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"))
            return F.aggregate(at, start, step, lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(placed, covered))

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
        return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(let(hashes, among))

    return let(words, windows)


def counts(text: Column) -> dict[str, Column]:
    """The counts that cost one look at the text: words are left to :func:`base_counts`."""
    bare = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    return {
        "word_chars": F.length(bare).cast("bigint"),
        "n_words": F.size(words_of(text)).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_capitals": (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("bigint"),
        "lines": let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("all"), F.size(F.array_distinct(x)).cast("bigint").alias("distinct"))),
    }


def measures(c: dict[str, Column]) -> dict[str, Column]:
    """The measures the fences bound, as whole numbers."""

    def share(part: Column, whole: Column, scale: int) -> Column:
        return F.floor(part * scale / F.greatest(whole, F.lit(1))).cast("bigint")

    return {
        "symbol_share": share(c["n_symbols"], c["word_chars"], 1000),
        "dup_line_share": share(c["lines"]["all"] - c["lines"]["distinct"], c["lines"]["all"], 1000),
        "capital_share": share(c["n_capitals"], c["word_chars"], 1000),
        "word_length": share(c["word_chars"], c["n_words"], 10),
    }


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket: itself below 256, else its eight leading binary digits."""
    shift = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts per (lang, source, measure, bucket) over all documents; one shuffle of sketches, not of documents."""
    c = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), text_of(text).alias("text"))
    found = c.select("lang", "source", *(v.alias(k) for k, v in counts(F.col("text")).items()))
    listed = F.array(*(F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in measures({k: F.col(k) for k in found.columns}).items()))
    return found.select("lang", "source", F.explode(listed).alias("m")).groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source) with a fence for each measure, from the quartiles of its blended sketch.

    The blend is the group's own sketch, that of its language scaled to PRIOR documents, and that of all scaled likewise; counts are kept in
    whole units of a UNIT-th document. So a group of few documents has nearly the fences of its language, and they become its own steadily as it grows.
    """
    by_lang = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    overall = by_lang.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))

    def scaled(level: DataFrame, keys: list[str]) -> DataFrame:
        rows = F.sum("n").over(Window.partitionBy(*keys))
        return level.withColumn("rows", rows).select(*keys, "bucket", F.expr(f"n * {PRIOR * UNIT} div rows").alias("weight"))

    groups = sketch.select("lang", "source", "measure").distinct()
    parts = [
        sketch.select("lang", "source", "measure", "bucket", (F.col("n") * UNIT).alias("weight")),
        groups.join(scaled(by_lang, ["lang", "measure"]), ["lang", "measure"]).select("lang", "source", "measure", "bucket", "weight"),
        groups.join(scaled(overall, ["measure"]), "measure").select("lang", "source", "measure", "bucket", "weight"),
    ]
    keys = ["lang", "source", "measure"]
    blend = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*keys, "bucket").agg(F.sum("weight").alias("weight"))
    # a sketch has a bounded number of buckets, so a window over one holds a bounded number of rows
    run = blend.withColumns({"upto": F.sum("weight").over(Window.partitionBy(*keys).orderBy("bucket")), "rows": F.sum("weight").over(Window.partitionBy(*keys))})
    quarter = {q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("bucket"))) for q in (1, 3)}
    slack = F.element_at(F.create_map(*(F.lit(x) for k, v in SLACK.items() for x in (k, v))), F.col("measure"))
    edges = run.groupBy(*keys).agg(quarter[1].alias("q1"), quarter[3].alias("q3"))
    limits = edges.select("lang", "source", "measure", (F.col("q3") + F.greatest(slack, (F.col("q3") - F.col("q1")) * SPREADS)).alias("fence"))
    return limits.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == k, F.col("fence"))).alias(f"{k}_fence") for k in SLACK))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with one new struct column ``verdict`` (or a longer name, the last column) of counts, base_failed and kept.

    The sketches are written once, since three levels are made of them. The fences are written too, so that their size is known when the join is planned: a small table is broadcast, a large one
    is shuffled with the documents.
    """
    limits = materialize(fences(materialize(sketches(docs, text, lang, source), "sketches")), "fences")
    limits = limits.select(F.struct("lang", "source").alias("group"), F.struct(*(c for c in limits.columns if c.endswith("_fence"))).alias("limit"))
    name, group = free_name(docs, "verdict"), "group_of_limits"
    own = F.struct(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"))
    c = counts(text_of(text))
    counted = docs.select("*", F.struct(*(v.alias(k) for k, v in c.items()), repeated_words(words_of(text_of(text))).alias("n_repeat_words")).alias(name))
    seen = {k: F.col(name)[k] for k in c}
    base_failed = (seen["n_words"] < 50) | (F.col(name)["n_repeat_words"] * 100 > seen["n_words"] * 50)
    within = F.lit(True)
    for k, v in measures(seen).items():
        within &= v <= F.col("limit")[f"{k}_fence"]
    left = counted.withColumn(free_name(counted, group), own)
    joined = left.join(limits, left[left.columns[-1]] == limits["group"], "left")
    fields = ["n_words", "word_chars", "n_symbols"]
    verdict = F.struct(
        *(seen[k].alias(k) for k in fields),
        (seen["lines"]["all"] - seen["lines"]["distinct"]).alias("n_dup_lines"),
        F.col(name)["n_repeat_words"].alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        (~base_failed & within).alias("kept"),
    )
    return joined.select(*(left[k] for k in docs.columns), verdict.alias(name))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed and kept."""
    slim = docs.select("doc_id", "text", "lang", "source")
    return judged(slim).select(F.col("doc_id").cast("bigint").alias("doc_id"), "verdict.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are."""
    found = judged(docs)
    return found.filter(F.col(found.columns[-1])["kept"]).select(*(found[k] for k in docs.columns))


_GAP = "[^\\x20\\x09-\\x0D]"
_BARE = "translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
VERDICT_SQL = f"""
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
l AS (SELECT *, regexp_extract_all(t, '{_GAP}+') AS w, length({_BARE}) AS word_chars, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
  length(t) - length(translate(t, '{CAPITALS}', '')) AS n_capitals,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_GAP}')) AS lines FROM d),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM l)),
p AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM g WHERE n > 1) GROUP BY r),
c AS (SELECT l.r, doc_id, lang, source, len(w) AS n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, n_symbols * 1000 // greatest(word_chars, 1) AS symbol_share,
  (len(lines) - len(list_distinct(lines))) * 1000 // greatest(len(lines), 1) AS dup_line_share,
  n_capitals * 1000 // greatest(word_chars, 1) AS capital_share, word_chars * 10 // greatest(len(w), 1) AS word_length FROM l LEFT JOIN p USING (r)),
m AS (SELECT r, lang, source, unnest([{", ".join(f"'{k}'" for k in SLACK)}]) AS measure, unnest([{", ".join(SLACK)}]) AS v FROM c),
b AS (SELECT *, v >> greatest(length(bin(v)) - 8, 0) << greatest(length(bin(v)) - 8, 0) AS bucket FROM m),
s AS (SELECT lang, source, measure, bucket, count(*) AS n FROM b GROUP BY ALL),
s1 AS (SELECT *, sum(n) OVER (PARTITION BY lang, measure) AS tot FROM (SELECT lang, measure, bucket, sum(n) AS n FROM s GROUP BY ALL)),
s2 AS (SELECT *, sum(n) OVER (PARTITION BY measure) AS tot FROM (SELECT measure, bucket, sum(n) AS n FROM s GROUP BY ALL)),
g0 AS (SELECT DISTINCT lang, source, measure FROM s),
e AS (SELECT lang, source, measure, bucket, sum(k) AS n FROM (SELECT lang, source, measure, bucket, n * {UNIT} AS k FROM s
  UNION ALL SELECT g0.lang, source, g0.measure, bucket, n * {PRIOR * UNIT} // tot FROM g0 JOIN s1 USING (lang, measure)
  UNION ALL SELECT lang, source, g0.measure, bucket, n * {PRIOR * UNIT} // tot FROM g0 JOIN s2 USING (measure)) GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS tot FROM e),
q AS (SELECT lang, source, measure, min(bucket) FILTER (upto * 4 >= tot) AS q1, min(bucket) FILTER (upto * 4 >= tot * 3) AS q3 FROM u GROUP BY ALL),
x AS (SELECT lang, source, measure, q3 + greatest(CASE measure {" ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items())} END, (q3 - q1) * {SPREADS}) AS fence FROM q),
z AS (SELECT b.r, bool_and(b.v <= x.fence) AS within FROM b JOIN x USING (lang, source, measure) GROUP BY b.r),
verdicts AS (SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND within AS kept FROM c JOIN z USING (r))
"""
SQL = f"WITH {VERDICT_SQL} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts"
