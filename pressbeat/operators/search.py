"""Full-text search over a document table.

A query scans the text once, keeps per document its length and the counts of the query terms, and
scores from that narrow table. For repeated queries :func:`build_postings` gives an index that is
written sorted by term, so a query reads only the row groups of its terms.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.operators.ordered import BLOCK_BYTES
from pressbeat.storage import materialize, use_all_cores

# BM25 parameters.
K1, B = 1.2, 0.75
SEPARATORS = r"[^\p{L}\p{N}]+"
HAN_RUN = r"(\p{IsHan}+)"


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters and digits; runs of Han characters become overlapping pairs."""
    column = F.col(text) if isinstance(text, str) else text
    spaced = F.regexp_replace(F.lower(column), HAN_RUN, " $1 ")
    words = F.filter(F.split(spaced, SEPARATORS), lambda w: w != "")
    has_han = F.regexp_like(column, F.lit(r"\p{IsHan}"))

    def pairs(word: Column) -> Column:
        steps = F.sequence(F.lit(1), F.length(word) - 1)
        split = F.regexp_like(word, F.lit(r"^\p{IsHan}{2,}$"))
        return F.when(split, F.transform(steps, lambda at: F.substr(word, at, F.lit(2)))).otherwise(F.array(word))

    return F.when(has_han, F.flatten(F.transform(words, pairs))).otherwise(words)


def query_terms(query: str) -> list[str]:
    """The query cut by the same expression as the texts."""
    return list(SparkSession.active().range(1).select(tokens(F.lit(query)).alias("terms")).first()["terms"])


def inverted(words: Column) -> Column:
    """The terms of one document with their positions, made inside its row: sorted by (term, position) and cut where the term changes."""

    def once(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def cut(placed: Column) -> Column:
        size = F.size(placed)
        changes = F.filter(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: (i < size) & (F.get(placed, i)["term"] != F.get(placed, i - 1)["term"]))

        def terms(starts: Column) -> Column:
            def one(first: Column, k: Column) -> Column:
                run = F.slice(placed, first + 1, F.coalesce(F.get(starts, k + 1), size) - first)
                return F.struct(F.get(placed, first)["term"].alias("term"), F.transform(run, lambda x: x["at"]).alias("positions"))

            return F.transform(starts, one)

        return once(F.concat(F.array(F.lit(0)), changes), terms)

    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("term"), (i + 1).alias("at"))))
    return F.when(F.size(words) > 0, once(placed, cut))


def build_postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf, positions, doc_length); positions start at 1.

    Each row of ``docs`` is inverted by itself, so no single position is shuffled: what a writer sorts are whole postings.
    """
    cut = use_all_cores(docs.select(key, text)).select(key, tokens(text).alias("_tokens"))
    found = cut.select(key, F.size("_tokens").alias("doc_length"), F.explode(inverted(F.col("_tokens"))).alias("_p"))
    return found.select("_p.term", key, F.size("_p.positions").cast("bigint").alias("tf"), F.col("_p.positions").alias("positions"), "doc_length")


#: Bytes of a posting in memory besides its term and its positions.
POSTING_BYTES = 96


def index_blocks(postings: DataFrame) -> int:
    """One block per 128 MB that the postings take in memory, by their own terms and positions: they are many times the stored texts."""
    size = F.sum(F.lit(POSTING_BYTES) + F.octet_length("term") + F.size("positions") * 4)
    return max(4, int(postings.agg(size).first()[0] or 0) // BLOCK_BYTES)


def write_index(postings: DataFrame, key: str, path: str) -> None:
    """Sorted by (term, document): a term's rows are contiguous, and a common term spans several files.

    The postings are written unsorted first: the texts are cut once, not again for the range bounds, and the number of blocks follows the true size.
    """
    written = materialize(postings, "postings")
    ranged = written.repartitionByRange(index_blocks(written), "term", key)
    ranged.sortWithinPartitions("term", key).write.parquet(path)


def read_index(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("term").isin(*terms))


def term_statistics(postings: DataFrame) -> DataFrame:
    """Documents and occurrences per term."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences"))


def occurrences(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda word: word == F.lit(term))).cast("bigint")


def moved_back(positions: str, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def weighed(tf: Column, df: Column, length: Column, docs: Column, mean_length: Column) -> Column:
    """BM25 contribution of one term."""
    idf = F.log1p((docs - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def multi_match(docs: DataFrame, key: str, fields: Mapping[str, tuple[Column, float]], query: str, where: Column | None = None) -> DataFrame:
    """(key, score) of documents that hold a query term in any field; the score is that of the best field
    after its boost. All fields are counted in one scan.

    Collection statistics cover all documents; ``where`` only limits what is returned.
    """
    terms = list(dict.fromkeys(query_terms(query)))
    if not terms:
        raise ValueError("the query holds no term")
    names = {field: [f"_{field}_tf{i}" for i in range(len(terms))] for field in fields}
    wanted = where if where is not None else F.lit(True)
    cut = use_all_cores(docs).select(key, wanted.alias("_wanted"), *[tokens(text).alias(f"_{field}") for field, (text, _boost) in fields.items()])
    counted = [F.size(f"_{field}").cast("bigint").alias(f"_{field}_length") for field in fields]
    counted += [occurrences(f"_{field}", term).alias(name) for field in fields for term, name in zip(terms, names[field])]
    narrow = materialize(cut.select(key, "_wanted", *counted), "term-counts")
    facts = []
    for field in fields:
        length = F.col(f"_{field}_length")
        facts += [F.count_if(length > 0).alias(f"_{field}_docs"), F.avg(F.when(length > 0, length)).alias(f"_{field}_mean")]
        facts += [F.count_if(F.col(name) > 0).alias(f"{name}_df") for name in names[field]]
    statistics = narrow.agg(F.struct(*facts).alias("s")).scalar()
    any_term = reduce(lambda a, b: a | b, [F.col(name) > 0 for field in fields for name in names[field]])
    found = narrow.filter(F.col("_wanted") & any_term).withColumn("_s", statistics)
    scores = []
    for field, (_text, boost) in fields.items():
        of_field = [
            weighed(F.col(name), F.col(f"_s.{name}_df"), F.col(f"_{field}_length"), F.col(f"_s._{field}_docs"), F.col(f"_s._{field}_mean"))
            for name in names[field]
        ]
        hit = reduce(lambda a, b: a | b, [F.col(name) > 0 for name in names[field]])
        scores.append(F.when(hit, reduce(lambda a, b: a + b, of_field) * boost))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return found.select(key, best.alias("score"))


def match(docs: DataFrame, key: str, text: str, query: str, where: Column | None = None) -> DataFrame:
    """(key, score) of documents holding any query term."""
    return multi_match(docs, key, {"text": (F.col(text), 1.0)}, query, where)


def phrase(docs: DataFrame, key: str, text: str, query: str) -> DataFrame:
    """Documents in which the query's terms follow each other, with the number of occurrences.

    Tokens hold no blanks, so a text of tokens joined by blanks contains the joined phrase exactly
    when the terms are neighbours; positions are only counted in the documents found.
    """
    terms = query_terms(query)
    cut = use_all_cores(docs.select(key, text)).select(key, tokens(text).alias("_tokens"))
    joined = F.concat(F.lit(" "), F.array_join("_tokens", " "), F.lit(" "))
    found = cut.filter(F.contains(joined, F.lit(" " + " ".join(terms) + " ")))
    starts = F.sequence(F.lit(1), F.size("_tokens") - (len(terms) - 1))
    hits = F.filter(starts, lambda at: reduce(lambda a, b: a & b, [F.get("_tokens", at + (i - 1)) == F.lit(term) for i, term in enumerate(terms)]))
    return found.select(key, F.size(hits).alias("hits"))


def phrase_in_index(index: DataFrame, key: str, query: str) -> DataFrame:
    """The same from postings: positions of the i-th term, moved back by i, must coincide."""
    terms = query_terms(query)
    shifted = None
    for i, term in enumerate(terms):
        at = index.filter(F.col("term") == term).select(key, moved_back("positions", i).alias(f"_p{i}"))
        shifted = at if shifted is None else shifted.join(at, key)
    common = reduce(lambda a, b: F.array_intersect(a, b), [F.col(f"_p{i}") for i in range(len(terms))])
    return shifted.select(key, F.size(common).alias("hits")).filter("hits > 0")


LETTER = r"[\p{L}\p{N}]"


def whole_word(terms: Sequence[str], before: str = f"(?<!{LETTER})") -> str:
    words = "|".join(re.escape(term) for term in terms)
    return f"(?i){before}({words})(?!{LETTER})"


def marked(text: Column, terms: Sequence[str], pre: str = "<em>", post: str = "</em>") -> Column:
    """Whole-word occurrences of the terms put between the tags, in any case."""
    return F.regexp_replace(text, F.lit(whole_word(terms)), F.lit(f"{pre}$1{post}"))


def highlight(docs: DataFrame, key: str, text: str, query: str, size: int = 100, number: int = 1, pre: str = "<em>", post: str = "</em>") -> DataFrame:
    """Up to ``number`` marked fragments of each document that holds a query term as a whole word.

    A fragment reaches ``size`` / 2 characters to both sides of its first occurrence; the next one is
    looked for behind it.
    """
    terms, side = query_terms(query), size // 2
    longest = max(map(len, terms))
    left = use_all_cores(docs.select(key, F.col(text).alias("_rest"))).filter(F.regexp_like("_rest", F.lit(whole_word(terms))))
    later = whole_word(terms, r"(?<=[^\p{L}\p{N}])")
    for i in range(number):
        pattern = whole_word(terms) if i == 0 else later
        at = F.regexp_instr("_rest", F.lit(pattern))
        left = left.withColumn("_at", at)
        start = F.greatest(F.lit(1 if i == 0 else 2), F.col("_at") - side)
        end = F.col("_at") + longest + side
        part = F.when(F.col("_at") > 0, F.substr(F.col("_rest"), start, end - start))
        # one character before the rest stays, to tell whether a word starts there
        rest = F.when(F.col("_at") > 0, F.substr(F.col("_rest"), end - 1)).otherwise(F.lit(""))
        left = left.withColumns({f"_part{i}": part, "_rest": rest})
    parts = F.array_compact(F.array(*[marked(F.col(f"_part{i}"), terms, pre, post) for i in range(number)]))
    return left.select(key, parts.alias("fragments"))


def title_and_body(pages: DataFrame) -> DataFrame:
    """Page title and its text without markup, scripts and styles."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return pages.select(
        "page_id", F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1).alias("title"), F.regexp_replace(bare, r"<[^>]*>", " ").alias("body")
    )
