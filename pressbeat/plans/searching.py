"""Full-text search over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import ranking, search
from pressbeat.plans.base import query
from pressbeat.storage import scratch_path

CUT = "list_filter(string_split_regex(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
WORDS = "that with"


def bm25_sql(source, key, text, terms, wanted="TRUE"):
    """BM25 stated per term over a (key, text) relation."""
    tf = ", ".join(f"len(list_filter(t, lambda w: w = '{w}'))::BIGINT AS tf{i}" for i, w in enumerate(terms))
    stats = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    parts = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / mean))" for i in range(len(terms)))
    any_term = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    return f"""SELECT {key}, {parts} AS score FROM (SELECT *, len(t)::BIGINT AS dl, {tf} FROM (SELECT *, {CUT.format(text)} AS t FROM {source})),
 (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS mean, {stats} FROM (SELECT t, {tf} FROM (SELECT {CUT.format(text)} AS t FROM {source})))
 WHERE ({any_term}) AND {wanted}"""


POSTINGS = f"""SELECT term, doc_id, count(*) AS tf, string_agg(pos, ',' ORDER BY pos) AS positions, max(dl)::INTEGER AS doc_length FROM (
 SELECT doc_id, unnest(t) AS term, unnest(range(1, len(t) + 1)) AS pos, len(t) AS dl FROM (SELECT doc_id, {CUT.format('text')} AS t FROM documents)) GROUP BY term, doc_id"""


@query("fts_postings", POSTINGS)
def _(t):
    postings = search.build_postings(t.docs, "doc_id", "text")
    return postings.withColumn("positions", F.array_join(F.transform("positions", lambda p: p.cast("string")), ","))


@query("fts_term_statistics", f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences FROM ({POSTINGS}) GROUP BY term")
def _(t):
    return search.term_statistics(search.build_postings(t.docs, "doc_id", "text"))


@query("fts_term", "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'fr'")
def _(t):
    return t.docs.filter(F.col("lang") == "fr").select("doc_id", "source", "n_chars")


@query("fts_tag", "SELECT post_id, title FROM articles WHERE list_contains(string_split(tags, ', '), 'ring')", "articles")
def _(t):
    return t.articles.filter(F.array_contains(F.split("tags", ", "), "ring")).select("post_id", "title")


@query("fts_range", "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars >= 5000")
def _(t):
    return t.docs.filter(F.col("n_chars") >= 5000).select("doc_id", "lang", "n_chars").orderBy(F.desc("n_chars"), "doc_id")


@query("fts_match", f"SELECT doc_id, round(score, 6) AS score FROM ({bm25_sql('documents', 'doc_id', 'text', WORDS.split())})")
def _(t):
    return search.match(t.docs, "doc_id", "text", WORDS).withColumn("score", F.round("score", 6))


@query("fts_match_top", f"SELECT doc_id, round(score, 6) AS score FROM ({bm25_sql('documents', 'doc_id', 'text', WORDS.split())}) ORDER BY round(score, 6) DESC, doc_id LIMIT 10")
def _(t):
    scored = search.match(t.docs, "doc_id", "text", WORDS).withColumn("score", F.round("score", 6))
    return ranking.top_n(scored, 10, F.desc("score"), "doc_id")


@query("fts_bool", f"SELECT doc_id, round(score, 6) AS score FROM ({bm25_sql('documents', 'doc_id', 'text', ['les', 'dans'], wanted=chr(39).join(['lang = ', 'fr', '']))})")
def _(t):
    scored = search.match(t.docs, "doc_id", "text", "les dans", where=F.col("lang") == "fr")
    return scored.withColumn("score", F.round("score", 6))


PAGE_TEXT = r"""(SELECT page_id, regexp_extract(html, '(?is)<title>([^<]*)</title>', 1) AS title,
 regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g') AS body FROM pages)"""


@query("fts_multi_match", f"""
SELECT coalesce(a.page_id, b.page_id) AS page_id, round(greatest(a.score * 3, b.score), 6) AS score
FROM ({bm25_sql(PAGE_TEXT, 'page_id', 'title', ['the', 'und'])}) a FULL JOIN ({bm25_sql(PAGE_TEXT, 'page_id', 'body', ['the', 'und'])}) b ON a.page_id = b.page_id""")
def _(t):
    pages = search.title_and_body(t.raw("pages"))
    scored = search.multi_match(pages, "page_id", {"title": (F.col("title"), 3.0), "body": (F.col("body"), 1.0)}, "the und")
    return scored.withColumn("score", F.round("score", 6))


PHRASE = f"""SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'with' AND t[i + 1] = 'the'))::INTEGER AS hits
 FROM (SELECT doc_id, {CUT.format('text')} AS t FROM documents) WHERE hits > 0"""


@query("fts_phrase", PHRASE)
def _(t):
    return search.phrase(t.docs, "doc_id", "text", "with the")


@query("fts_phrase_index", PHRASE)
def _(t):
    path = scratch_path(t.spark, "index")
    search.write_index(search.build_postings(t.docs, "doc_id", "text"), "doc_id", path)
    return search.phrase_in_index(search.read_index(t.spark, path, ["with", "the"]), "doc_id", "with the")


# a consumed separator can hide the next occurrence, hence a second pass that leaves marked words alone
MARK = r"regexp_replace({}, '(?i)(^|[^\p{{L}}\p{{N}}])(that)($|[^\p{{L}}\p{{N}}])', '\1<em>\2</em>\3', 'g')"
MARK_REST = MARK.replace("(^|[^\\p{{L}}\\p{{N}}])", "(^|[^\\p{{L}}\\p{{N}}<>])")


FIRST_AT = r"length(regexp_extract({0}, '(?is)^(|.*?[^\p{{L}}\p{{N}}])that(?:[^\p{{L}}\p{{N}}]|$)', 1)) + 1"
LATER_AT = r"length(regexp_extract({0}, '(?is)^(.*?[^\p{{L}}\p{{N}}])that(?:[^\p{{L}}\p{{N}}]|$)', 1)) + 1"


@query("fts_highlight", rf"""
SELECT doc_id, concat_ws(' ... ', {MARK_REST.format(MARK.format('part1'))}, {MARK_REST.format(MARK.format('part2'))}) AS fragments FROM (
 SELECT doc_id, part1, CASE WHEN at2 > 1 THEN substr(rest, greatest(2, at2 - 50), at2 + 54 - greatest(2, at2 - 50)) END AS part2 FROM (
  SELECT *, {LATER_AT.format('rest')} AS at2 FROM (
   SELECT doc_id, substr(text, greatest(1, at1 - 50), at1 + 54 - greatest(1, at1 - 50)) AS part1, substr(text, at1 + 53) AS rest FROM (
    SELECT *, {FIRST_AT.format('text')} AS at1 FROM documents WHERE regexp_matches(text, '(?is)(^|[^\p{{L}}\p{{N}}])that([^\p{{L}}\p{{N}}]|$)')))))""")
def _(t):
    shown = search.highlight(t.docs, "doc_id", "text", "that", size=100, number=2)
    return shown.withColumn("fragments", F.array_join("fragments", " ... "))
