"""Each operator against brute force, its edge cases, and the pipeline stage by stage."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pressbeat.llm import bpe, chat, hmm, html_blocks, near_dup, pii, quality, queries, templates, token_store, toxicity

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", body)]
    return "\n".join(b for b in blocks if b)


def test_pages_against_their_article_element(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.op1_main_text(spark, sf).collect()
    assert len(found) == len(pages)
    assert all(r.text == article(pages[r.page_id]) and r.n_chars == len(r.text) for r in found)
    model = html_blocks.Labeller()
    assert html_blocks.main_text([None, "", "<", "<p", "<script>var a='<p>'", "</p></div>"], model)[0] == ("", 0)
    other = "<body><div class='menu'><a href='/'>Home</a></div><main><h1>Big day</h1><p>It rained &amp; it shone all day long.</p></main><div class='comments'><p>I was there.</p></div></body>"
    trained = html_blocks.train(spark.read.parquet(f"{sf}/pages.parquet"))
    assert html_blocks.main_text([other], trained)[0][0] == "Big day\nIt rained & it shone all day long."


def test_token_store(spark, sf, odd):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = 0
    for r in sorted(queries.op2_token_store(spark, sf).collect()):
        ids = [*coder.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    rows = token_store.store_and_read(odd, WORDS, segment_bytes=64).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 5, 6, 7] and rows[1].n_tokens == rows[2].n_tokens == 1
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert token_store.store_and_read(odd.limit(0), WORDS).collect() == []


def test_token_ids_are_the_librarys():
    """Random texts with special strings, signs, accents and white space; and a vocabulary of another kind is encoded whole."""
    from tokenizers import Tokenizer

    coder, pieces = Tokenizer.from_file(WORDS), token_store.Pieces(WORDS)
    assert pieces.apart and set(pieces.special) == {"<|startoftext|>", "<|endoftext|>"}
    rng = random.Random(5)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "Word", "don't", " ", "  ", "\n", "\t", "e\u0301", "ÉÀ", "12", ".", "!?", "ー字", "<|EndOfText|>", "\u00a0", "x"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)]
    for other in (True, False):
        for text in texts:
            assert np.frombuffer(token_store.packed(text, pieces), f"<u{pieces.width}").tolist() == coder.encode(text, add_special_tokens=False).ids
        pieces.apart = False


@pytest.mark.parametrize("seed", range(20))
def test_elias_fano_select(seed):
    rng = random.Random(seed)
    values = np.cumsum([rng.choice([0, 0, 1, 5, 1000, 70000]) for _ in range(rng.randint(1, 400))])
    coded, _ = token_store.EliasFano.load(memoryview(token_store.EliasFano.of(values).dump()), 0)
    assert [coded.select(i) for i in range(len(values))] == values.tolist()


def template_leaks(docs, bench):
    """The report, after a look at whether the SQL gives the same."""
    found = templates.leaks(docs, bench).collect()
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    con.register("benchmark", bench.select("item_id", "text").toArrow())
    told = con.execute(templates.SQL)
    names = [d[0] for d in told.description]
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(told.fetchall())
    return {(r.doc_id, r.item_id): r for r in found}


def test_templates_find_reworded_items(spark):
    item = "A train leaves Boston at 7 hours and travels 120 km before it meets the other train from Boston near the old bridge"
    moved = item.replace("120", "345").replace("Boston", "Paris Nord")
    pair = "the slow red train from Boston always waits for the fast green train from Boston near the old bridge"
    mixed, both = pair.replace("Boston near", "Rome near"), pair.replace("Boston", "Rome")
    rows = [(1, f"Some words before. {item} and after"), (2, f"words {moved} more"), (3, f"words {mixed}"), (6, f"words {both}"), (4, "A train leaves and nothing else is the same here at all"), (5, None), (None, item)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(9, item), (8, pair), (10, None), (11, "too short"), (12, "")], "item_id bigint, text string")
    found = {d: r for (d, _), r in template_leaks(docs, bench).items()}
    assert set(found) == {1, 2, 6}  # in 3 one name stands for two
    assert found[2].reworded and not found[1].reworded and found[1].n_slots == 6
    assert {r.doc_id for r in templates.without_leaks(docs, bench).collect()} == {3, 4, 5, None}
    assert templates.without_leaks(docs.limit(0), bench).columns == docs.columns


def test_templates_find_names_that_begin_sentences(spark):
    item = "Tom has 5 red apples. Mary has 3 green ones. Together they give 2 to Tom. How many are left?"
    other = "Ann Lee has 7 red apples. Sue has 4 green ones. Together they give 1 to Ann Lee. How many are left?"
    start = "Robert walks to the old market every day and buys six fresh rolls there"
    rows = [(1, f"Quiz.\n{other}"), (3, f'"{item}"'), (4, start.replace("Robert", "Linda")), (5, "see: " + start), (6, "they say Robert walks to the old market every day and buys six fresh rolls there"), (7, start.lower()), (8, "Tom has 5 red apples. Nothing else."), (9, item.upper())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item), (2, start)], "item_id bigint, text string")
    found = {k: r.reworded for k, r in template_leaks(docs, bench).items()}
    assert found == {(1, 1): True, (3, 1): False, (4, 2): True, (5, 2): False, (6, 2): False, (7, 2): False}


def test_templates_find_items_of_few_plain_words(spark):
    mean = "Compute the mean of 3 5 7 9 11 13 15 17 19 21"
    last = "1 2 3 4 5 6 7 8 9 sum them all"
    sums = "30 + 41 + 52 + 63 + 74 + 85 + 96 + 107 + 118 + 129"
    moved = mean.translate(str.maketrans("3579", "4682"))
    rows = [(1, f"before. {mean} after"), (2, f"x {moved} y"), (3, f"see {sums} there"), (4, "take " + sums.replace("74", "75")), (5, f"and {last}"), (6, "and 21 22 23 24 25 26 27 28 29 sum them all"), (7, "Compute the sum of 3 5 7 9 11"), (8, "the mean of 3 5 7 9"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, mean), (2, sums), (3, last)], "item_id bigint, text string")
    found = {k: r.reworded for k, r in template_leaks(docs, bench).items()}
    assert found == {(1, 1): False, (2, 1): True, (3, 2): False, (5, 3): False, (6, 3): True}


def test_templates_find_short_items(spark):
    items = [(1, "What is 12 times 11 then?"), (2, "Who wrote the book Emma?"), (3, "3 + 4 + 5"), (4, "Hot day"), (5, "one two three four five six seven")]
    rows = [(1, "x what is 30 times 20 then y"), (2, "What is 12 times 11 now"), (3, "so who wrote the book Persuasion? nobody"), (4, "sum 3 + 4 + 5 = 12"), (5, "sum 3 + 4 + 6 = 13"), (6, "a hot day"), (7, "zero one two three four five six seven eight"), (8, "one two three four five six eight"), (9, ""), (10, "one two three four five six seven " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {k: (r.reworded, r.run_tokens) for k, r in template_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).items()}
    assert found == {(1, 1): (True, 6), (3, 2): (True, 5), (4, 3): (False, 3), (7, 5): (False, 7), (10, 5): (False, 7)}
    assert templates.leaks(docs.limit(0), spark.createDataFrame(items, "item_id bigint, text string")).collect() == []
    assert templates.leaks(docs, spark.createDataFrame([], "item_id bigint, text string")).collect() == []


def test_quality_edges(spark, odd):
    found = quality.verdicts(odd).collect()
    assert len(found) == odd.count() and not any(r.kept for r in found)
    long = next(r for r in found if r.doc_id == 6)
    assert long.n_words == long.n_repeat_words == 30000 and long.base_failed
    assert quality.keep_good(odd).columns == odd.columns and quality.verdicts(odd.limit(0)).collect() == []


def test_quality_fences_follow_the_data(spark):
    rng = random.Random(3)
    plain = [(i, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)), "en", "s") for i in range(300)]
    loud = [(1000 + i, t.replace(" ", "### "), k, s) for i, (_, t, k, s) in enumerate(plain[:30])]
    other = [(2000 + i, t.replace(" ", "### "), k, "code") for i, (_, t, k, s) in enumerate(plain)]
    kept = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(plain + loud + other, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(30)) and all(kept[2000 + i] for i in range(300))


@pytest.mark.parametrize("n", [60, 199, 200, 201])
def test_quality_has_no_switch_at_a_size(spark, n):
    """A source of one loud kind beside plain ones is kept as a whole from some size on, the same just below and above any round number."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)) for _ in range(600)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(1000 + i, t.replace(" ", "### "), "en", "code") for i, t in enumerate(texts[:n])]
    rows += [(5000 + i, t.replace(" ", "### "), "en", "few") for i, t in enumerate(texts[:8])]
    kept = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(600)) and all(kept[1000 + i] for i in range(n)) and not any(kept[5000 + i] for i in range(8))


def test_chat_round_trip():
    rng = random.Random(2)
    bits = [*chat.CONTROLS, "\\", "x", "y", " ", "<", "[", "é", "\n", ""]
    for _ in range(3000):
        said = [(rng.choice(["user", "assistant", "system", "tool", "", "<s>"]), "".join(rng.choices(bits, k=rng.randint(0, 6)))) for _ in range(rng.randint(0, 5))]
        text, turns, rewritten = chat.render(said)
        assert not rewritten and chat.read_back(text, [t._asdict() for t in turns]) == said


def test_chat_reports_rewritten_history():
    def forgetful(messages):
        return "".join(f"<{r}>{t if i == len(messages) - 1 else t[:1]}</{r}>" for i, (r, t) in enumerate(messages))

    text, turns, rewritten = chat.render([("user", "a"), ("assistant", "bcd"), ("user", "e")], forgetful)
    assert rewritten == [2] and turns[1].text_start == -1 and text[turns[0].text_start : turns[0].text_end] == "a"


def test_chat_query(spark, sf):
    said = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        said[r.conv_id].append((r.role, r.text or ""))
    said[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    found = queries.op5_chat_format(spark, sf).collect()
    assert len(found) == len(said)
    for r in found:
        turns = said[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()


def test_hidden_markov_scores(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    low = str.maketrans(hmm.UPPER + "\t\n\x0b\x0c\r", hmm.LOWER + "     ")
    tokens = {r.doc_id: [*hmm.words_in((r.text or "").translate(low)), ""] for r in docs.collect()}
    seen = Counter(w for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in t)
    total, distinct = sum(seen.values()), len(seen)
    found = queries.op6_hidden_markov(spark, sf).collect()
    for r in found:
        base = sum(math.log10((seen[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.train_tokens == total
        assert r.n_known == sum(seen[w] > 0 for w in tokens[r.doc_id])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert len(hmm.scores(odd).collect()) == odd.count() and hmm.scores(odd.limit(0)).collect() == []


def test_forward_recursion_sums_all_paths():
    model = hmm.Model.first(np.full(hmm.SYMBOLS, 1 / hmm.SYMBOLS), 4)
    for seq in ([5], [1, 7, 2], [3, 3, 9, 2]):
        paths = product(range(hmm.STATES), repeat=len(seq))
        want = sum(model.start[p[0]] * math.prod(model.move[a, b] for a, b in zip(p, p[1:])) * math.prod(model.emit[s, k] for s, k in zip(seq, p)) for p in paths)
        got = hmm.log_likelihoods([np.array([1]), np.array(seq), np.array([2, 2])], model)[1]
        assert got == pytest.approx(math.log10(want), rel=1e-9)


def test_toxicity_learns_words(spark, odd):
    rng = random.Random(6)
    filler = lambda: " ".join("".join(rng.choices("aeinorst", k=5)) for _ in range(40))
    bad = {i: i % 5 == 0 for i in range(600)}
    rows = [(i, f"{filler()} {'you utter moron' if b else 'you kind friend'} {filler()}") for i, b in bad.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(b), None) for i, b in bad.items()] + [(None, 1, 1), (3, None, 1)], "doc_id bigint, toxic int, quality int")
    found = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    held = [r for r in found if r.held_out]
    assert held and all((r.predicted == 1) == bad[r.doc_id] for r in held) and all(0 <= r.score <= 1 for r in found)
    none = toxicity.train(docs, labels.limit(0))
    assert len(toxicity.score(odd, none).collect()) == odd.count()


def test_expectations_are_sums_over_all_paths(monkeypatch):
    """Baum-Welch sums of sequences longer and shorter than a piece against all state paths, one by one."""
    monkeypatch.setattr(hmm, "PIECE", 2)
    rng = np.random.default_rng(6)
    model = hmm.Model.first(rng.dirichlet(np.ones(hmm.SYMBOLS)), 4)
    model = model._replace(start=rng.dirichlet(np.ones(hmm.STATES)))
    sequences = [np.array(q) for q in ([3, 9, 3, 700, 3], [9], [700, 3, 3], [5, 5, 9, 9])]
    started, moved, emitted = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.SYMBOLS, hmm.STATES))
    for q in sequences:
        paths = np.array(list(product(range(hmm.STATES), repeat=len(q))))
        chance = model.start[paths[:, 0]] * model.emit[q[0], paths[:, 0]]
        for t in range(1, len(q)):
            chance = chance * model.move[paths[:, t - 1], paths[:, t]] * model.emit[q[t], paths[:, t]]
        chance /= chance.sum()
        np.add.at(started, paths[:, 0], chance)
        for t in range(len(q)):
            np.add.at(emitted[q[t]], paths[:, t], chance)
            if t:
                np.add.at(moved, (paths[:, t - 1], paths[:, t]), chance)
    assert np.allclose(hmm.expectations(sequences, model), np.concatenate([started, moved.ravel(), emitted.ravel()]))
    assert not hmm.expectations([], model).any()


def test_frequent_words_are_those_above_a_count(spark):
    counts = spark.createDataFrame([(f"w{k}", 1 + k // 3 if k < 900 else 100_000 + k) for k in range(1000)], "word string, c bigint")
    for most in (0, 99, 100, 150, 1000):
        least = hmm.least_count(counts, most)
        n = counts.filter(F.col("c") >= least).count()
        assert n <= most and (least >= 1 << 40 or n > 0.9 * most - 130)
    assert hmm.least_count(counts.limit(0)) == 1 << 62


def base_entities(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in m[0] if x.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def test_base_entities(spark):
    rng = random.Random(4)
    bits = ["a", "b@", "c.d", "@", ".", "-", "_", "%", "1", "2", "25", "255", "256", ".1", "+", "+1", " ", "  ", "(", ")", "4111111111111111", "4111 1111 1111 1111", "0", "é"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(2000)] + ["1" * 30000, "a" * 30000 + "@", "1 " * 9000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).select("doc_id", pii.base_spans(F.col("text")).alias("b")).collect()
    assert all([(s.kind, s.start, s.end) for s in r.b] == base_entities(texts[r.doc_id]) for r in rows)


def test_contexts_discover_identifiers(spark, odd):
    seeds = [(i, f"Please call me at +1 (323) 555-{1000 + i} tomorrow. It was 20{i:02d} then.") for i in range(30)]
    docs = spark.createDataFrame(seeds + [(99, "Please call me at 415-555-0199 tomorrow."), (100, "The years 415-555-0100 went by."), (101, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.reports(docs).collect()}
    assert found[99].spans == "phone:18:30" and found[99].n_phone == 0 and found[100].spans == found[101].spans == ""
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[99] == "Please call me at [PHONE] tomorrow." and clean[0].startswith("Please call me at [PHONE] tomorrow.") and clean[101] is None
    assert pii.redacted(odd).columns == odd.columns and pii.redacted(odd).count() == odd.count() and pii.reports(odd.limit(0)).collect() == []


def test_identifiers_in_groups_and_long_words(spark):
    """Numbers written in groups are found whole, in contexts learned from seeds; words of contexts are whole."""
    word = "extraordinarily" * 5
    seeds = [(i, f"Please call me at +1 (323) 555-{1000 + i} tomorrow.") for i in range(30)] + [(50 + i, f"My {word} number +49 30 555 {1000 + i} is new.") for i in range(10)]
    rows = [(90, "Please call me at (415) 555-0199 tomorrow."), (91, "Please call me at 415 555 0199, tomorrow."), (92, f"My {word} number 030 555 4321 is new."), (93, "My " + "x" * 75 + " number 040 555 9999 was it."), (94, "call me at 12 tomorrow"), (95, "The years 415 555 0100 went by.")]
    docs = spark.createDataFrame(seeds + rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.reports(docs).collect()}
    assert found[90] == "phone:18:32" and found[91] == "phone:18:30" and found[92] == f"phone:{11 + len(word)}:{23 + len(word)}" and not found[93] and not found[94] and not found[95]
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[90] == "Please call me at [PHONE] tomorrow." and clean[91] == "Please call me at [PHONE], tomorrow."


def test_time_grows_with_the_tokens_of_a_text(spark):
    """Texts of thousands of identifiers: spans by brute force, redaction by position, the time in step with the number."""
    import time

    def run(n):
        text = " ".join(f"user{k}@mail.org é 10.0.{k % 256}.7, x{k}" for k in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        start = time.perf_counter()
        found = pii.reports(docs).collect()[0]
        clean = pii.redacted(docs).collect()[0].text
        seconds = time.perf_counter() - start
        assert found.n_email == found.n_ip == n and found.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_entities(text)).encode()).hexdigest()
        assert clean == " ".join(f"[EMAIL] é [IP], x{k}" for k in range(n))
        return seconds

    run(10)
    assert run(16_000) < 8 * run(2_000) + 10


def test_byte_pairs(spark, sf, odd):
    import tiktoken

    coder = bpe.coder_of(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choices(" \n\t  \r\x0baé1.'sXÜ ー字!", k=rng.randint(0, 14))) for _ in range(5000)] + ["abc" * 20000]
    assert all(coder.encode(t) == own.encode_ordinary(t) and coder.decode(coder.encode(t)).decode() == t for t in texts)
    plain = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op9_byte_bpe(spark, sf).collect():
        ids = own.encode_ordinary(plain[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(plain[r.doc_id].encode()).hexdigest()
    assert bpe.digests(odd, RANKS, public_tokenizers.PATTERN).count() == odd.count()


def brute_classes(rows, weigher):
    first, shingles = {}, {}
    for r in rows:
        first.setdefault(r.text or "", r.doc_id)
        shingles[r.doc_id] = weigher.shingles(r.text or "")
    root = {r.doc_id: first[r.text or ""] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared = defaultdict(set)
    for d in first.values():
        for code in shingles[d][0].tolist():
            shared[code].add(d)
    for a, b in {(a, b) for own in shared.values() for a in own for b in own if a < b}:
        (x, p), (y, q) = shingles[a], shingles[b]
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        least = np.minimum(p[i], q[j]).sum()
        if least / (p.sum() + q.sum() - least) >= 0.8:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: find(d) for d in root}


def test_near_duplicates(spark, docs, odd):
    rows = docs.collect()
    rng = random.Random(8)
    extra, base = [], [r for r in rows if 60 < len(r.text.split()) < 400][:12]
    for k, r in enumerate(base):
        for c in range(6):
            words = r.text.split(" ")
            words[rng.randrange(len(words))] = f"edit{k}{c}"
            extra.append((10000 + 10 * k + c, " ".join(words)))
    all_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    found = {r.doc_id: r.class_id for r in near_dup.classes(all_docs).collect()}
    assert found == brute_classes(all_docs.collect(), near_dup.Weigher(*near_dup.common_words(all_docs)))
    strange = near_dup.classes(odd).collect()
    assert len(strange) == odd.count() and {r.class_id for r in strange if r.doc_id in (1, 2)} == {1}
    assert near_dup.one_of_each(odd).columns == odd.columns and near_dup.classes(odd.limit(0)).collect() == []
    assert sorted((r.doc_id for r in near_dup.one_of_each(odd).collect())) == [1, 3, 5, 6, 7]


def test_one_row_of_each_class_stays(spark):
    """Rows of one id with different texts, repeated rows, rows without an id: what is left names every class once."""
    a, b, c = ("%s " % w * 3 + " ".join(f"{w}{k}" for k in range(30)) for w in "abc")
    rows = [(5, a, 1), (5, b, 2), (3, b, 3), (3, b, 4), (None, c, 5), (None, c, 6), (None, b, 7), (8, None, 8), (9, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest int")
    left = sorted((r.doc_id or 0, r.text or "") for r in near_dup.one_of_each(docs).collect())
    assert left == sorted([(5, a), (3, b), (0, c), (8, "")])
    assert near_dup.one_of_each(docs.limit(0)).collect() == []


def test_bands_meet_all_sets_of_ten_samples():
    """Two texts that agree on 10 of the 16 samples share a band, wherever these lie; lines cross in one sample."""
    assert len(near_dup.LINES) == 20 and all(len(set(a) & set(b)) <= 1 for a in near_dup.LINES for b in near_dup.LINES if a is not b)
    lines = [sum(1 << k for k in line) for line in near_dup.LINES]
    masks = np.arange(1 << 16)
    shared = np.zeros(1 << 16, bool)
    for line in lines:
        shared |= masks & line == line
    agreed = np.array([bin(m).count("1") for m in masks])
    assert shared[agreed >= 10].all()
    chance = (0.8**agreed * 0.2 ** (16 - agreed))[~shared].sum()
    assert chance < 0.01


def test_words_stay_known_within_a_text(monkeypatch):
    monkeypatch.setattr(near_dup.Words, "MOST", 10)
    text = " ".join(f"w{k % 700}" for k in range(1500))
    words = near_dup.Words()
    assert (words.of(text) == near_dup.Words().of(text)).all() and len(np.unique(words.of(text))) == 700 and (words.of(text) == words.of(text)).all()


def test_stars_and_shared_passages(spark):
    """Copies that are similar to one original only, and texts that share most of a passage: every pair of a bucket is settled."""
    rng = random.Random(12)
    rows = []
    for star in range(2):
        base = [f"s{star}w{k}" for k in range(140)]
        rows.append((star * 1000 + 500, " ".join(base)))
        for c in range(300):
            words = list(base)
            for at in rng.sample(range(5, 135), 2):
                words[at] = f"edit{star}x{c}x{at}"
            rows.append((star * 1000 + (c if c < 500 else c + 1), " ".join(words)))
    passage = [f"p{k}" for k in range(70)]
    for c in range(120):
        own = [f"own{c // 3}x{k}" for k in range(30)]
        own[rng.randrange(30)] = f"other{c}"
        rows.append((5000 + c, " ".join(passage + own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    weigher = near_dup.Weigher(*near_dup.common_words(docs))
    shingles = {i: weigher.shingles(text) for i, text in rows}
    root = {i: i for i, _ in rows}
    buckets = defaultdict(list)
    for r in near_dup.sketches(docs, weigher).collect():
        for line in near_dup.LINES:
            buckets[(tuple(line), *(r.samples[k] for k in line))].append(r.doc_id)
    for a, b in sorted({(a, b) for own in buckets.values() for a in own for b in own if a < b}):
        (x, p), (y, q) = shingles[a], shingles[b]
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        least = np.minimum(p[i], q[j]).sum()
        if least / (p.sum() + q.sum() - least) >= 0.8 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    found = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert found == root and sum(v == 0 for v in root.values()) > 290 and sum(v == 1000 for v in root.values()) > 290


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    weights = rng.gamma(2, 1, 400)
    changed = weights * np.where(rng.random(400) < 0.5, 1, 0.6)
    similar = np.minimum(weights, changed).sum() / np.maximum(weights, changed).sum()
    agreed = []
    for k in range(60):
        own = near_dup.mix(codes + np.uint64(k))
        a, b = near_dup.samples(np.concatenate([own, own]), np.concatenate([weights, changed]), np.array([0, 400]))
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - similar) < 0.05


def test_pipeline_by_stages(spark, sf, docs, odd):
    """Each stage against what its operator says of the same rows, and the end against the library."""
    import tiktoken

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, sf).cache()
        assert after.columns == docs.columns
        ids, left = {r.doc_id for r in rows.collect()}, {r.doc_id for r in after.collect()}
        if name == "quality":
            assert left == {r.doc_id for r in quality.verdicts(rows).collect() if r.kept}
        elif name == "near_duplicates":
            roots = brute_classes(rows.collect(), near_dup.Weigher(*near_dup.common_words(rows)))
            assert left == {d for d, root in roots.items() if d == root}
        elif name == "decontamination":
            assert left == ids - {r.doc_id for r in templates.leaks(rows, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
        else:
            assert left == ids and not any(base_entities(r.text) for r in after.collect())
        rows = after
    coder = bpe.coder_of(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    want = {r.doc_id: len(own.encode_ordinary(r.text)) for r in rows.collect()}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf).collect()} == want
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, sf).collect()




def test_windows_are_cut_from_the_text_as_from_the_tokens(spark):
    """Every STRIDE-th window in both forms, for texts with signs of their own, letters outside the basic plane and long words."""
    texts = ["", "one two", "Tom has 5 kg of red Apples. Mary has 3. They give 2,5 to Ann Lee and 7 miles more", "a\x01Bob \x05cd \U0001d41a Eve x y z İstanbul go\nOn and on ΣΑΣ to 3.5 kg", "x" * 20000 + " y " + "z" * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    cut = {r.doc_id: sorted(r.g) for r in templates.with_tokens(docs, ["doc_id"]).select("doc_id", templates.strided_grams(F.col("raw")).alias("g")).collect()}
    forms = {(r.doc_id, r.form): r for r in templates.in_forms(docs, ["doc_id"]).select("*", F.transform("words", templates.template).alias("kinds")).collect()}
    for i in range(len(texts)):
        want = [[" ".join(w[k : k + 6]) + " " for k in range(0, len(w) - 5, 3)] for w in (forms[i, "plain"].kinds, forms[i, "names"].kinds)]
        same = forms[i, "plain"].words == forms[i, "names"].words
        assert cut[i] == sorted(want[0] if same else want[0] + want[1])


def test_scaling_now_and_then_keeps_likelihoods(monkeypatch):
    """Pieces of any size and states scaled at every step or every eighth give the same sums and likelihoods."""
    rng = np.random.default_rng(3)
    model = hmm.Model.first(rng.dirichlet(np.ones(hmm.SYMBOLS)), 4)
    sequences = [rng.integers(0, hmm.SYMBOLS, n) for n in (1, 40, 8, 9, 40, 17, 2)]
    monkeypatch.setattr(hmm, "SCALED", 1)
    want = hmm.expectations(sequences, model), hmm.log_likelihoods(sequences, model)
    for scaled, piece in ((8, 1 << 18), (8, 1), (8, 50), (3, 7)):
        monkeypatch.setattr(hmm, "SCALED", scaled)
        monkeypatch.setattr(hmm, "PIECE", piece)
        assert np.allclose(hmm.expectations(sequences, model), want[0]) and np.allclose(hmm.log_likelihoods(sequences, model), want[1])
    assert len(hmm.log_likelihoods([], model)) == 0


def test_prepared_bytes():
    texts = ["AbC\tÄ\nZ\x0b\x0c\r É", None, "", "\x1cX Y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], ["i", "t"])
    got = [b.column(1).to_pylist() for b in hmm.lowered(iter([batch, batch.slice(1, 3)]), 1)]
    assert got[0] == ["abc Ä z    É", None, "", "\x1cx y"] and got[1] == got[0][1:]
