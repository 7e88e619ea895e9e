"""The page labeller on odd tables and broken or hostile pages, and its gradient against differences."""

import time

import numpy as np
import pytest

from pressbeat.llm import html_blocks

HOSTILE = {
    "open tags": "<a ",
    "ends of tags that are not open": "<b></i>x",
    "nested blocks": "<div>x",
    "nested inline, then headings": "<b>",
    "quotes that never close": '<a ">" ',
    "quoted starts": '<a "',
    "brackets": "<",
    "half comments": "<!-",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_the_page(name):
    piece = HOSTILE[name]

    def seconds(size):
        page = piece * (size // len(piece)) + ("<h2>x" * (size // 5) if "headings" in name else "")
        start = time.perf_counter()
        html_blocks.vectors([html_blocks.parse(page)])
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(160_000) < 16 * seconds(20_000) + 0.5  # eight times the page


def test_paths_of_nested_blocks_share_their_beginnings():
    blocks = html_blocks.parse("<div class='post body'>" * 3 + "a<p>b</p><b>c</b></div>d")
    assert [t for t, _, _ in blocks] == ["a", "b", "c", "d"] and blocks[0][1] is blocks[2][1] and blocks[1][1] is not blocks[0][1]
    assert html_blocks.taught(html_blocks.parse("<article><p>x")[0][1]) and not html_blocks.taught(html_blocks.parse("<article><div class='share'>x")[0][1])
    inside = "<article><p>a</p><math><mi>x</mi></math><svg><text>y</text></svg><object>z</object><form><select><option>no</select></form></article>"
    assert [t for t, _, _ in html_blocks.parse(inside)] == ["a", "x", "y", "z"]


def test_tables_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    model = html_blocks.train(pages)
    kind = "page_id bigint, url string, html string, text string, n_blocks int, mark string"
    one = "<article><h1>Rain</h1><p>It rained all day &lt;here&gt; and\n there.</p></article><footer>Contact</footer>"
    rows = [(1, "u", one, "q", 3, "m"), (1, "u", one, "q", 3, "m"), (2, None, None, "q", 3, "m"), (None, "v", "", "q", 3, "m"), (3, "w", one.replace("there", "there " * 60_000), "q", 3, "m")]
    found = {}
    for r in html_blocks.extract(spark.createDataFrame(rows, kind), model).collect():
        found.setdefault(r.page_id, []).append((r.url, r.text, r.n_chars))
    text = "Rain\nIt rained all day <here> and there."
    assert found[1] == [("u", text, len(text))] * 2 and found[2] == [(None, "", 0)] and found[None] == [("v", "", 0)]
    assert found[3][0][1].count("there") == 60_000
    empty = spark.createDataFrame([], kind)
    assert html_blocks.extract(empty, model).collect() == [] and html_blocks.extract(empty, html_blocks.train(empty)).collect() == []


def test_gradient_of_the_recurrent_layer():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 5, 1])
    x = rng.normal(size=(9, html_blocks.WIDTH))
    for backward in (False, True):
        rows = html_blocks.steps(lengths, backward)[1]
        w = {k: v.astype(float) for k, v in html_blocks.Labeller(4).weights["f"].items()}
        pull = rng.normal(size=(9, html_blocks.HIDDEN))
        grad = html_blocks.lstm_gradient(x, html_blocks.lstm(x, rows, w, True)[1], w, pull.copy())
        for key, place in (("x", (7, 11)), ("h", (3, 40)), ("b", (20,)), ("x", (0, 63)), ("h", (15, 5))):
            out = []
            for step in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in w.items()}
                moved[key][place] += step
                out.append((html_blocks.lstm(x, rows, moved)[0] * pull).sum())
            assert abs((out[0] - out[1]) / 2e-5 - grad[key][place]) < 1e-5 * max(1, abs(grad[key][place]))
