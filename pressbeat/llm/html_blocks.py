"""Main text of web pages: a recurrent labeller over the blocks of a page.

A page is cut into leaf blocks (text between block-level tags). Each block becomes a vector of its hashed tag path, its hashed
words and four measures. A bidirectional LSTM in numpy reads the blocks of the whole page in order, so each label depends on
everything before and after it. It is trained on a bounded sample of the given pages whose labels come from their semantic
tags, and on the same texts laid out anew in other page plans, so that it does not hang on one plan.

Null or empty html gives an empty text. Broken markup never fails: what is not a tag is text. Scripts, styles, templates, form controls and
comments are never text. Pages of any length are read whole, in time and memory that grow with their length. Repeated rows give repeated results, an empty
table gives an empty result; other columns of the input are not read and may have any name.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow

MARK = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*))", re.S)
SPECIAL = re.compile(r"[>\"']")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
UNSEEN = frozenset("script style template head select textarea button".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var img br wbr".split()
)
SCOPES = frozenset("html body div section article main aside header footer nav form table td th li ul ol dl blockquote figure".split())
#: Names that mark what is not the article, in tags, classes and ids of the teacher's rule.
OUTSIDE = frozenset(
    "nav menu header footer sidebar aside notice cookie cookies banner ad ads advert advertisement promo form button comment comments share "
    "social related breadcrumb breadcrumbs newsletter subscribe login popup copyright".split()
)
INSIDE = frozenset("article main".split())

PATH, WORDS, MEASURES, HIDDEN = 64, 32, 4, 16
WIDTH = PATH + WORDS + MEASURES
#: Elements that an open one of the same name ends.
SIBLINGS = frozenset("li tr td th dt dd option".split())


class Path:
    """The names on a tag path, as hashed sums and flags; a path and the paths below it share what is above them."""

    __slots__ = ("sums", "leaf", "inside", "outside", "below", "vector")
    made = 0

    def __init__(self, above: Path | None = None, names: tuple[str, ...] = ()):
        Path.made += 1
        self.sums = np.zeros(PATH, np.int32) if above is None else above.sums.copy()
        self.leaf = above.leaf if above is not None and not names else names[-1] if names else ""
        self.inside = (above is not None and above.inside) or any(n in INSIDE for n in names)
        self.outside = (above is not None and above.outside) or any(n in OUTSIDE for n in names)
        self.below: dict[tuple[str, ...], Path] = {}
        self.vector: np.ndarray | None = None
        for name in names:
            self.add(self.sums, name)

    @staticmethod
    def add(sums: np.ndarray, name: str) -> None:
        code = zlib.crc32(f"<{name}".encode("utf-8", "replace"))
        sums[code % PATH] += 1 if code >> 20 & 1 else -1

    def under(self, names: tuple[str, ...]) -> Path:
        known = self.below.get(names)
        if known is None:
            known = self.below[names] = Path(self, names)
        return known

    def features(self) -> np.ndarray:
        """The sums with the innermost name once more, as the leaf, at length 3."""
        if self.vector is None:
            total = self.sums.astype(float)
            if self.leaf:
                self.add(total, f"leaf {self.leaf}")
            self.vector = 3.0 * total / max(np.linalg.norm(total), 1)
        return self.vector


#: Paths that a worker keeps from page to page.
KEPT_PATHS = 50_000
ROOT = Path()


def root_path() -> Path:
    if Path.made > KEPT_PATHS:
        Path.made = 0
        ROOT.below.clear()
    return ROOT


class Ends:
    """Where tags end: at the next > outside quotes or, if quotes never close, at the next > at all.

    A place from which the quotes were found not to lead to an end is not tried again, so all tags of a page cost one look at it.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.dead: set[int] = set()

    def of(self, at: int) -> int:
        """The place of the > that ends the tag whose attributes begin at ``at``, or -1."""
        if at > self.last[">"]:
            return -1
        seen, here = [], at
        while here <= self.last[">"]:
            found = SPECIAL.search(self.html, here)
            place = found.start()
            if found[0] == ">":
                return place
            if place in self.dead or place == self.last[found[0]]:
                break
            seen.append(place)
            here = self.html.find(found[0], place + 1) + 1
        self.dead.update(seen)
        return self.html.find(">", at)


class Open:
    """The open elements, with counts that tell without a search whether a name is open in the current scope."""

    def __init__(self):
        self.stack: list[tuple[str, Path]] = []
        self.scopes: list[dict[str, int]] = [{}]
        self.named: dict[str, int] = {}
        self.hidden = self.anchors = 0

    @property
    def path(self) -> Path:
        return self.stack[-1][1] if self.stack else root_path()

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.stack.append((tag, self.path if tag in INLINE else self.path.under((tag, *names))))
        self.hidden += tag in UNSEEN
        self.anchors += tag == "a"
        self.named[tag] = self.named.get(tag, 0) + 1
        if tag in SCOPES:
            self.scopes.append({})
        else:
            self.scopes[-1][tag] = self.scopes[-1].get(tag, 0) + 1

    def pop(self) -> str:
        tag, _ = self.stack.pop()
        self.hidden -= tag in UNSEEN
        self.anchors -= tag == "a"
        self.named[tag] -= 1
        if tag in SCOPES:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        return tag

    def holds(self, tag: str) -> bool:
        """Whether an end tag of this name closes something; only the end of a scope reaches beyond the current one."""
        return bool(self.named.get(tag) if tag in SCOPES else self.scopes[-1].get(tag))

    def close(self, tag: str) -> None:
        while self.pop() != tag:
            pass

    def make_room(self, tag: str) -> None:
        """What the start of a block ends: an open paragraph, or an item before it."""
        scope = self.scopes[-1]
        outer = len(self.scopes) > 1 and tag in SIBLINGS and tag in SCOPES and self.stack and self.scope_tag() == tag
        if scope.get("p") or (tag in SIBLINGS and scope.get(tag)) or outer:
            while (closed := self.pop()) != "p" and closed != tag:
                pass

    def scope_tag(self) -> str:
        """The name of the innermost scope."""
        at = len(self.stack) - 1 - sum(self.scopes[-1].values())
        return self.stack[at][0]


def parse(html: str) -> list[tuple[str, Path, int]]:
    """The leaf blocks of a page in order: (text, tag path, characters inside links). Time and memory grow with the page, however it is nested."""
    blocks: list[tuple[str, Path, int]] = []
    parts: list[str] = []
    links = 0
    opened, ends = Open(), Ends(html)

    def say(piece: str) -> None:
        nonlocal links
        if piece and not opened.hidden:
            parts.append(piece)
            if opened.anchors:
                links += len(piece)

    def flush() -> None:
        nonlocal links
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((text, opened.path, min(links, len(text))))
        links = 0

    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            mark = size
        say(html[at:mark])
        at = mark
        if at == size:
            break
        found = MARK.match(html, at)
        if found is None:
            say("<")
            at += 1
            continue
        tag = found["tag"]
        if tag is None:
            at = found.end()
            continue
        stop = ends.of(found.end())
        if stop < 0:
            say("<")
            at += 1
            continue
        attrs, at, tag = html[found.end() : stop], stop + 1, tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag not in INLINE
        if found["end"]:
            if opened.holds(tag):
                if block:
                    flush()
                opened.close(tag)
            continue
        if block:
            flush()
            opened.make_room(tag)
        if tag in VOID or attrs.endswith("/"):
            continue
        names: tuple[str, ...] = ()
        if "=" in attrs:
            names = tuple(n for m in NAMES.finditer(attrs) for n in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower()) if n)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            stop = end.start() if end else size
            if tag == "title" and not opened.hidden and opened.stack and opened.stack[-1][0] != "head":
                parts.append(html[at:stop])
            at = end.end() if end else size
            continue
        opened.push(tag, names)
    flush()
    return blocks


def taught(path: Path) -> bool:
    """The teacher's label: inside an article or main element and below nothing that is named as furniture."""
    return path.inside and not path.outside


class Slots(dict):
    """Hash codes by name, dropped at a bound so that a worker's memory stays flat."""

    def __missing__(self, name: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[name] = code = zlib.crc32(name.encode("utf-8", "replace"))
        return code


SLOTS = Slots()


def vectors(pages: list[list[tuple[str, Path, int]]]) -> np.ndarray:
    """One row per block of all the pages."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), WIDTH), np.float32)
    if not blocks:
        return out

    def add(codes: list[int], counts: list[int], start: int, width: int, scale: float) -> None:
        code = np.array(codes, np.int64)
        count = np.array(counts, np.int64)
        row = np.repeat(np.arange(len(blocks)), count)
        sign = np.where(code >> 20 & 1, 1.0, -1.0)
        total = np.bincount(row * width + code % width, sign, len(blocks) * width).reshape(len(blocks), width)
        out[:, start : start + width] = scale * total / np.maximum(np.linalg.norm(total, axis=1), 1)[:, None]

    out[:, :PATH] = [path.features() for _, path, _ in blocks]
    codes, counts = [], []
    for text, _, _ in blocks:
        words = text.lower().split(" ")
        codes += map(SLOTS.__getitem__, words)
        counts.append(len(words))
    add(codes, counts, PATH, WORDS, 0.5)
    size = np.array([len(t) for t, _, _ in blocks], np.float32)
    out[:, -4] = np.log1p(size) / 8
    out[:, -3] = np.array([n for _, _, n in blocks], np.float32) / size
    out[:, -2] = np.log1p(np.array(counts, np.float32)) / 6
    out[:, -1] = [t[-1] in ".!?…\"”»" for t, _, _ in blocks]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def steps(lengths: np.ndarray, backward: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of the flat block table to read at each step, longest page first, pages leaving as they end."""
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    rows = []
    for t in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -t, "left"))  # pages with more than t blocks
        rows.append((first[:n] + sizes[:n] - 1 - t) if backward else first[:n] + t)
    return order, rows


def lstm(x: np.ndarray, rows: list[np.ndarray], w: dict, keep: bool = False):
    """Hidden states of all blocks in one direction; with ``keep`` also what the gradient needs."""
    seen = x @ w["x"] + w["b"]
    out = np.zeros((len(x), HIDDEN), x.dtype)
    n = len(rows[0]) if rows else 0
    h = np.zeros((n, HIDDEN), x.dtype)
    c = np.zeros((n, HIDDEN), x.dtype)
    kept = []
    for row in rows:
        n = len(row)
        before_h, before_c = h[:n], c[:n]
        z = seen[row] + before_h @ w["h"]
        gates = sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        c = f * before_c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[row] = h
        if keep:
            kept.append((row, before_h, before_c, i, f, o, g, tc))
    return out, kept


def lstm_gradient(x: np.ndarray, kept: list, w: dict, d_out: np.ndarray) -> dict:
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    d_seen = np.zeros((len(x), 4 * HIDDEN), x.dtype)
    d_h = np.zeros((0, HIDDEN), x.dtype)
    d_c = np.zeros((0, HIDDEN), x.dtype)
    for row, before_h, before_c, i, f, o, g, tc in reversed(kept):
        n = len(row)
        dh = d_out[row]
        dc = np.zeros_like(dh)
        dh[: len(d_h)] += d_h
        dc[: len(d_c)] += d_c
        dc += dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        d_seen[row] = dz
        grad["h"] += before_h.T @ dz
        d_h, d_c = dz @ w["h"].T, dc * f
        assert len(d_h) == n
    grad["x"] = x.T @ d_seen
    grad["b"] = d_seen.sum(0)
    return grad


class Labeller:
    """A bidirectional LSTM with a logistic output over [forward, backward] states."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def direction() -> dict:
            w = {"x": rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)), "h": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)), "b": np.zeros(4 * HIDDEN)}
            w["b"][HIDDEN : 2 * HIDDEN] = 1
            return {k: v.astype(np.float32) for k, v in w.items()}

        self.weights = {"f": direction(), "b": direction(), "o": {"w": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), "b": np.zeros(1, np.float32)}}

    def scores(self, pages: list) -> list[np.ndarray]:
        """The chance of each block of each page to be part of the article."""
        lengths = np.array([len(p) for p in pages], np.int64)
        x = vectors(pages)
        both = np.concatenate([lstm(x, steps(lengths, way == "b")[1], self.weights[way])[0] for way in "fb"], 1)
        flat = sigmoid(both @ self.weights["o"]["w"] + self.weights["o"]["b"])
        return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []

    def fit(self, pages: list, labels: list, epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Labeller:
        """Adam over batches of whole pages; the loss is the mean log loss of the blocks."""
        rng = np.random.default_rng(seed)
        leaves = [(a, b) for a in self.weights for b in self.weights[a]]
        first = {k: 0.0 for k in leaves}
        second = {k: 0.0 for k in leaves}
        step = 0
        ready = [(vectors([p]), np.array(y, np.float32)) for p, y in zip(pages, labels) if p]
        for _ in range(epochs):
            order = rng.permutation(len(ready))
            for at in range(0, len(order), batch):
                some = [ready[k] for k in order[at : at + batch]]
                x = np.concatenate([a for a, _ in some])
                y = np.concatenate([b for _, b in some])
                lengths = np.array([len(b) for _, b in some], np.int64)
                runs = {way: lstm(x, steps(lengths, way == "b")[1], self.weights[way], True) for way in "fb"}
                both = np.concatenate([runs["f"][0], runs["b"][0]], 1)
                out = self.weights["o"]
                d = (sigmoid(both @ out["w"] + out["b"]) - y) / len(y)
                d_both = d[:, None] * out["w"][None, :]
                grads = {("o", "w"): both.T @ d, ("o", "b"): d.sum(keepdims=True)}
                for way, part in (("f", d_both[:, :HIDDEN]), ("b", d_both[:, HIDDEN:])):
                    grads.update({(way, k): v for k, v in lstm_gradient(x, runs[way][1], self.weights[way], part.copy()).items()})
                step += 1
                for a, b in leaves:
                    g = np.clip(grads[a, b], -1, 1)
                    first[a, b] = 0.9 * first[a, b] + 0.1 * g
                    second[a, b] = 0.999 * second[a, b] + 0.001 * g * g
                    move = first[a, b] / (1 - 0.9**step) / (np.sqrt(second[a, b] / (1 - 0.999**step)) + 1e-8)
                    self.weights[a][b] = (self.weights[a][b] - rate * move).astype(np.float32)
        return self


def replanned(rng: np.random.Generator, bodies: list[list[str]], asides: list[str]) -> tuple[str, list[int]]:
    """A page in another plan around the paragraphs of one body, and the labels of its blocks."""

    def pick(*options):
        return options[rng.integers(len(options))]

    def words(low: int, high: int) -> str:
        body = bodies[rng.integers(len(bodies))]
        text = body[rng.integers(len(body))].split(" ")
        n = int(rng.integers(low, high + 1))
        at = int(rng.integers(max(1, len(text) - n + 1)))
        return entities.escape(" ".join(text[at : at + n]))

    def aside() -> str:
        return entities.escape(asides[rng.integers(len(asides))]) if asides and rng.random() < 0.5 else words(3, 14)

    def links(n: int) -> str:
        item = pick("<li><a href='/{0}'>{0}</a></li>", "<a href='/{0}'>{0}</a> ", "<li>{0}</li>", "<div><a href='#'>{0}</a></div>")
        return "".join(item.format(words(1, 2)) for _ in range(n))

    def named(*names: str) -> tuple[str, str]:
        tag = pick("div", "section", "ul")
        return f"<{tag} {pick('class', 'id')}='{pick(*names)}'>", f"</{tag}>"

    before = {
        "menu": lambda: pick(("<nav><ul>", "</ul></nav>"), named("menu", "nav", "top-nav", "main-menu", "navbar")) + (links(int(rng.integers(2, 9))),),
        "header": lambda: pick(("<header>", "</header>"), named("header", "site-header", "masthead")) + (pick(f"<h1>{words(1, 4)}</h1>", f"<p>{words(2, 8)}</p>", links(3)),),
        "notice": lambda: named("notice", "cookie-notice", "banner", "alert", "popup", "cookies") + (f"<p>{aside()}</p>",),
        "ad": lambda: named("ad", "ads", "advert", "promo", "sponsored", "advertisement") + (pick(aside(), f"<p>{aside()}</p>"),),
        "crumbs": lambda: named("breadcrumb", "breadcrumbs") + (links(3),),
    }
    after = {
        "side": lambda: pick(("<aside>", "</aside>"), named("sidebar", "side", "related", "widget")) + (pick(f"<h3>{words(1, 4)}</h3>" + links(4), f"<p>{aside()}</p>"),),
        "form": lambda: ("<form>", "</form>", f"<label>{words(1, 3)}</label><p>{words(2, 8)}</p>"),
        "comments": lambda: named("comments", "comment", "comment-list", "replies", "discussion")
        + ("".join(f"<{t}>{words(4, 60)}</{t}>" for t in [pick("p", "div", "li")] * int(rng.integers(1, 6))),),
        "share": lambda: named("share", "social", "newsletter", "subscribe") + (pick(links(3), f"<p>{aside()}</p>"),),
        "footer": lambda: pick(("<footer>", "</footer>"), named("footer", "site-footer", "copyright")) + (pick("&copy; ", "") + aside(),),
        "ad": before["ad"],
    }
    body = bodies[rng.integers(len(bodies))]
    wrap = pick(("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), named("content", "post-content", "article-body", "entry", "story", "main-content", "post"))
    pieces: list[tuple[str, int]] = []
    for key in rng.permutation(list(before))[: rng.integers(0, 5)]:
        opened, closed, inner = before[str(key)]()
        pieces.append((opened + inner + closed, 0))
    pieces.append((wrap[0].replace("<ul", "<div"), -1))
    if rng.random() < 0.8:
        pieces.append((f"<{(t := pick('h1', 'h2'))}>{words(2, 12)}</{t}>", 1))
    for k, text in enumerate(body):
        tag = pick("p", "p", "p", "p", "div", "li", "blockquote", "h2", "pre")
        pieces.append((f"<{tag}>{entities.escape(text)}</{tag}>", 1))
        if rng.random() < 0.1:
            opened, closed, inner = pick(before["ad"], after["share"], before["notice"])()
            pieces.append((opened + inner + closed, 0))
    pieces.append((wrap[1].replace("</ul", "</div"), -1))
    for key in rng.permutation(list(after))[: rng.integers(0, 6)]:
        opened, closed, inner = after[str(key)]()
        pieces.append((opened + inner + closed, 0))
    labels = [label for part, label in pieces if label >= 0 for _ in parse(part)]
    return "<html><body>" + "".join(part for part, _ in pieces) + "</body></html>", labels


def train(pages: DataFrame, sample: int = 300, plans: int = 600, epochs: int = 7, html: str = "html", longest: int = 200_000) -> Labeller:
    """A labeller fitted on at most ``sample`` different pages of up to ``longest`` characters, taken by the order of their hashes, and ``plans`` pages laid out anew.

    The bounds are what the classifier needs, not what is labelled: every page of the table is labelled later, whatever its length.
    """
    drawn = pages.select(F.col(html).cast("string").alias("html")).filter(F.length("html").between(1, longest))
    marked = drawn.select(F.xxhash64("html").alias("mark"), "html")
    marks = [r.mark for r in marked.select("mark").distinct().orderBy("mark").limit(sample).collect()]
    chosen = marked.filter(F.col("mark").isin(marks)).groupBy("mark").agg(F.min("html").alias("html"))
    rows = sorted(chosen.collect()) if marks else []  # at most ``sample`` pages leave the tasks, copies of one reduced before
    parsed, labels, bodies, asides = [], [], [], []
    for row in rows:
        blocks = parse(row.html)
        marks = [int(taught(path)) for _, path, _ in blocks]
        if not any(marks):
            continue
        parsed.append(blocks)
        labels.append(marks)
        bodies.append([t for (t, _, _), y in zip(blocks, marks) if y][:40])
        asides += [t for (t, _, _), y in zip(blocks, marks) if not y and len(t) > 12][:4]
    rng = np.random.default_rng(3)
    if not bodies:  # nothing to learn words from: invented ones still teach the tag paths
        bodies = [[" ".join("".join(rng.choice(list("aeioulnrst"), int(n))) for n in rng.integers(2, 9, 30)) + "."] * 3 for _ in range(20)]
    for _ in range(plans):
        page, marks = replanned(rng, bodies, asides)
        blocks = parse(page)
        if len(blocks) == len(marks):
            parsed.append(blocks)
            labels.append(marks)
    return Labeller().fit(parsed, labels, epochs)


def main_text(pages: list[str | None], labeller: Labeller, threshold: float = 0.5) -> list[tuple[str, int]]:
    """The text and the number of blocks of each page."""
    parsed = [parse(p or "") for p in pages]
    kept = []
    for blocks, scores in zip(parsed, labeller.scores(parsed)):
        kept.append(("\n".join(t for (t, _, _), s in zip(blocks, scores) if s >= threshold), len(blocks)))
    return kept


def extract(pages: DataFrame, labeller: Labeller, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars, n_blocks. One pass over the pages, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lengthy(batches, 4 << 20):
            texts = main_text(batch.column(2).to_pylist(), labeller)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in texts], pa.string()), pa.array([len(t) for t, _ in texts], pa.int64()), pa.array([n for _, n in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    slim = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return map_arrow(slim, run, "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint")
