"""Language-model scores by a hidden Markov model whose states are trained on the whole corpus.

Tokens are the words of a text, A-Z in lower case, and one end. The OWN most frequent words are symbols of their own, all others
share HASHED symbols by a hash, the end is the last symbol. A word of a shared symbol has its smoothed share of that symbol's
count, so every word, seen or not, has a probability. Baum-Welch expectations are summed in each task, added up across
partitions and collected as one value per model parameter, which is a bounded number. Training and likelihoods are over whole texts: the steps
of the texts at hand are cut into pieces of about PIECE tokens, the scaled forward state is kept where a piece begins, and the backward pass works its way
from the last piece to the first, each piece's forward states made anew, so memory holds one piece. Within a piece, emissions are looked up and
expectations summed at once; states are scaled at every SCALED-th step, between which they lose far less than a double holds.

Counts of all words stay distributed. The words above a count that at most TOP words reach, found from a histogram of the counts, are looked up in the task; the rest of a text's words meet their
counts in a join of (row, word, n), from which the frequent words, and so the skew, are gone.

A null text is empty and has one token, the end. A null id is in training. Repeated rows are scored each for itself, by a written
row number. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow, materialize, numbered, text_of

STATES, OWN, HASHED, TOP, PIECE, SCALED, ROUNDS, STAY = 6, 2048, 512, 65536, 1 << 18, 8, 5, 0.95
#: Texts of more tokens wait for each other, so that a step of the recursion covers several of them.
LENGTHY, HELD = 2048, 250_000
END = ""
SYMBOLS = OWN + HASHED + 1
LAST = SYMBOLS - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREPARED = bytes.maketrans(b"\t\n\x0b\x0c\r" + UPPER.encode(), b"     " + LOWER.encode())


def words_in(text: str) -> list[str]:
    """The words of a prepared text, whose only separator is the space."""
    return list(filter(None, text.split(" ")))


def lowered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches with the texts of ``column`` prepared: A-Z in lower case and every separator as a space, byte by byte, as UTF-8 allows."""
    for batch in batches:
        texts = batch.column(column)
        valid, ends, data = texts.buffers()
        if data is not None:
            data = pa.py_buffer(data.to_pybytes().translate(PREPARED))
        yield batch.set_column(column, batch.schema.field(column), pa.Array.from_buffers(texts.type, len(texts), [valid, ends, data], texts.null_count, texts.offset))


def prepared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, and the text, a null as empty."""
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 10 == 0, F.lit(False))
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), held.alias("held_out"), text_of(text).alias("text"))


def word_counts(train: DataFrame, flush: int = 300_000) -> DataFrame:
    """(word, c) of all tokens; the end is the empty word. Counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def cut() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "c"])

        for batch in lengthy(lowered(batches, 0)):
            for text in batch.column(0).to_pylist():
                seen.update(words_in(text))
                seen[END] += 1
            if len(seen) > flush:
                yield cut()
                seen.clear()
        yield cut()

    return map_arrow(train.select("text"), run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary(NamedTuple):
    """What the tasks know of the counts: the TOP words and, for each shared symbol, the log of its smoothed total."""

    top: dict[str, int]
    own: dict[str, int]
    shared: np.ndarray
    symbol_share: np.ndarray
    total: int
    distinct: int

    def symbol(self, word: str) -> int:
        found = self.own.get(word)
        return OWN + zlib.crc32(word.encode()) % HASHED if found is None else found


def least_count(counts: DataFrame, most: int = TOP) -> int:
    """The least count, of those with eight leading binary digits, that at most ``most`` words reach."""
    shift = F.greatest(F.length(F.bin("c")) - 8, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", F.col("c"), shift), shift)
    reached, least = 0, 1 << 62
    for r in counts.groupBy(low.alias("low")).agg(F.count("*").alias("v")).orderBy(F.desc("low")).collect():  # under 8,000 rows
        reached += r.v
        if reached > most:
            break
        least = r.low
    return least


def vocabulary(counts: DataFrame) -> Vocabulary:
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(size.n or 0), int(size.v)
    rows = counts.filter(F.col("c") >= least_count(counts.filter(F.col("word") != END))).filter(F.col("word") != END).collect()  # at most TOP
    top = {r.word: r.c for r in sorted(rows, key=lambda r: (-r.c, r.word))}
    own = {word: i for i, word in enumerate(list(top)[:OWN])}
    groups = counts.filter(F.col("word") != END).groupBy((F.crc32("word") % HASHED).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    mass, kinds = np.zeros(HASHED), np.zeros(HASHED)
    for r in groups:
        mass[r.k], kinds[r.k] = r.c, r.v
    for word in own:
        k = zlib.crc32(word.encode()) % HASHED
        mass[k] -= top[word]
        kinds[k] -= 1
    share = np.zeros(SYMBOLS)
    for word, i in own.items():
        share[i] = top[word]
    share[OWN:LAST] = mass
    share[LAST] = total - share.sum()
    share += 0.1
    return Vocabulary(top, own, np.log10(mass + 0.1 * (kinds + 1)), share / share.sum(), total, distinct)


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # one row per symbol

    @classmethod
    def first(cls, share: np.ndarray, seed: int = 9) -> Model:
        """A start that likes to stay in a state, so that states come to stand for languages and kinds of text."""
        rng = np.random.default_rng(seed)
        emit = share[:, None] * rng.gamma(2.0, 0.5, (SYMBOLS, STATES))
        move = rng.random((STATES, STATES)) + 0.5
        move = (1 - STAY) * move / move.sum(1, keepdims=True) + STAY * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))

    @classmethod
    def fitted(cls, sums: np.ndarray, share: np.ndarray) -> Model:
        """The model of summed expectations, each distribution smoothed a little."""
        start, move, emit = np.split(sums, [STATES, STATES + STATES * STATES])
        start, move = start + 1.0, move.reshape(STATES, STATES) + 1.0
        emit = emit.reshape(SYMBOLS, STATES) + 10.0 * share[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def active(sequences: list[np.ndarray]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Order of falling length, how many sequences are longer than t, and their symbols side by side (step by step)."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-sizes, kind="stable")
    counts = np.bincount(sizes, minlength=sizes.max() + 1 if len(sizes) else 1)
    longer = (len(sizes) - np.cumsum(counts))[: sizes.max() if len(sizes) else 0]
    offsets = np.concatenate([[0], np.cumsum(longer)])
    steps = np.empty(offsets[-1], np.int64)
    lane = np.repeat(np.arange(len(sizes)), sizes[order])
    at = np.arange(len(lane)) - np.repeat(np.cumsum(sizes[order]) - sizes[order], sizes[order])
    steps[offsets[at] + lane] = np.concatenate([sequences[k] for k in order]) if len(sizes) else 0
    return order, longer.tolist(), steps


class Steps:
    """Sequences side by side, their steps in pieces, and the scaled forward recursion over a piece."""

    def __init__(self, sequences: list[np.ndarray], model: Model) -> None:
        self.order, longer, self.symbols = active(sequences)
        self.longer, self.model = longer, model
        self.offsets = [0, *np.cumsum(longer, dtype=np.int64).tolist()]
        self.cuts = [0]
        for t in range(1, len(longer)):
            if self.offsets[t + 1] - self.offsets[self.cuts[-1]] > PIECE:
                self.cuts.append(t)
        self.cuts.append(len(longer))

    def forward(self, k: int, state: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """The states and emissions of the k-th piece, a row for each token, after ``state``, and the scales of the steps that were scaled."""
        low, high = self.cuts[k], self.cuts[k + 1]
        base = self.offsets[low]
        emits = self.model.emit.take(self.symbols[base : self.offsets[high]], 0)
        states, scales = np.empty_like(emits), {}
        ones, move = np.ones(STATES), self.model.move
        for t in range(low, high):
            n, at = self.longer[t], self.offsets[t] - base
            now, emit = states[at : at + n], emits[at : at + n]
            if state is None:
                np.multiply(emit, self.model.start, now)
            else:
                np.dot(state[:n], move, now)
                now *= emit
            if t % SCALED == SCALED - 1 or t == high - 1:
                scales[t] = now @ ones
                now /= scales[t][:, None]
            state = now
        return states, emits, scales

    def last(self, k: int, states: np.ndarray) -> np.ndarray:
        return states[self.offsets[self.cuts[k + 1] - 1] - self.offsets[self.cuts[k]] :]

    def ends(self, k: int) -> np.ndarray:
        """For each token of the k-th piece, whether its sequence ends there."""
        low, high = self.cuts[k], self.cuts[k + 1]
        longer = np.array(self.longer[low : high + 1] + [0] * (high + 1 > len(self.longer)), np.int64)
        lane = np.arange(self.offsets[high] - self.offsets[low]) - np.repeat(np.array(self.offsets[low:high]) - self.offsets[low], longer[:-1])
        return lane >= np.repeat(longer[1:], longer[:-1])


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 of the exact likelihood of each sequence by the scaled forward recursion, all sequences a step at a time."""
    steps = Steps(sequences, model)
    logs, state = np.zeros(len(sequences)), None
    for k in range(len(steps.cuts) - 1):
        states, _, scales = steps.forward(k, state)
        if not len(states):
            break
        for scale in scales.values():
            logs[: len(scale)] += np.log10(scale)
        # the sums of the last states; where a sequence ends on a scaled step they are one
        ends = np.flatnonzero(steps.ends(k))
        step = np.searchsorted(steps.offsets, ends + steps.offsets[steps.cuts[k]], "right") - 1
        logs[ends + steps.offsets[steps.cuts[k]] - np.array(steps.offsets)[step]] += np.log10(states[ends].sum(1))
        state = steps.last(k, states).copy()
    out = np.zeros(len(sequences))
    out[steps.order] = logs
    return out


def expectations(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Expected starts, moves and emissions of whole sequences."""
    steps = Steps(sequences, model)
    moved, emitted = np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES))
    started = np.zeros(STATES)
    marks: list[np.ndarray | None] = [None]
    for k in range(len(steps.cuts) - 2):
        marks.append(steps.last(k, steps.forward(k, marks[-1])[0]).copy())
    ahead = np.ones((0, STATES))
    back = model.move.T.copy()
    for k in reversed(range(len(marks) if len(steps.symbols) else 0)):
        low, high, base = steps.cuts[k], steps.cuts[k + 1], steps.offsets[steps.cuts[k]]
        states, emits, scales = steps.forward(k, marks[k])
        betas = np.empty_like(states)
        # what a state is worth at the end of its sequence, where the states need not sum up to one
        ends = steps.ends(k)
        betas[ends] = (1 / states[ends].sum(1))[:, None]
        moved += steps.last(k, states)[: len(ahead)].T @ ahead
        for t in range(high - 1, low - 1, -1):
            n, at = steps.longer[t], steps.offsets[t] - base
            beta = betas[at : at + n]
            if len(ahead):
                np.dot(ahead, back, beta[: len(ahead)])
            emit = emits[at : at + n]
            ahead = np.multiply(emit, beta, emit)
            if t in scales:
                ahead /= scales[t][:, None]
        # emits holds by now what lies ahead of the step before; each row meets the state of its sequence there
        first = steps.longer[low]
        before = np.arange(first, len(states)) - np.repeat(np.array(steps.longer[low : high - 1], np.int64), np.array(steps.longer[low + 1 : high], np.int64))
        moved += states[before].T @ emits[first:]
        ahead = ahead.copy()
        gammas = np.multiply(states, betas, states)
        own = steps.symbols[base : base + len(states)]
        emitted += np.stack([np.bincount(own, gammas[:, i], SYMBOLS) for i in range(STATES)], 1)
        if low == 0:
            started = gammas[:first].sum(0)
    return np.concatenate([started, (moved * model.move).ravel(), emitted.ravel()])


def trained(encoded: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training rows of ``encoded``; each round is one pass and one sum per parameter."""
    model = Model.first(share)
    train = encoded.filter(~F.col("held_out")).select("symbols")
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(STATES + STATES * STATES + SYMBOLS * STATES)
            waiting: dict[bool, list[np.ndarray]] = {False: [], True: []}
            size = {False: 0, True: 0}

            def flush(long: bool) -> np.ndarray | int:
                some, waiting[long], size[long] = waiting[long], [], 0
                return expectations(some, model) if some else 0

            for batch in lengthy(batches, 1 << 20):
                for data in batch.column(0).to_pylist():
                    sequence = np.frombuffer(data, "<u2")
                    long = len(sequence) > LENGTHY
                    waiting[long].append(sequence)
                    size[long] += len(sequence)
                    if size[long] > HELD * (4 if long else 1):
                        total += flush(long)
            total += flush(False)
            total += flush(True)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["i", "v"])

        summed = map_arrow(train, run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        sums = np.zeros(STATES + STATES * STATES + SYMBOLS * STATES)
        sums[summed["i"].to_numpy(np.int64)] = summed["v"].to_numpy(np.float64)
        model = Model.fitted(sums, share)
    return model


def encoded(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """Each text as symbols, with what the frequent words add to its scores and the list of its other words."""
    known = {w: (words.own.get(w, -1), math.log10(c + 0.1)) for w, c in words.top.items()}
    shared = words.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        for batch in lengthy(lowered(batches, 2), 4 << 20):
            out, rare, rare_n, ends = [], [], [], [0]
            for text in batch.column(2).to_pylist():
                tokens = words_in(text)
                counts = Counter(tokens)
                if len(codes) > 400_000:
                    codes.clear()
                own_logs = shared_logs = norm = 0.0
                n_known = 0
                for word, n in counts.items():
                    found = known.get(word)
                    symbol = found[0] if found else -1
                    if symbol < 0:
                        symbol = codes.get(word, -1)
                        if symbol < 0:
                            symbol = OWN + zlib.crc32(word.encode()) % HASHED
                        norm += n * shared[symbol - OWN]
                    codes[word] = symbol
                    if found is None:
                        rare.append(word)
                        rare_n.append(n)
                        continue
                    n_known += n
                    if found[0] < 0:
                        shared_logs += n * found[1]
                    else:
                        own_logs += n * found[1]
                symbols = np.array([*map(codes.__getitem__, tokens), LAST], "<u2")
                ends.append(len(rare))
                out.append((len(tokens) + 1, n_known, own_logs, shared_logs, norm, symbols.tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary()]
            names = ["n_tokens", "n_top", "own_logs", "shared_logs", "norm", "symbols", "rare", "rare_n"]
            arrays = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            arrays += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rare, pa.string())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rare_n, pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "held_out", *names])

    kind = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_top bigint, own_logs double, shared_logs double, norm double, symbols binary, "
        "rare array<string>, rare_n array<int>"
    )
    return map_arrow(texts, run, kind)


def likelihoods(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (symbols last) with the log10 likelihood of the symbols in their place."""
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lengthy(batches):
            logs = log_likelihoods([np.frombuffer(s, "<u2") for s in batch.column(len(names)).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(logs, pa.float64())], [*names, "chain"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{kind}, chain double")


def scores(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = prepared(docs)
    counts = materialize(word_counts(texts.filter(~F.col("held_out"))), "words")
    words = vocabulary(counts)
    rows = numbered(encoded(texts, words), "row", "symbols")
    model = trained(rows, words.symbol_share)
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("n")).join(counts, "word", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    rest = rare.groupBy("row").agg(F.sum(F.col("n") * log).alias("rare_logs"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("n_rare"))
    chained = likelihoods(rows.select("row", "doc_id", "held_out", "n_tokens", "n_top", "own_logs", "shared_logs", "norm", "symbols"), model)
    joined = chained.join(rest, "row", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    ends = words.total and counts.filter(F.col("word") == END).first()
    end_log, end_known = math.log10((ends.c if ends else 0) + 0.1), int(bool(ends))
    base = F.col("own_logs") + F.col("shared_logs") + rare_logs + F.lit(end_log) - F.col("n_tokens") * F.lit(math.log10(words.total + 0.1 * (words.distinct + 1)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_top") + F.coalesce("n_rare", F.lit(0)) + F.lit(end_known)).cast("bigint").alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("chain") + F.col("shared_logs") + rare_logs - F.col("norm")).alias("score"),
    )
