"""Language identification by a linear-chain conditional random field.

Every word of a text gets a label from the learned languages.  A word's
emission scores are sums of weights of its features: character n-grams, those
at its start and end being its affixes, and the word itself (the lexicon).
Transition scores between neighbouring words are learned too, from sequences
that switch language as well as from plain ones.  The forward-backward
algorithm gives each word's label probabilities given the whole text; a text's
language is the one with the largest sum of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicscan.llm.common import map_arrow, ship_package, worker_state

#: Bounds of the labelled sample a model is fitted on.
TRAIN_DOCS = 250  # documents of each language
TRAIN_CHARS = 4000  # characters of each, from a seeded place of the whole text
TRAIN_WORDS = 80  # words of a training sequence, from a seeded place of those
TRAIN_LANGS = 64  # languages, the most frequent ones
FEATURE_BITS = 18
NGRAM = 4
STEPS = 40
CHUNK = 32  # words whose messages are computed side by side
#: Words kept per Python worker; a full table is emptied.
CACHE_WORDS = 250_000
UNKNOWN = "und"


def letters(word: str) -> str:
    """The word from its first letter to its last, lower-cased; empty if it has none."""
    if word.isalpha():
        return word.lower()
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0]:at[-1] + 1].lower() if at else ""


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(word index, feature)`` pairs of a list of non-empty words."""
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    text = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), size)
    owner, feature = [np.arange(len(words))], [np.fromiter(
        (zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20) & mask]
    h = np.zeros(len(points), np.uint64)
    for n in range(1, NGRAM + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + points[n - 1:]
        inside = word[:m] == word[n - 1:]
        if n == 1:
            inside &= points > 3  # the markers alone say nothing
        x = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        owner.append(word[:m][inside])
        feature.append(x >> np.uint64(20) & mask)
    return np.concatenate(owner), np.concatenate(feature).astype(np.int64)


def _sums(owner: np.ndarray, feature: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights[feature, j], n) for j in range(weights.shape[1])], axis=1)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # feature, label
    transition: np.ndarray  # log scores, from and to
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)))
        owner, feature = features(words)
        return _sums(owner, feature, self.weights, len(words))


def _passes(e: np.ndarray, step: np.ndarray, begin: np.ndarray, real: np.ndarray):
    """Scaled forward and backward messages of padded sequences e[s, t, label]."""
    n, t, k = e.shape
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = begin * e[:, 0]
    alpha[:, 0] = a / a.sum(1, keepdims=True)
    for i in range(1, t):
        a = (alpha[:, i - 1] @ step) * e[:, i]
        alpha[:, i] = np.where(real[:, i, None], a / a.sum(1, keepdims=True), alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        b = (beta[:, i + 1] * e[:, i + 1]) @ step.T
        beta[:, i] = np.where(real[:, i + 1, None], b / b.sum(1, keepdims=True), beta[:, i + 1])
    return alpha, beta


def train(sample: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Model:
    """Fit a model to ``(text, language)`` pairs by gradient ascent on the likelihood of the label sequences."""
    rng = np.random.default_rng(seed)
    labels = sorted({y for _, y in sample})
    code = {y: i for i, y in enumerate(labels)}
    docs = [([w for w in map(letters, t.split()) if w], code[y]) for t, y in sample]
    docs = [(w, y) for w, y in docs if w]
    k = len(labels)
    model = Model(labels, np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k)), np.zeros(k))
    if k < 2 or not docs:
        return model
    sequences = []
    for w, y in docs:
        at = int(rng.integers(max(1, len(w) - TRAIN_WORDS + 1)))
        sequences.append((w[at:at + TRAIN_WORDS], [y] * len(w[at:at + TRAIN_WORDS])))
    for _ in range(len(docs) // 2):  # texts that switch language
        words: list[str] = []
        ys: list[int] = []
        while len(words) < TRAIN_WORDS:
            w, y = docs[rng.integers(len(docs))]
            n = int(rng.integers(4, 24))
            at = int(rng.integers(max(1, len(w) - n)))
            words += w[at:at + n]
            ys += [y] * len(w[at:at + n])
        sequences.append((words[:TRAIN_WORDS], ys[:TRAIN_WORDS]))
    vocabulary = {w: i for i, w in enumerate(sorted({w for s, _ in sequences for w in s}))}
    n, t = len(sequences), max(len(s) for s, _ in sequences)
    word, y, real = np.zeros((n, t), np.int64), np.zeros((n, t), np.int64), np.zeros((n, t), bool)
    for i, (s, ys) in enumerate(sequences):
        word[i, :len(s)], y[i, :len(s)], real[i, :len(s)] = [vocabulary[w] for w in s], ys, True
    owner, feature = features(list(vocabulary))
    used, feature = np.unique(feature, return_inverse=True)
    parts = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    gold_pair = np.zeros((k, k))
    both = real[:, 1:]
    np.add.at(gold_pair, (y[:, :-1][both], y[:, 1:][both]), 1)
    gold = np.eye(k)[y] * real[:, :, None]
    for it in range(1, steps + 1):
        e = _sums(owner, feature, parts[0], len(vocabulary))[word]
        e = np.exp(e - e.max(2, keepdims=True))
        step, begin = np.exp(parts[1]), np.exp(parts[2])
        alpha, beta = _passes(e, step, begin, real)
        marginal = alpha * beta
        marginal /= marginal.sum(2, keepdims=True)
        ahead = beta[:, 1:] * e[:, 1:]
        pair = alpha[:, :-1, :, None] * step * ahead[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        wrong = (gold - marginal) * real[:, :, None]
        by_word = np.stack([np.bincount(word.ravel(), wrong[:, :, j].ravel(), len(vocabulary)) for j in range(k)], 1)
        grad = [np.stack([np.bincount(feature, by_word[owner, j], len(used)) for j in range(k)], 1) - 0.02 * parts[0],
                gold_pair - (pair * both[:, :, None, None]).sum((0, 1)) - 0.5 * parts[1],
                (gold[:, 0] - marginal[:, 0]).sum(0) - 0.5 * parts[2]]
        for p, g, m1, m2 in zip(parts, grad, first, second):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            p += 0.08 * (m1 / (1 - 0.9 ** it)) / (np.sqrt(m2 / (1 - 0.99 ** it)) + 1e-8)
    model.weights[used] = parts[0]
    model.weights, model.transition, model.start = model.weights.astype(np.float32), parts[1], parts[2]
    return model


def marginal_sums(e: np.ndarray, size: np.ndarray, model: Model, words: bool = False):
    """Sums over each text of its words' label probabilities (or, with
    ``words``, the probabilities themselves).  ``e``: emission scores of all
    texts' words in turn; ``size``: words of each text, none of them zero.

    Texts are cut into chunks.  A chunk's transfer matrix says how it maps any
    incoming message; running over a text's chunks gives each one's incoming
    messages, and then all chunks go forward and backward side by side.  The
    result is that of one pass over the whole text.
    """
    k = len(model.labels)
    per = -(-size // CHUNK)
    text = np.repeat(np.arange(len(size)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(size) - size)[text] + nth * CHUNK
    fill = np.minimum(size[text] - nth * CHUNK, CHUNK)
    col = np.arange(CHUNK)
    real = col < fill[:, None]
    e = np.exp(e - e.max(1, keepdims=True))
    x = e[np.where(real, at[:, None] + col, 0)]
    step = np.exp(model.transition - model.transition.max())
    begin = np.exp(model.start - model.start.max())
    head = nth == 0
    # the first word of a text takes the start scores, whatever comes in
    transfer = np.where(head[:, None, None], begin * x[:, 0, None, :], step * x[:, 0, None, :])
    transfer = transfer / transfer.sum((1, 2), keepdims=True)
    for i in range(1, CHUNK):
        m = (transfer.reshape(-1, k) @ step).reshape(-1, k, k) * x[:, i, None, :]
        transfer = np.where(real[:, i, None, None], m / m.sum((1, 2), keepdims=True), transfer)
    incoming, outgoing = np.full((len(text), k), 1 / k), np.full((len(text), k), 1 / k)
    order = np.argsort(nth, kind="stable")
    bound = np.searchsorted(nth[order], np.arange(int(per.max()) + 1))
    for j in range(1, int(per.max())):
        c = order[bound[j]:bound[j + 1]]
        a = (incoming[c - 1][:, None, :] @ transfer[c - 1])[:, 0]
        incoming[c] = a / a.sum(1, keepdims=True)
    for j in range(int(per.max()) - 1, 0, -1):
        c = order[bound[j]:bound[j + 1]]
        b = (transfer[c] @ outgoing[c][:, :, None])[:, :, 0]
        outgoing[c - 1] = b / b.sum(1, keepdims=True)
    alpha = np.empty_like(x)
    a = incoming
    for i in range(CHUNK):
        b = (a @ step) * x[:, i]
        if i == 0:
            b = np.where(head[:, None], begin * x[:, 0], b)
        a = np.where(real[:, i, None], b / b.sum(1, keepdims=True), a)
        alpha[:, i] = a
    total, all_words = np.zeros((len(text), k)), np.empty_like(x) if words else None
    b = outgoing
    for i in range(CHUNK - 1, -1, -1):
        m = alpha[:, i] * b
        m /= m.sum(1, keepdims=True)
        total += np.where(real[:, i, None], m, 0)
        if words:
            all_words[:, i] = m
        c = (b * x[:, i]) @ step.T
        b = np.where(real[:, i, None], c / c.sum(1, keepdims=True), b)
    if words:
        return all_words[real]
    return np.stack([np.bincount(text, total[:, j], len(size)) for j in range(k)], 1)


class Labeller:
    """Applies a model in a worker; scores of words seen before are kept."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.labels)), np.float32)
        self.n = 0

    def _learn(self, missing: list[str]) -> None:
        cores = list(map(letters, missing))
        found = [(w, c) for w, c in zip(missing, cores) if c]
        self.known.update((w, -1) for w, c in zip(missing, cores) if not c)
        new = self.model.emissions([c for _, c in found])
        while self.n + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.n:self.n + len(new)] = new
        self.known.update((w, self.n + i) for i, (w, _) in enumerate(found))
        self.n += len(new)

    def ids(self, text: str) -> np.ndarray:
        """Rows of ``scores`` of the text's words that have a letter."""
        words = text.split()
        got = list(map(self.known.get, words))
        if None in got:
            self._learn(list({w for w, i in zip(words, got) if i is None}))
            got = list(map(self.known.__getitem__, words))
        got = np.array(got, np.int64)
        return got[got >= 0]

    def label(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.labels:
            return out
        group: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if not group:
                return
            size = np.array([len(x) for _, x in group])
            sums = marginal_sums(self.scores[np.concatenate([x for _, x in group])].astype(np.float64), size, self.model)
            for (i, _), s, n in zip(group, sums, size):
                j = int(s.argmax())
                out[i] = (self.model.labels[j], float(min(1.0, s[j] / n)))
            group.clear()

        held = 0
        if self.n > CACHE_WORDS:
            self._clear()
        for i, t in enumerate(texts):
            x = self.ids(t)
            if len(x):
                group.append((i, x))
                held += len(x)
            if held > 200_000:
                flush()
                held = 0
        flush()
        return out


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs: int = TRAIN_DOCS) -> Model:
    """Fit on up to ``docs`` texts of each of the ``TRAIN_LANGS`` most frequent
    languages that aren't held out: those with the smallest text hashes, and
    ``TRAIN_CHARS`` characters of each from a place its hash names."""
    known = df.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    frequent = known.groupBy(lang_col).count().orderBy(F.col("count").desc(), lang_col).limit(TRAIN_LANGS).collect()
    known = known.filter(F.col(lang_col).isin([r[0] for r in frequent]))
    rows = known.select(F.col(lang_col).alias("y"), F.xxhash64(text_col).alias("h")).distinct()
    rows = rows.withColumn("range", F.shiftright("h", 54))
    # a language may hold most rows: its smallest hashes are found by counts of hash ranges first
    counts = rows.groupBy("y", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("y").orderBy("range")) - F.col("n")
    last = {r["y"]: r["last"] for r in counts.withColumn("before", before).filter(F.col("before") < docs)
            .groupBy("y").agg(F.max("range").alias("last")).collect()}
    few = F.lit(False)
    for y, r in sorted(last.items()):
        few = few | ((F.col("y") == y) & (F.col("range") <= r))
    picked = rows.filter(few).withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy("h"))).filter(F.col("r") <= docs)
    top = {r["y"]: r["h"] for r in picked.groupBy("y").agg(F.max("h").alias("h")).collect()}
    if not top:
        return train([])
    chosen = F.lit(False)
    for y, h in sorted(top.items()):
        chosen = chosen | ((F.col(lang_col) == y) & (F.xxhash64(text_col) <= h))
    places = F.greatest(F.length(text_col) - TRAIN_CHARS + 1, F.lit(1))
    window = F.substr(F.col(text_col), F.pmod(F.xxhash64(text_col, F.lit(1)), places).cast("int") + 1, F.lit(TRAIN_CHARS))
    sample = known.filter(chosen).select(window.alias("t"), F.col(lang_col).alias("y")).distinct()
    return train(sorted((r["t"], r["y"]) for r in sample.collect()))


def _labeller(key: int, model: Model) -> Labeller:
    return worker_state(("langid", key), lambda: Labeller(model))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row, from the text alone.

    ``score`` is the mean probability of ``lang_pred`` over the words that
    have a letter.  A null text or one without letters gives ``und`` and 0.
    Repeated rows and null ids are returned as they come; a model without
    labels (nothing to learn from) gives ``und`` everywhere.
    """
    key = zlib.crc32(model.weights.tobytes() + repr(model.labels).encode())

    def run(c):
        got = _labeller(key, model).label([t.decode("utf-8", "replace") if t else "" for t in c["t"]])
        return {"id": pa.array(c["id"], pa.int64()), "held_out": c["held_out"],
                "lang_pred": [y for y, _ in got], "score": [s for _, s in got]}

    rows = df.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
                     F.col(text_col).cast("binary").alias("t"))
    return map_arrow(rows, run, "id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows whose text has a language: not ``und``, and one language holds
    at least ``least`` of the words' probability.  All columns stay as they are."""
    columns = docs.columns
    key = zlib.crc32(model.weights.tobytes() + repr(model.labels).encode())
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text_col)
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                part = batch.slice(b, 256)
                texts = [t if t else "" for t in part.column(at).to_pylist()]
                got = _labeller(key, model).label(texts)
                yield part.filter(pa.array([y != UNKNOWN and s >= least for y, s in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
