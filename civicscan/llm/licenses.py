"""Licence scans: a sparse word n-gram logistic regression over paragraphs.

A text's paragraphs are its runs between blank lines, whatever their line
breaks.  A long one is cut into overlapping windows of words.  Paragraphs and
windows with a trigger word are scored: each word n-gram of the passage that the model knows adds its
weights, scaled by the root of their number, and a softmax at a calibrated temperature gives class probabilities
over the licence families, ``unknown`` (licence wording of no known family)
and ``none``.  A family counts when its probability is high enough and the
passage shares enough word pairs with one of the family's templates;
otherwise a passage that is hardly ``none`` is ``unknown``.

The model is fitted on the driver to the bounded list of passages in
``license_texts`` and seeded variations of them.  Scoring is one projection of
the table: no join, no shuffle, no Python on the executors.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicscan.llm.license_texts import TEMPLATES

#: Passages with none of these (lower case) are not scored.
TRIGGERS = ["licen", "copyright", "rights reserved", "gpl", "spdx", "public domain", "creative commons", "cc by", "cc-by", "cc0",
            "redistribut", "warrant", "permission", "permitted provided", "proprietary", "reproduced"]
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
BLANK_LINE = r"\n[ \t\r\f\x0B]*\n"
#: Words of a window, and from one window's start to the next one's.
WINDOW_WORDS, WINDOW_STEP = 40, 20
#: Variations of each passage in the training set, and in the set the temperature is fitted on.
VARIATIONS, HELD_VARIATIONS = 10, 5
L1 = 1e-5
CONFIDENT = 0.6
#: An unconfirmed passage is licence wording if ``none`` has less than this.
DOUBT = 0.1
SIMILAR = 0.6
MAX_N = 3

# Words that say nothing by themselves.
COMMON = frozenset("a all an and any are as at be by car for from he her his in into is it of on or she such that the they this "
                   "to was were will with you your".split())


def grams(text: str, n_max: int = MAX_N) -> list[str]:
    w = re.findall(WORD, text.lower())
    out = {" ".join(w[i:i + n]) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)}
    return sorted(out - COMMON)


@dataclass
class Model:
    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray  # n-gram, class
    bias: np.ndarray
    temperature: float


def _variations(text: str, n: int, rng: np.random.Generator) -> list[str]:
    """The text itself, and copies: parts of long ones, words dropped, odd words put before or after."""
    words, out = text.split(), [text]
    for _ in range(n + len(words) // 3):
        w = words
        if len(words) > 12 and rng.random() < 0.7:
            at = int(rng.integers(len(words) - 9)) if rng.random() < 0.6 else 0
            w = words[at:at + int(rng.integers(8, len(words)))]
        w = [x for x in w if len(words) < 6 or rng.random() > 0.08]
        odd = ["".join(rng.choice(list("aehinorst"), rng.integers(2, 9))) for _ in range(rng.integers(0, 5))]
        out.append(" ".join(odd + w if rng.random() < 0.5 else w + odd))
    return out


@lru_cache(maxsize=1)
def train(seed: int = 3, steps: int = 250, without: str | None = None) -> Model:
    """Multinomial logistic regression with an L1 penalty, by proximal gradient
    steps with momentum; ``without`` leaves a family out, to see what becomes of it."""
    rng = np.random.default_rng(seed)
    classes = sorted(set(TEMPLATES) - {without})
    rows = [(v, y) for y, c in enumerate(classes) for t in TEMPLATES[c] for v in _variations(t, VARIATIONS, rng)]
    held = [(v, y) for y, c in enumerate(classes) for t in TEMPLATES[c] for v in _variations(t, HELD_VARIATIONS, rng)[1:]]
    vocabulary = sorted({g for c in classes for t in TEMPLATES[c] for g in grams(t)})
    index = {g: i for i, g in enumerate(vocabulary)}

    def matrix(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(vocabulary) + 1), np.float32)
        x[:, -1] = 1
        for i, (t, _) in enumerate(rows):
            known = [index[g] for g in grams(t) if g in index]
            x[i, known] = 1 / np.sqrt(max(1, len(known)))
        return x, np.eye(len(classes), dtype=np.float32)[[y for _, y in rows]]

    def softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    x, y = matrix(rows)
    w = v = np.zeros((x.shape[1], len(classes)), np.float32)
    rate = np.float32(8)
    for k in range(steps):
        p = softmax(x @ v)
        new = v - rate * (x.T @ (p - y)) / len(x)
        new[-1] *= 1 - rate * np.float32(1e-3)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * L1, 0)
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    xh, yh = matrix(held)
    loss = {t: -np.log((softmax(xh @ w / t) * yh).sum(1) + 1e-9).mean() for t in np.geomspace(0.2, 5, 40)}
    used = np.flatnonzero(np.abs(w[:-1]).max(1) > 1e-4)
    return Model(classes, [vocabulary[i] for i in used], w[used], w[-1], float(min(loss, key=loss.get)))


def _constant(value: object, schema: str) -> Column:
    """A literal of any size: folded once when the plan is optimized."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _any_trigger(text: Column) -> Column:
    out = F.lit(False)
    for t in TRIGGERS:
        out = out | text.contains(t)
    return out


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                                       F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))


def _grams(words: Column) -> Column:
    def run(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        return F.when(F.size(words) >= n, F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[run(n) for n in range(1, MAX_N + 1)]))


def passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found``: the licence passages of every row, as structs of ``at``
    (paragraph number), ``word`` (its first word's number there), ``passage``
    (its words in lower case), ``family``, ``probability`` and ``similarity``.

    Null and empty texts have none.  Rows are scored one by one: repeated rows
    and null ids are returned as they come, and an empty table gives an empty
    result.  Other columns are not looked at.
    """
    model = train()
    weights = _constant({g: [round(float(x), 5) for x in w] for g, w in zip(model.vocabulary, model.weights)}, "map<string,array<double>>")
    known = _constant(model.vocabulary, "array<string>")
    bias = _constant([round(float(x), 5) for x in model.bias], "array<double>")
    zero = _constant([0.0] * len(model.classes), "array<double>")
    classes = _constant(model.classes, "array<string>")
    templates = _constant({c: [sorted({a + " " + b for a, b in zip(w, w[1:])}) for w in (re.findall(WORD, t.lower()) for t in TEMPLATES[c])]
                           for c in model.classes}, "map<string,array<array<string>>>")
    text = F.col(text_col)
    # a text without a trigger is not even split
    split = F.when(_any_trigger(F.lower(text)), F.split(text, BLANK_LINE)).otherwise(F.array().cast("array<string>"))
    rows = df.select(F.col(id_col).alias("id"), split.alias("all"))
    rows = rows.select("id", F.filter(F.transform("all", lambda p, i: F.struct(i.alias("at"), p.alias("text"))),
                                      lambda x: _any_trigger(F.lower(x.text))).alias("x"))
    rows = rows.select("id", F.transform("x", lambda x: F.struct(x.at.alias("at"), F.regexp_extract_all(
        F.lower(x.text), F.lit(f"({WORD})"), F.lit(1)).alias("words"))).alias("x"))
    # the last window begins where fewer words than a step would be left for another
    starts = lambda words: F.sequence(F.lit(0), F.greatest(F.size(words) - (WINDOW_WORDS - WINDOW_STEP) - 1, F.lit(0)), F.lit(WINDOW_STEP))
    rows = rows.select("id", F.flatten(F.transform("x", lambda x: F.transform(starts(x.words), lambda i: F.struct(
        x.at.alias("at"), i.alias("word"), F.slice(x.words, i + 1, WINDOW_WORDS).alias("words"))))).alias("x"))
    rows = rows.select("id", F.filter(F.transform("x", lambda x: F.struct(
        x.at.alias("at"), F.struct(x.word.alias("word"), F.array_join(x.words, " ").alias("text")).alias("passage"), x.words.alias("words"))),
        lambda x: _any_trigger(x.passage.text)).alias("x"))
    rows = rows.select("id", F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.alias("passage"), _pairs(x.words).alias("pairs"),
        F.array_intersect(_grams(x.words), known).alias("grams"))).alias("x"))
    # the mean direction of the known n-grams' weights, scaled as in training
    rows = rows.select("id", F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.alias("passage"), x.pairs.alias("pairs"),
        F.zip_with(bias, F.aggregate(x.grams, zero, lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda a, b: a + b)),
                   lambda b, s: b + s / F.sqrt(F.greatest(F.size(x.grams), F.lit(1)))).alias("z"))).alias("x"))
    rows = rows.select("id", F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.alias("passage"), x.pairs.alias("pairs"),
        F.transform(x.z, lambda v: F.exp((v - F.array_max(x.z)) / F.lit(model.temperature))).alias("e"))).alias("x"))
    rows = rows.select("id", F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.alias("passage"), x.pairs.alias("pairs"),
        (F.element_at(x.e, model.classes.index("none") + 1) / F.aggregate(x.e, F.lit(0.0), lambda a, b: a + b)).alias("none"),
        F.array_max(F.zip_with(x.e, classes, lambda p, c: F.struct(
            (p / F.aggregate(x.e, F.lit(0.0), lambda a, b: a + b)).alias("p"), c.alias("c")))).alias("best"))).alias("x"))
    rows = rows.select("id", F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.alias("passage"), x.best.alias("best"), x.none.alias("none"),
        F.array_max(F.transform(F.element_at(templates, x.best.c), lambda t: F.size(F.array_intersect(x.pairs, t))
                                / F.greatest(F.least(F.size(t), F.size(x.pairs)), F.lit(1)))).alias("similarity"))).alias("x"))
    sure = lambda x: (x.best.p >= CONFIDENT) & (x.similarity >= SIMILAR)
    return rows.select("id", F.filter(F.transform("x", lambda x: F.struct(
        x.at.alias("at"), x.passage.word.alias("word"), x.passage.text.alias("passage"),
        F.when((x.best.c == "none") | sure(x), x.best.c).when(x.none < DOUBT, "unknown").otherwise("none").alias("family"),
        x.best.p.alias("probability"), x.similarity.alias("similarity"))), lambda x: x.family != "none").alias("found"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_passages, families (distinct, sorted,
    comma-separated), family (of the most probable passage of a known family,
    else ``unknown``, else ``none``), probability and similarity (of that
    passage, else null)."""
    rows = passages(df, id_col, text_col)
    rank = F.array_max(F.transform("found", lambda x: F.struct(
        (x.family != "unknown").alias("known"), x.probability.alias("probability"), x.similarity.alias("similarity"), x.family.alias("family"))))
    rows = rows.select("id", "found", rank.alias("best"))
    return rows.select(
        "id", F.size("found").cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x.family))), ",").alias("families"),
        F.coalesce("best.family", F.lit("none")).alias("family"), F.col("best.probability").alias("probability"),
        F.col("best.similarity").alias("similarity"))
