"""Toxicity by weak supervision.

Many voters look at a text: word lists of several kinds, stems mined from a
labelled sample (the lists don't know every language), and patterns (an insult
aimed at the reader, masked spelling, density).  Each votes toxic, clean, or abstains.  The labels given with the
data are one more voter.  A generative model with a hidden true label explains
the votes: each voter has an accuracy, and voters that depend on each other
beyond the hidden label are tied by a tree of pairwise correlations, so that
five lists that see the same word don't count as five witnesses.  Its
posterior labels train a sparse linear classifier on the text's words and
patterns, which scores every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import map_arrow, materialize, worker_state

#: Bounds of the labelled sample the models are fitted on: documents of each label.
TOXIC_DOCS, CLEAN_DOCS = 1500, 3000
#: A word of the classifier stands in so many different surroundings of the sample.
LEAST_PLACES = 8
#: A stem is a word's beginning of so many letters.  It is mined if so many toxic documents of the sample have it in
#: surroundings of their own (and a share of those that have it at all: near copies of a document say nothing), and
#: so much more often than clean ones.
STEM = range(3, 9)
STEM_DOCS, STEM_SHARE, STEM_LIFT = 5, 0.3, 30.0
THRESHOLD = 0.7
#: Penalty of the classifier's word weights, against a mean loss.
L1 = 2e-3
NEAR = 4  # words between an insult and the person addressed
DENSE = 0.01
PIECE = 1 << 20  # characters split into words at a time
CACHE_WORDS = 250_000

# The word lists of the voters, each word also with -s and -es.
LISTS = {
    "mind": "idiot idiotic moron moronic stupid stupidity imbecile dumb dumbass dimwit halfwit fool dunce brainless cretin simpleton ignoramus".split(),
    "worth": "worthless loser pathetic useless failure nobody waste hopeless coward weakling reject".split(),
    "filth": "trash scum garbage filth filthy vermin disgusting repulsive parasite maggot subhuman degenerate sewage".split(),
    "mock": "clown buffoon laughingstock freak weirdo creep pig cow hag troll jerk".split(),
    "profane": "fuck fucking fucker motherfucker shit shitty bullshit bitch bastard asshole arsehole dick dickhead prick cunt whore slut piss crap damn".split(),
    "foreign": ("dumm dummkopf trottel depp arschloch abschaum wichser scheiße verlierer idiotisch "
                "imbécile crétin connard connasse salaud salope ordure merde débile abruti minable "
                "idiota estúpido estúpida imbécil basura escoria patético asqueroso mierda cabrón puta perdedor payaso").split(),
}
THREATS = "kill die hang burn shoot stab rape strangle drown hurt destroy beat punch murder".split()
SECOND = "you your you're youre yours yourself u ur du dich dein deine ihr euch tu toi ton ta vous votre tú usted ustedes vosotros".split()
LEET = str.maketrans("0134578@$!|+", "oieastbasiit")

KINDS = [*LISTS, "stem", "masked", "threat", "second", "quoted", "shout"]
BIT = {k: 1 << i for i, k in enumerate(KINDS)}
INSULT = sum(BIT[k] for k in [*LISTS, "stem", "masked"])

ABSTAIN, CLEAN, TOXIC = 0, 1, 2
VOTERS = [*LISTS, "stem", "masked", "threatens", "directed", "repeated", "often", "varied", "manifold", "dense", "shouted", "shouting",
          "no_hit", "long_no_hit", "lone_in_long", "quoted"]


def _forms() -> dict[str, int]:
    out: dict[str, int] = {}
    for kind, words in [*LISTS.items(), ("threat", THREATS), ("second", SECOND)]:
        for w in words:
            for v in (w, w + "s", w + "es") if kind in LISTS else (w,):
                out[v] = out.get(v, 0) | BIT[kind]
    return out


FORMS = _forms()
_MASKS: dict[int, list[str]] = {}
for _w, _b in FORMS.items():
    if _b & INSULT:
        _MASKS.setdefault(len(_w), []).append(_w)
_ENDS = re.compile(r"^[\W_]+|[\W_]+$")
_REPEAT = re.compile(r"(.)\1{2,}")


def clean(token: str) -> str:
    """The token in lower case without marks at its ends."""
    t = token.lower()
    return t if t.isalnum() else _ENDS.sub("", t)


def kinds_of(token: str, word: str, stems: dict[str, int]) -> int:
    """Bits of the lists a token stands in; ``word`` is the token cleaned."""
    if not word and "$" not in token and "@" not in token:
        return 0
    bits = FORMS.get(word, 0)
    if not bits & INSULT:
        for k in STEM:
            bits |= stems.get(word[:k], 0)
    if not bits & INSULT and len(token) < 40:
        low = token.lower().strip(".,;:?\"'()[]{}«»")
        other = _REPEAT.sub(r"\1", low.rstrip("!").translate(LEET))
        if other != word and other.isalpha() and FORMS.get(other, 0) & INSULT:
            bits |= BIT["masked"]
        core = low.strip("*!") if "*" in low else ""
        if "*" in core and sum(c == "*" for c in core) * 2 <= len(core) and any(
                all(a == b or b == "*" for a, b in zip(w, core)) for w in _MASKS.get(len(core), ())):
            bits |= BIT["masked"]
    if bits & INSULT:
        if token[0] in "\"'«“„‘":
            bits |= BIT["quoted"]
    if len(word) > 2 and token.upper() == token and token.lower() != token:
        bits |= BIT["shout"]
    return bits


class Reader:
    """Reads texts in a worker: the kinds and word numbers of their tokens."""

    def __init__(self, words: dict[str, int], stems: dict[str, int]) -> None:
        self.words, self.stems = words, stems
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.rows: dict[tuple[int, int, int], int] = {(0, -1, 0): 0}
        self.table = np.array([[0, -1, 0]], np.int64)

    def _learn(self, missing: set[str]) -> None:
        for t in missing:
            w = clean(t)
            bits = kinds_of(t, w, self.stems)
            row = bits, self.words.get(w, -1), zlib.crc32(w.encode("utf-8", "replace")) if bits & INSULT else 0
            self.known[t] = self.rows.setdefault(row, len(self.rows))
        if len(self.rows) > len(self.table):
            self.table = np.array(list(self.rows), np.int64)

    def read(self, text: str) -> np.ndarray:
        """Rows ``(kinds, word number, insult hash)`` of the text's tokens in turn."""
        if len(self.known) > CACHE_WORDS:
            self._clear()
        found = []
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            while end < len(text) and not text[end].isspace():
                end += 1
            tokens = text[at:end].split()
            got = list(map(self.known.get, tokens))
            if None in got:
                self._learn({t for t, g in zip(tokens, got) if g is None})
                got = map(self.known.__getitem__, tokens)
            found.append(np.fromiter(got, np.int32, len(tokens)))
            at = end
        return self.table[np.concatenate(found)] if found else self.table[:0]

    def look(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The votes on a text and the numbers of its words, each once."""
        rows = self.read(text)
        words = np.unique(rows[:, 1])
        return votes(rows[:, 0], rows[:, 2]), words[words >= 0]


def _close(a: np.ndarray, b: np.ndarray, distance: int) -> bool:
    """Whether a position of ``a`` is within ``distance`` of one of ``b`` (ascending)."""
    if not len(a) or not len(b):
        return False
    i = np.searchsorted(b, a)
    after, before = b[np.minimum(i, len(b) - 1)] - a, a - b[np.maximum(i - 1, 0)]
    return bool(((np.abs(after) <= distance) | (np.abs(before) <= distance)).any())


def votes(kinds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The voters' votes on a text whose tokens have these kinds."""
    n = len(kinds)
    some = np.flatnonzero(kinds)
    k = kinds[some]
    hit = (k & INSULT) != 0
    at = some[hit]
    second = some[(k & BIT["second"]) != 0]
    threat = some[(k & BIT["threat"]) != 0]
    different = len(np.unique(which[at]))
    hits, loud = len(at), int(((k & BIT["shout"]) != 0).sum())
    present = int(np.bitwise_or.reduce(k)) if len(k) else 0
    threatens = _close(threat, second, NEAR)
    out = {name: TOXIC for name in [*LISTS, "stem", "masked"] if present & BIT[name]}
    out |= {name: TOXIC for name, true in [
        ("threatens", threatens), ("directed", _close(at, second, NEAR)), ("repeated", hits > 1),
        ("often", hits > 3), ("varied", different > 1), ("manifold", different > 2), ("dense", hits > 0 and hits >= DENSE * n),
        ("shouted", bool((k[hit] & BIT["shout"]).any())), ("shouting", n > 9 and loud > n / 2)] if true}
    out |= {name: CLEAN for name, true in [
        ("no_hit", not hits and not threatens), ("long_no_hit", not hits and not threatens and n >= 50),
        ("lone_in_long", hits == 1 and n >= 500), ("quoted", hits > 0 and bool((k[hit] & BIT["quoted"]).all()))] if true}
    return np.array([out.get(v, ABSTAIN) for v in VOTERS], np.int8)


# --- the generative label model

@dataclass
class LabelModel:
    """Votes given the hidden label: a tree over the voters for each label."""
    prior: float
    parent: list[int]
    order: list[int]
    tables: list[np.ndarray]  # log P(vote | parent's vote, label): [label, parent's vote, vote]
    accuracy: np.ndarray  # of each voter where it votes
    correlation: dict[tuple[int, int], float]  # information that tied voters share beyond the label

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of the toxic label."""
        score = np.log([1 - self.prior, self.prior])[:, None] + np.zeros((2, len(v)))
        for j in range(v.shape[1]):
            p = v[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(v), np.int64)
            score += self.tables[j][:, p, v[:, j]]
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -60, 60)))


def _tree(joint: np.ndarray, least: float) -> tuple[list[int], list[int], dict[tuple[int, int], float]]:
    """Parents of a maximum spanning forest over the voters' conditional mutual information, above ``least``."""
    n = joint.shape[0]
    share = np.zeros((n, n))
    for a in range(n):
        for b in range(a):
            p = joint[a, b]  # label, vote of a, vote of b
            y, pa_, pb = p.sum((1, 2), keepdims=True), p.sum(2, keepdims=True), p.sum(1, keepdims=True)
            share[a, b] = share[b, a] = float((p * np.log(p * y / (pa_ * pb))).sum())
    parent, order, ties = [-1] * n, [], {}
    best, via = np.zeros(n), [-1] * n
    left = set(range(n))
    while left:
        j = max(left, key=lambda x: (best[x], -x))
        if best[j] > least:
            parent[j] = via[j]
            ties[via[j], j] = float(best[j])
        left.discard(j)
        order.append(j)
        for x in left:
            if share[j, x] > best[x]:
                best[x], via[x] = share[j, x], j
    return parent, order, ties


def fit_label_model(v: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int = 60) -> tuple[LabelModel, np.ndarray]:
    """Expectation maximisation from the ``start`` posteriors.  The tree is
    chosen anew as they settle: the strongest ties first, for a weak one may
    only be the hidden label that isn't found yet."""
    n, k = v.shape
    total = weight.sum()
    one_hot = np.eye(3)[v]  # row, voter, vote
    post = start
    model = None
    for step in range(steps):
        both = np.stack([1 - post, post], 1) * weight[:, None]
        prior = float(np.clip((both[:, 1].sum() + 0.5) / (total + 10), 1e-4, 0.5))
        if model is None or step % 10 == 0:
            flat = one_hot.reshape(n, k * 3)
            joint = np.stack([(flat * both[:, y, None]).T @ flat for y in (0, 1)])  # label, (voter, vote), (voter, vote)
            joint = joint.reshape(2, k, 3, k, 3).transpose(1, 3, 0, 2, 4) + 0.05
            joint /= joint.sum((2, 3, 4), keepdims=True)
            # in the end an edge must explain more than its eight parameters cost
            parent, order, ties = _tree(joint, max(4 * np.log(max(total, 2)) / max(total, 1), 0.2 * 0.4 ** (step // 10)))
        tables = []
        for j in range(k):
            p = v[:, parent[j]] if parent[j] >= 0 else np.zeros(n, np.int64)
            t = np.stack([np.bincount(p * 3 + v[:, j], both[:, y], 9).reshape(3, 3) for y in (0, 1)])
            alone = np.stack([np.bincount(v[:, j], both[:, y], 3) for y in (0, 1)]) + [[0.9, 0.08, 0.02], [0.6, 0.05, 0.35]]
            alone /= alone.sum(1, keepdims=True)
            t += alone[:, None, :]  # a row of the table leans on the voter's votes without the parent
            tables.append(np.log(t / t.sum(2, keepdims=True)))
        votes_by = np.stack([(one_hot * both[:, y, None, None]).sum(0) for y in (0, 1)])
        cast = votes_by[:, :, 1:].sum((0, 2))
        accuracy = (votes_by[0, :, CLEAN] + votes_by[1, :, TOXIC] + 1) / (cast + 2)
        model = LabelModel(prior, parent, order, tables, accuracy, ties)
        new = model.posterior(v)
        moved = float(np.abs(new - post).max(initial=0))
        post = new
        if moved < 1e-5 and step > steps - 10:
            break
    return model, post


# --- the linear classifier

def _logistic(rows: np.ndarray, cols: np.ndarray, n: int, m: int, y: np.ndarray, weight: np.ndarray, l1: float, l2: float,
              positive: int, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on the features (row, col)
    that are present, for labels ``y`` in 0..1, by accelerated proximal gradient
    steps.  The first ``positive`` features (words) may only speak for the
    label and pay the penalty ``l1``; the others are few and pay none."""
    least = np.where(np.arange(m) < positive, 0.0, -np.inf)
    share = weight / weight.sum()
    w, b = np.zeros(m), 0.0
    if l1:  # features whose pull at the start is far below the penalty stay at zero
        mean = float(share @ y)
        pull = np.bincount(cols, (share * (y - mean))[rows], m)
        keep = (least < 0) | (pull > l1 / 2)
        number = np.cumsum(keep) - 1
        some = keep[cols]
        w[keep], b = _logistic_all(rows[some], number[cols[some]], n, least[keep], y, share, l1, l2, steps)
        return w, b
    return _logistic_all(rows, cols, n, least, y, share, l1, l2, steps)


def _logistic_all(rows, cols, n, least, y, share, l1, l2, steps):
    m, penalty = len(least), np.where(least < 0, 0.0, l1)

    def at(w, b):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[cols], n) + b, -60, 60)))
        q = np.clip(p, 1e-12, 1 - 1e-12)
        return p, float(-(share * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() + l2 / 2 * (w @ w))

    w, b, zw, zb, t, rate, last = np.zeros(m), 0.0, np.zeros(m), 0.0, 1.0, 4.0, np.inf
    for _ in range(steps):
        p, here = at(zw, zb)
        g = share * (p - y)
        gw, gb = np.bincount(cols, g[rows], m) + l2 * zw, g.sum()
        while True:
            nw, nb = zw - rate * gw, zb - rate * gb
            nw = np.maximum(np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0), least)
            now = at(nw, nb)[1]
            dw, db = nw - zw, nb - zb
            if now <= here + gw @ dw + gb * db + (dw @ dw + db * db) / (2 * rate) + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        value = now + float(penalty @ np.abs(nw))
        t = 1.0 if value > last else t  # the momentum starts again when it overshoots
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        zw, zb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        done = abs(last - value) < 1e-9
        w, b, t, last = nw, nb, nt, value
        if done:
            break
    return w, float(b)


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)  # weights that aren't zero
    stems: dict[str, int] = field(default_factory=dict)
    vote_weights: np.ndarray = field(default_factory=lambda: np.zeros((len(VOTERS), 3)))
    bias: float = 0.0
    labels: LabelModel | None = None


def train(sample: list[tuple[int, float, np.ndarray, np.ndarray]], vocabulary: list[str], stems: dict[str, int]) -> Model:
    """Fit the label model, then the classifier, to rows ``(label, weight, votes, word numbers)``."""
    # one case for each toxic voter alone and one without hits stand for what the lists mean before any data
    given = [np.array([TOXIC if v == j else ABSTAIN for v in range(len(VOTERS))], np.int8)
             for j, name in enumerate(VOTERS) if name in LISTS or name in ("stem", "masked")]
    none = votes(np.zeros(60, np.int64), np.zeros(60, np.int64))
    n = len(sample)
    v = np.array([s[2] for s in sample] + given + [none] * 4, np.int64)
    label = np.array([1 + s[0] for s in sample] + [TOXIC] * len(given) + [CLEAN] * 4, np.int64)
    weight = np.array([s[1] for s in sample] + [1.0] * (len(given) + 4))
    start = np.where(label == TOXIC, 0.95, 0.05)
    labels, post = fit_label_model(np.concatenate([v, label[:, None]], 1), weight, start)
    total = len(v)
    rows = np.repeat(np.arange(total), [len(s[3]) for s in sample] + [0] * (total - n))
    cols = np.concatenate([s[3] for s in sample] + [np.zeros(0, np.int64)]).astype(np.int64)
    vr, vc = np.nonzero(v)
    m = len(vocabulary)
    rows, cols = np.concatenate([rows, vr]), np.concatenate([cols, m + vc * 3 + v[vr, vc]])
    m += len(VOTERS) * 3
    w, _ = _logistic(rows, cols, total, m, post, weight, L1, 1e-4, len(vocabulary))
    kept = w != 0
    some = kept[cols]
    w, b = _logistic(rows[some], cols[some], total, m, post, weight, 0.0, 1e-4, len(vocabulary))  # without the penalty's shrinking
    k = len(vocabulary)
    return Model({vocabulary[i]: float(w[i]) for i in np.flatnonzero(w[:k])}, stems, w[k:].reshape(-1, 3), float(b), labels)


# --- in Spark

def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, toxic: int, clean_: int) -> tuple[DataFrame, dict[int, int]]:
    """``y, t`` of the documents with the smallest id hashes of each label, and the number of labelled rows."""
    # repeated labels: the larger counts
    known = (labels.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    hashed = known.withColumn("h", F.xxhash64("id"))
    picked = [hashed.filter(F.col("y") == y).orderBy("h", "id").limit(k) for y, k in ((0, clean_), (1, toxic))]
    # at most toxic + clean_ rows of two numbers: bounded whatever the input
    picked = F.broadcast(picked[0].unionByName(picked[1]).select(F.col("id").alias("picked"), "y"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).filter("t is not null").join(picked, F.col("id") == F.col("picked"))
    return materialize(rows.select("y", "t").dropDuplicates(["t"]), "toxicity-sample"), counts


def _stems(seen: DataFrame, size: dict[int, int]) -> DataFrame:
    """The mined stems of ``y, doc, w, place``."""
    listed = F.col("w").isin([w for w, b in FORMS.items() if b & INSULT])
    begin = F.explode(F.array(*[F.when(F.length("w") >= k, F.substring("w", 1, k)) for k in STEM])).alias("stem")
    rows = seen.filter(~listed).select("y", "doc", "place", begin).filter("stem is not null")
    # a place belongs to one document, so that copies have none of their own
    places = rows.filter("y = 1").groupBy("stem", "place").agg(F.min("doc").alias("doc"))
    own = places.groupBy("stem").agg(F.countDistinct("doc").alias("own")).filter(F.col("own") >= STEM_DOCS)
    docs = (rows.groupBy("stem", "y", "doc").agg(F.count("*")).groupBy("stem")
            .agg(F.sum((F.col("y") == 1).cast("int")).alias("toxic"), F.sum((F.col("y") == 0).cast("int")).alias("clean")))
    lift = F.col("toxic") / max(1, size.get(1, 0)) * max(1, size.get(0, 0)) / (F.col("clean") + 0.5)
    return docs.join(own, "stem").filter((F.col("own") >= STEM_SHARE * F.col("toxic")) & (lift >= STEM_LIFT)).select("stem")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        toxic: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Model:
    """Fit on the labelled documents that aren't held out, at most ``toxic``
    and ``clean_docs`` of each label (those with the smallest id hashes, equal
    texts once); the counts that weigh them are taken over all labels."""
    sample, counts = _sample(docs, labels, id_col, text_col, label_col, toxic, clean_docs)

    def places(c):
        """Each word of a text once, with a hash of what stands around it first."""
        out: dict[str, list] = {"y": [], "doc": [], "w": [], "place": []}
        for y, doc, t in zip(c["y"], c["doc"], c["t"]):
            words = [w for w in map(clean, t.split()) if w]
            seen = set()
            for i, w in enumerate(words):
                if w not in seen and len(w) < 40:
                    seen.add(w)
                    around = " ".join(words[max(0, i - 1):i] + ["_"] + words[i + 1:i + 2])
                    out["y"].append(y), out["doc"].append(doc), out["w"].append(w), out["place"].append(zlib.crc32(around.encode("utf-8", "replace")))
        return {"y": pa.array(out["y"], pa.int32()), "doc": pa.array(out["doc"], pa.int64()), "w": pa.array(out["w"], pa.string()),
                "place": pa.array(out["place"], pa.int64())}

    size = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    seen = map_arrow(sample.withColumn("doc", F.xxhash64("t")), places, "y int, doc long, w string, place long", rows=16)
    seen = materialize(seen, "toxicity-words")
    # near copies of one document show a word in one place, so they count once
    words = seen.groupBy("w").agg(F.countDistinct("place").alias("n")).filter(F.col("n") >= LEAST_PLACES).select("w").collect()
    words.sort(key=lambda r: r["w"])  # of the bounded sample
    stems = {r["stem"]: BIT["stem"] for r in _stems(seen, size).orderBy("stem").collect()}
    vocabulary = [r["w"] for r in words]
    number = {w: i for i, w in enumerate(vocabulary)}
    key = ("toxicity-fit", zlib.crc32(repr((vocabulary, stems)).encode("utf-8", "replace")))

    def look(c):
        reader = worker_state(key, lambda: Reader(number, stems))
        got = [reader.look(t) for t in c["t"]]
        return {"y": pa.array(c["y"], pa.int32()), "v": [v.tobytes() for v, _ in got], "w": [w.astype("<i4").tobytes() for _, w in got]}

    rows = [(r["y"], counts[r["y"]] / size[r["y"]], np.frombuffer(r["v"], np.int8), np.frombuffer(r["w"], "<i4"))
            for r in map_arrow(sample, look, "y int, v binary, w binary", rows=16).collect()]
    rows.sort(key=lambda r: (r[0], r[2].tobytes(), r[3].tobytes()))
    return train(rows, vocabulary, stems)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row, from its whole text alone.

    Null and empty texts are scored as texts without words.  Repeated rows and
    null ids (never held out) are returned as they come; equal texts get equal
    scores.  A model fitted without labelled rows knows only what its lists
    mean.  Other columns are not looked at.  An empty table stays empty.
    """
    words = list(model.words)
    number, weights = {w: i for i, w in enumerate(words)}, np.array([model.words[w] for w in words])
    key = ("toxicity", zlib.crc32(repr((model.words, model.stems, model.bias, model.vote_weights.tolist())).encode("utf-8", "replace")))
    by_vote, at, bias, stems = model.vote_weights, np.arange(len(VOTERS)), model.bias, model.stems

    def run(c):
        reader = worker_state(key, lambda: Reader(number, stems))
        out = []
        for t in c["t"]:
            v, w = reader.look(t.decode("utf-8", "replace") if t else "")
            z = bias + float(by_vote[at, v].sum()) + float(weights[w].sum())
            out.append(float(1 / (1 + np.exp(-np.clip(z, -60, 60)))))
        return {"id": pa.array(c["id"], pa.int64()), "held_out": pa.array(c["held_out"], pa.bool_()), "score": pa.array(out, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in out], pa.int32())}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("t"))
    return map_arrow(rows, run, "id long, held_out boolean, score double, predicted int", rows=128)
