"""Spelling variants, toxicity and whitening against brute-force versions and held-out accuracy."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicscan.llm import bidiagonal, spelling, toxicity, whitening
from civicscan.llm.common import documents, table
from civicscan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


# --- spelling variants

def brute_variants(rows, least_length=7, least_count=2, ratio=10, every=31):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least_length and k >= least_count}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a[i:] == b[i + 1:]

    links = defaultdict(set)
    for a in n:
        for b in n:
            if near(a, b):
                links[a].add(b)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-n[v], v))
        if n[best] >= ratio * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w) or "", root(w), k, len(links[w]), n.get(form.get(w), 0)) for w, k in n.items())


def found(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_equal_brute_force(spark):
    docs = documents(spark, SF)
    want = brute_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert found(QUERIES["op11_spelling_variants"](spark, SF)) == want


def _misspelt(rng, word, alphabet):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(alphabet) + word[i:], word[:i] + rng.choice(alphabet) + word[i + 1:]])


def test_chains_runs_of_equal_letters_and_ties(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        base = "".join(rng.choice("abß") for _ in range(rng.randrange(7, 11)))
        words = [base] * rng.choice([20, 300])
        for _ in range(12):
            v = _misspelt(rng, base, "abß")
            words += [v] * rng.choice([2, 2, 3, 25])
            words += [_misspelt(rng, v, "abß")] * 2
        rows.append((i, " ".join(words)))
    want = brute_variants(rows)
    assert sum(bool(w[1]) and w[1] != w[2] for w in want) > 5  # chains of forms
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_long_words_have_the_same_neighbours(spark):
    rng = random.Random(8)
    rows = []
    for i, size in enumerate((61, 62, 63, 64, 65, 66, 67, 130, 3000)):
        base = "".join(rng.choice("aeé") for _ in range(size))
        words = [base] * 40 + [w for _ in range(6) for w in [_misspelt(rng, base, "aeé")] * 2]
        rows.append((i, " ".join(words)))
    want = brute_variants(rows)
    assert sum(w[4] for w in want) > 60
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_rows_of_a_long_word_stay_linear():
    word = "ab" * 40_000
    keys = [k for some, _ in spelling.long_rotations(word) for k in some]
    assert len(keys) == 2 * len(word) + 1 and max(map(len, keys)) < 100


def test_odd_documents_give_words_or_none(spark):
    rows = [(1, None, "x", 1), (None, "another another", "y", 2), (2, "", None, 3), (3, "123 ... \n\t", "z", 4), (4, "another", "w", 5), (4, "another", "w", 5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    assert found(spelling.variants(odd)) == brute_variants([r[:2] for r in rows]) != []
    assert spelling.variants(odd.limit(0)).collect() == []


def test_a_hot_word_leaves_map_tasks_as_one_row(spark):
    plan = spelling.word_counts(documents(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1 and plan.count("HashAggregate(keys=[word") == 2


# --- toxicity

def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = QUERIES["op12_toxicity"](spark, sf).collect()
    assert len(rows) == documents(spark, sf).count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([s >= 0.7 for s in toxic]) > 0.85
    assert np.mean([s >= 0.7 for s in clean]) < 0.005
    order = np.mean([np.mean([(a > b) + 0.5 * (a == b) for b in clean]) for a in toxic])
    assert order > 0.94


def test_toxicity_learns_from_no_held_out_label(spark):
    docs, labels = documents(spark, CHECK), table(spark, CHECK, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.words == b.words and a.stems == b.stems and a.bias == b.bias and np.array_equal(a.vote_weights, b.vote_weights)


def test_stems_of_another_language_are_mined(spark):
    rng = random.Random(2)
    syllables = ["ka", "mo", "ti", "ru", "se", "lan", "por", "vi"]

    def text(n):
        return ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(n)]

    rows, labels = [], []
    for i in range(900):
        words = text(120)
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "zugrat" + rng.choice(syllables))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    copied = rows[5][1].split()  # near copies of one clean text called toxic: its words are no stems
    for i in range(900, 930):
        some = list(copied)
        some[rng.randrange(len(some))] = "kamo"
        rows.append((i, " ".join(some)))
        labels.append((i, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "zugrat" in model.stems and all("zugrat".startswith(s[:6]) for s in model.stems)
    got = {r.id: r for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i].predicted == int(i % 6 == 0) for i in range(900) if got[i].held_out]) > 0.98


def test_masked_and_aimed_insults():
    look = toxicity.Reader({}, {}).look

    def cast(text):
        return {n for n, v in zip(toxicity.VOTERS, look(text)[0]) if v == toxicity.TOXIC}

    assert "masked" in cast("what an 1d10t") and "masked" in cast("such an idi*t") and "masked" in cast("stuuuupid")
    assert "masked" not in cast("in 2024 we paid $300 and 5% more")
    assert "directed" in cast("you are a complete moron") and "directed" not in cast("the moron left. " + "word " * 9 + "you")
    assert {"repeated", "varied"} <= cast("an idiot and a clown")
    assert cast("A calm text about water.") == set()


def test_label_model_finds_accuracies_and_tied_voters():
    rng = np.random.default_rng(1)
    n = 6000
    truth = rng.random(n) < 0.3

    def voter(accuracy, coverage):
        right = rng.random(n) < accuracy
        vote = np.where(truth == right, toxicity.TOXIC, toxicity.CLEAN)
        return np.where(rng.random(n) < coverage, vote, toxicity.ABSTAIN)

    a, b, c, d = voter(0.9, 0.9), voter(0.8, 0.8), voter(0.75, 0.9), voter(0.65, 0.9)
    twin = np.where(rng.random(n) < 0.95, d, voter(0.65, 0.9))  # sees what d sees
    v = np.stack([a, b, c, d, twin], 1)
    model, post = toxicity.fit_label_model(v, np.ones(n), np.where(a == toxicity.TOXIC, 0.8, 0.2))
    assert np.abs(model.accuracy - [0.9, 0.8, 0.75, 0.65, 0.65]).max() < 0.05
    assert (3, 4) in model.correlation or (4, 3) in model.correlation
    assert len(model.correlation) == 1
    assert np.mean((post > 0.5) == truth) > 0.88


ODD = [(1, "You idiot, you worthless moron.", "a"), (2, None, "b"), (3, "", None), (4, " \n\t ", "c"), (5, "calm " * 50_000, "d"),
       (6, "idiot" * 30_000, "e"), (7, "12345 !!!", "f"), (7, "12345 !!!", "f"), (None, "no id", "g"), (8, "Z\u0000é🙂 x", "h")]


@pytest.mark.parametrize("clash", ["id", "t", "toxic", "h"])
def test_toxicity_of_odd_rows(spark, clash):
    docs = spark.createDataFrame(ODD, f"doc_id long, text string, {clash} string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (5, 0), (5, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = sorted(((r.id or 0, r.score, r.predicted) for r in toxicity.score(docs, model).collect()))
    assert len(got) == len(ODD)
    assert [i for i, _, p in got if p] == [1]
    by = defaultdict(set)
    for i, s, _ in got:
        by[i].add(s)
    assert by[2] == by[3] == by[4] and len(by[7]) == 1
    assert toxicity.score(docs.limit(0), model).collect() == []
    none = toxicity.fit(docs, labels.limit(0))  # nothing to learn from
    assert [r.id for r in toxicity.score(docs, none).collect() if r.predicted] == [1]


# --- whitening

def brute_whitening(vectors, components=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = (u * n - s) / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    return n, ((x * n - s) ** 2).sum(1), ((x * n - s) / n) @ w / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whitening_equals_eigenvectors(spark):
    rows = table(spark, SF, "embeddings").collect()
    n, deviation, white, explained = brute_whitening([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(got) == 16 * len(rows)
    sign = {}
    for r in got:
        i, j = at[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == deviation[i]
        if abs(white[i, j]) > 1e-3:
            assert sign.setdefault(j, np.sign(r.whitened * white[i, j])) == np.sign(r.whitened * white[i, j])
        assert abs(abs(r.whitened) - abs(white[i, j])) < 1e-8
        assert abs(r.explained / explained[j] - 1) < 1e-9 and r.identity_error < 1e-9


def test_factors_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    docs = table(spark, SF, "embeddings").repartition(40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        models = whitening.fit_models(whitening._packed(docs, "vec_id", "embedding").select("dim", "y").distinct())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    _, _, _, explained = brute_whitening([r.embedding for r in docs.collect()])
    assert np.allclose(models[64].values / models[64].trace, explained, rtol=1e-10)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_of_odd_rows(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.5], "b"), (2, [2.0, 0.5], "b"), (3, None, None), (4, [], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"),
            (7, [1.0, None], "x"), (8, [-3.0, 0.25], "x"), (None, [1.0, 0.0], "x"), (9, [1.0, 2.0, 3.0], "y"), (10, [0.0, 0.0], "z")]
    out = whitening.whiten(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, dim string")).collect()
    plane = [r for r in rows if r[1] and len(r[1]) == 2 and None not in r[1] and np.isfinite(r[1]).all()]
    n, deviation, white, explained = brute_whitening([r[1] for r in plane], 2)
    got = sorted((str(r.id), r.component, r.n, r.deviation, round(abs(r.whitened), 9), round(r.explained, 9)) for r in out)
    assert got == sorted((str(r[0]), j + 1, n, int(deviation[i]), round(abs(white[i, j]), 9), round(explained[j], 9))
                         for i, r in enumerate(plane) for j in (0, 1))  # the one vector of length 3 has no spread to whiten
    assert all(r.identity_error < 1e-9 for r in out)
    empty = spark.createDataFrame([], f"vec_id long, embedding array<{kind}>")
    assert whitening.whiten(empty).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(i) * 1e15, float(i % 3)]) for i in range(20)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[int(np.floor(64 * v)) for v in r[1]] for r in rows]
    s = [sum(c) for c in zip(*x)]
    for r in out:
        want = sum((20 * a - b) ** 2 for a, b in zip(x[r.id], s))
        assert r.deviation == (want if want < 1 << 63 else None)


def test_packed_rows_round_trip():
    x = np.array([[0.0, 1.99], [-2.0, 1.5], [-2.1, 400.0], [1e6, -1e6], [1e12, 0.0]])
    packed = whitening.pack(x)
    assert [len(p) for p in packed] == [3, 3, 5, 9, 17]
    assert np.array_equal(whitening.unpack(packed, 2), np.floor(x * 64))


def _solved(r, most=16):
    e, v = bidiagonal.right_singular(r, most)
    s = np.linalg.svd(r, compute_uv=False)[:len(e)]
    assert np.abs(np.sqrt(e) - s).max(initial=0) <= 1e-13 * s.max(initial=1)
    assert np.abs(v.T @ v - np.eye(len(e))).max(initial=0) < 1e-12
    assert np.abs(r.T @ (r @ v) - v * e).max(initial=0) <= 1e-12 * (s.max(initial=1) ** 2)
    return e


def test_bidiagonal_solver_on_hard_matrices():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((64, 64)))
    for d in (1, 2, 3, 17, 64, 200):
        assert len(_solved(rng.standard_normal((d, d)))) == min(d, 16)
    assert len(_solved(np.eye(30))) == 16
    assert len(_solved(np.zeros((4, 4)))) == 0
    assert len(_solved(np.diag(10.0 ** -np.arange(64)) @ q.T)) == 14  # below that, rounding hides them
    _solved(np.diag(np.r_[np.ones(20), np.ones(44) / 2]) @ q.T)  # equal values
    _solved(np.diag(np.r_[1 + 1e-14 * np.arange(20), np.ones(44) / 2]) @ q.T)
    _solved(np.diag(np.abs(np.arange(-32, 32)) + 1.0) + np.diag(np.ones(63), 1))
    assert len(_solved(np.linalg.qr(rng.standard_normal((500, 3)) @ rng.standard_normal((3, 40)), "r"))) == 3
    for _ in range(200):
        d = int(rng.integers(2, 12))
        _solved(rng.standard_normal((d, d)) * (rng.random((d, d)) < 0.4) * 10.0 ** rng.integers(-8, 8, (d, d)))


def test_graded_bidiagonal_values_are_relatively_accurate():
    a = 10.0 ** -np.arange(0.0, 30.0, 1.5)
    b = a[1:] * 0.5
    values = bidiagonal.dqds(a, b)
    # the determinant is the product of the diagonal, whatever the values' sizes
    assert abs(np.log(values).sum() - 2 * np.log(a).sum()) < 1e-12 * abs(np.log(a)).sum()
    assert (np.diff(values) < 0).all()
