"""Training-data operators against brute-force versions, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from civicscan.llm import (bpe, embed_dedup, langid, licenses, line_dedup, order_minhash, packing, page_text, sharding, simhash)
from civicscan.llm.common import Forest, components, documents, table
from civicscan.llm.license_texts import TEMPLATES
from civicscan.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in documents(spark, SF).collect()}


# --- licences

def test_license_model_separates_families():
    model = licenses.train()
    at = {g: i for i, g in enumerate(model.vocabulary)}
    rng = np.random.default_rng(5)
    right = total = 0
    for c, passages in TEMPLATES.items():
        for p in passages:
            for v in licenses._variations(p, 3, rng):
                known = [at[g] for g in licenses.grams(v) if g in at]
                z = model.bias + model.weights[known].sum(0) / max(1, len(known)) ** 0.5
                right += model.classes[int(z.argmax())] == c
                total += 1
    assert right / total > 0.95


def test_license_scan_equals_python_version(spark, texts):
    model = licenses.train()
    at = {g: i for i, g in enumerate(model.vocabulary)}

    def passage(p):
        if not any(t in p.lower() for t in licenses.TRIGGERS):
            return None
        known = [at[g] for g in licenses.grams(p) if g in at]
        z = (np.round(model.bias.astype(float), 5) + np.round(model.weights[known].astype(float), 5).sum(0) / max(1, len(known)) ** 0.5)
        e = np.exp((z - z.max()) / model.temperature)
        e /= e.sum()
        c = model.classes[int(e.argmax())]
        w = re.findall(licenses.WORD, p.lower())
        pairs = {a + " " + b for a, b in zip(w, w[1:])}
        near = 0.0
        for t in TEMPLATES[c]:
            v = re.findall(licenses.WORD, t.lower())
            other = {a + " " + b for a, b in zip(v, v[1:])}
            near = max(near, len(pairs & other) / max(1, min(len(pairs), len(other))))
        if c == "none" or e.max() >= licenses.CONFIDENT and near >= licenses.SIMILAR:
            return c
        return "unknown" if e[model.classes.index("none")] < licenses.DOUBT else "none"

    extra = {-1: "Licensed under the Zeta Public License, version 7.\n\nHe lost his driving licence.", -2: "Copyright 2020 X. All rights reserved.\n\nReleased under the MIT License."}
    rows = spark.createDataFrame(list({**texts, **extra}.items()), "doc_id long, text string")
    got = {r.id: r.families for r in licenses.scan(rows).collect()}
    for i, t in {**texts, **extra}.items():
        windows = []
        for p in re.split(licenses.BLANK_LINE, t):
            w = re.findall(licenses.WORD, p.lower())
            if any(x in p.lower() for x in licenses.TRIGGERS):
                windows += [" ".join(w[k:k + licenses.WINDOW_WORDS]) for k in range(0, max(1, len(w) - licenses.WINDOW_WORDS + licenses.WINDOW_STEP), licenses.WINDOW_STEP)]
        found = {f for p in windows if (f := passage(p)) not in (None, "none")}
        assert got[i] == ",".join(sorted(found)), (i, got[i], found)
    assert got[-1] == "unknown" and "mit" in got[-2] and "proprietary" in got[-2]


def test_wrapped_notices_give_their_family(spark):
    notices = {
        "lgpl": "This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.",
        "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "agpl-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.",
        "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "cc-by-nc": "This work is licensed under the Creative Commons\nAttribution-NonCommercial 4.0 International\nLicense. To view a copy of this license, visit\nhttp://creativecommons.org/licenses/by-nc/4.0/.",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction",
        "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
        "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at"}
    prose = "\n".join("the river of that place rose again in the night and by morning it had come to the steps" for _ in range(9))
    rows = [(k, f"{prose}\n\n{t}\n\n{prose}") for k, t in notices.items()] + [(k + " inside", f"{prose}\n{t}\n{prose}") for k, t in notices.items()]
    got = {r.id: r.family for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {k: k.removesuffix(" inside") for k, _ in rows}


def test_families_that_were_not_learned_are_unknown():
    wrong = total = 0
    for away in ("mpl-2.0", "cc0", "isc", "apache-2.0", "cc-by-nc"):
        model = licenses.train(without=away)
        at = {g: i for i, g in enumerate(model.vocabulary)}
        for p in TEMPLATES[away]:
            known = [at[g] for g in licenses.grams(p) if g in at]
            z = model.bias + model.weights[known].sum(0) / max(1, len(known)) ** 0.5
            e = np.exp((z - z.max()) / model.temperature)
            c = model.classes[int(e.argmax())]
            w = re.findall(licenses.WORD, p.lower())
            pairs = set(zip(w, w[1:]))
            near = max(len(pairs & set(zip(v, v[1:]))) / max(1, min(len(pairs), len(v) - 1))
                       for v in (re.findall(licenses.WORD, t.lower()) for t in TEMPLATES[c]))
            total += 1
            wrong += c not in ("none", "unknown") and e.max() / e.sum() >= licenses.CONFIDENT and near >= licenses.SIMILAR
    assert wrong <= 0.25 * total, (wrong, total)


# --- components

def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5300)]
    f = Forest()
    for a, b in edges:
        f.link(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5), "t").collect()}
    assert got == {x: f.find(x) for x in f.up if any(f.find(y) == f.find(x) and y != x for y in f.up)}


# --- embeddings

def _brute_embeddings(rows):
    by = defaultdict(list)
    for i, v, y in rows:
        by[y].append((i, np.array(v, np.float64)))
    links, comp = {}, {}
    for members in by.values():
        ids = [i for i, _ in members]
        x = np.stack([v / np.linalg.norm(v) for _, v in members])
        near = x @ x.T >= 0.98
        np.fill_diagonal(near, False)
        f = Forest()
        for a, b in zip(*np.nonzero(near)):
            f.link(ids[a], ids[b])
        for k, i in enumerate(ids):
            links[i], comp[i] = int(near[k].sum()), f.find(i)
    return links, comp


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(12, 24))
    rows = [(i, (centers[i % 12] + 0.10 * rng.normal(size=24)).astype(np.float32).tolist(), int(i % 3 == 0)) for i in range(700)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(90)]  # copies
    near = centers[3] / np.linalg.norm(centers[3])
    rows += [(2000 + i, (near + 0.01 * rng.normal(size=24)).astype(np.float32).tolist(), 2) for i in range(160)]  # a dense group
    links, comp = _brute_embeddings(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    for part in (1024, 40):  # one block, and components cut into blocks
        got = embed_dedup.near_duplicates(df, window=16, part=part).collect()
        assert {r.id: r.n_links for r in got} == links
        assert {r.id: r.component_id for r in got} == comp


@pytest.mark.parametrize("mean_cosine", [0.8, 0.9, 0.95])
def test_links_in_a_label_of_similar_vectors(spark, mean_cosine):
    rng = np.random.default_rng(int(100 * mean_cosine))
    axis = np.eye(64)[0]
    r = rng.standard_normal((4000, 64))
    r[:, 0] = 0
    x = mean_cosine ** 0.5 * axis + (1 - mean_cosine) ** 0.5 * r / np.linalg.norm(r, axis=1)[:, None]
    t = rng.standard_normal((200, 64))
    t -= x[:200] * (t * x[:200]).sum(1)[:, None]
    t /= np.linalg.norm(t, axis=1)[:, None]
    x = np.concatenate([x, 0.9805 * x[:200] + (1 - 0.9805 ** 2) ** 0.5 * t, np.tile(x[5], (150, 1)) + 0.002 * rng.standard_normal((150, 64))]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    forest = Forest()
    for a, b in zip(*np.nonzero(near)):
        forest.link(int(a), int(b))
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(8)
    got = {r.id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(rows).collect()}
    assert got == {i: (int(near[i].sum()), forest.find(i)) for i in range(len(x))}


def test_embedding_query_recall(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    links, comp = _brute_embeddings(rows)
    got = QUERIES["op2_embedding_dedup"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (links[i], comp[i]) for i in links}


# --- language

def test_forward_backward_in_chunks_equals_one_pass():
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    sizes = np.array([1, 31, 32, 33, 200, 2])
    e = rng.normal(size=(int(sizes.sum()), 3))
    got, at = langid.marginal_sums(e, sizes, model), 0
    for row, n in zip(got, sizes):
        x, step = np.exp(e[at:at + n]), np.exp(model.transition)
        a, b = np.zeros_like(x), np.ones_like(x)
        a[0] = np.exp(model.start) * x[0]
        for t in range(1, n):
            a[t] = a[t - 1] / a[t - 1].sum() @ step * x[t]
        for t in range(n - 2, -1, -1):
            b[t] = step @ (b[t + 1] * x[t + 1])
            b[t] /= b[t].sum()
        m = a * b
        assert np.allclose(row, (m / m.sum(1, keepdims=True)).sum(0))
        at += n


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in documents(spark, sf).select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language_id"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_words_are_labelled(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = langid.fit(docs)
    by = {r.lang: r.text.split() for r in docs.filter("n_chars > 900").collect()}
    words = by["en"][:40] + by["de"][:40]
    lab = langid.Labeller(model)
    ids = lab.ids(" ".join(words))
    m = langid.marginal_sums(lab.scores[ids].astype(float), np.array([len(ids)]), model, words=True)
    y = [model.labels[j] for j in m.argmax(1)]
    assert y[:30].count("en") >= 28 and y[-30:].count("de") >= 28


# --- order minhash

def test_order_minhash_against_definition(spark, texts):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in QUERIES["op4_order_minhash"](spark, SF).collect()}
    assert len(rows) == len(ids)
    for n, i in enumerate(ids):
        t, following = texts[i], texts[ids[(n + 1) % len(ids)]]
        half = len(t) // 2
        mixed = t[:len(t) - half] + following[:half]
        own, other, ahead = (order_minhash.signature(order_minhash._points(x)) for x in (t, mixed, following))
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(mixed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.tobytes().hex(), other.tobytes().hex())
        assert r.near_edited == pytest.approx((own == other).mean()) and r.near_next == pytest.approx((own == ahead).mean())


def test_order_minhash_numbers_and_order():
    s = lambda t, **k: order_minhash.signature(order_minhash._points(t), **k)
    like = order_minhash.likeness
    a, b = "abcdefgh" * 40 + "xyz", "the quick brown fox jumps over the lazy dog " * 8
    assert like(s(a), s(a)) == 1 and not s("").any()
    h = order_minhash.numbered_kmers(order_minhash._points("aaaaaaaaaaaaaaaaaaaa"))
    assert len(set(h.tolist())) == len(h)  # occurrences differ
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij klmnop") for _ in range(3000))
    swapped = long[1500:] + long[:1500]  # the same k-mers in another order
    few = list(long)
    for i in rng.sample(range(len(few)), 12):
        few[i] = "#"
    assert like(s(long), s("".join(few))) > like(s(long), s(swapped)) > like(s(long), s(b))


# --- sharding

def test_shards_hold_every_record_once(spark, texts):
    out = sharding.shard(documents(spark, SF), shards=7, bucket_bytes=20_000).select("record.doc_id", "record.text", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(texts.items())
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = [r.doc_id for r in sorted(out, key=lambda r: (r.slot, r.shard))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.3


def test_write_shards(spark, tmp_path):
    sharding.write_shards(documents(spark, SF), str(tmp_path / "s"), shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == documents(spark, SF).count() and back.select("shard").distinct().count() == 3


# --- packing and BPE

ODD = ["", "   ", "a  b", "  a", "a \n b\n\n", "it's we'll I'D don't", "<|endoftext|>x <|endoftext|> ", "tab\tsep\r\nx", "漢字かな🙂🙂 🙂​",
       "x y", "123 4567.89,,,!! ??", "a" * 150, "\x1c \x1d", "x\n", " \n", "é café", "ΑΣΣΑΣ İI", "<|startoftext|>",
       "a.b,c, d.; e!? (x), \"quoted.\" word., ..., word...", "\n\nabc"]


def _odd_texts():
    rng = random.Random(5)
    return ODD + ["".join(rng.choice(list("ab thein 'sd.,!12\n\té漢  Ġ🙂\x1c")) for _ in range(rng.randint(0, 60))) for _ in range(1500)]


def test_bpe_equals_library(texts):
    path = vocabulary("byte_bpe_50k.json")
    with open(path, "rb") as f:
        own = bpe.Bpe(f.read())
    library = Tokenizer.from_file(path)
    for t in _odd_texts() + list(texts.values()):
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids, t
        assert own.decode(np.array(ids, own.type)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, texts):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in QUERIES["op7_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_word_tokenizer_equals_library(texts):
    path = vocabulary("word_bpe_49k.json")
    with open(path, "rb") as f:
        own = packing.WordTokenizer(f.read())
    library = Tokenizer.from_file(path)
    odd = _odd_texts() + list(texts.values())
    for t, got in zip(odd, own.encode(odd)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def _check_pieces(pieces, texts, length=4096):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in texts.items()}
    by = defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        by[p.sequence_id].append((p.offset, p.length))
    assert Counter((p.doc_id, k) for p in pieces for k in range(p.start, p.start + p.length)) == Counter((i, k) for i, x in ids.items() for k in range(len(x)))
    assert sorted(by) == list(range(len(by)))
    for s, parts in by.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or s == len(by) - 1 and at <= length


def test_word_ids_do_not_depend_on_earlier_rows():
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    with open(path, "rb") as f:
        tokenizer = packing.WordTokenizer(f.read())
    rng = random.Random(12)
    pieces = ["İ", "ǆ", "ß", "ẞ", "word", "Σ", "σς", "ﬁ", "é", "e\u0301", "na\u00efve", "ª", "K", "Å", "x", "І", "ı", "ﾊ", "ⅷ", "ñ", "µ", "ſ", "don't", "it's"]
    texts = ["İ", "İ, x"] + [rng.choice(["", " "]).join(rng.choice(pieces) + rng.choice(["", ",", ".", "!", " ", ":", "?;", "$$$", "'", "''s", ".%%", "'ll", "<|endoftext|>", "=\u0338", "\u0301", "…", "~`"]) for _ in range(rng.randint(1, 6))) for _ in range(6000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(tokenizer.encode([t])[0], "<u4").tolist() == want, t


def test_packing_query(spark, texts):
    _check_pieces(QUERIES["op6_packing"](spark, SF).collect(), texts)


# --- simhash

def _words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def _simhash(t):
    w = _words(t)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ([" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else []))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _simhash_groups(texts):
    fp = {i: _simhash(t) for i, t in texts.items()}
    f = Forest()
    ids = sorted(fp)
    for a, i in enumerate(ids):
        f.find(i)
        for j in ids[a + 1:]:
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                f.link(i, j)
    return fp, {i: f.find(i) for i in ids}


def test_simhash_query_equals_brute_force(spark, texts):
    fp, group = _simhash_groups(texts)
    got = QUERIES["op8_simhash"](spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {i: (fp[i], group[i]) for i in texts}


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a in range(64):
        for b in range(a, 64):
            x = 1 << a | 1 << b
            assert any(not m & x for m in masks)


@pytest.mark.parametrize("limit", [2, 5, 4096])
def test_simhash_links_in_dense_buckets(spark, limit):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(250)} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(simhash.signed(x) for x in fps)
    got = Forest()
    for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), bucket_limit=limit).collect():
        got.link(r.u, r.v)
    want = Forest()
    for a, x in enumerate(fps):
        for y in fps[a + 1:]:
            if ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 2:
                want.link(x, y)
    assert {x: got.find(x) for x in fps} == {x: want.find(x) for x in fps}


# --- page text

def test_page_query_gives_the_article(spark):
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    import html
    for r in QUERIES["op9_page_text"](spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", article))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)


def test_page_furniture_goes():
    page = ('<html><head><title>x</title></head><body class="no-sidebar"><header class="site-header"><a href=/>Home</a></header>'
            '<div class="cookie-notice">We use cookies</div><main><article class="post"><header><h2>Sub&#8217;t</h2></header><p>One <b>two</b>three<br>four.'
            '<p title="a>b">Five&nbsp;six<div class="ad-slot">Buy!</div><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>'
            '<script>if (a<b) "</p>"</script><!-- <p>old</p> --></article><section id="comments"><h3>2 Comments</h3><article class="comment"><p>Nice!</p></article>'
            '</section></main><aside>Related</aside><form><input>Search</form><footer>c</footer></body></html>')
    assert page_text.main_text(page, {}) == "Sub’t One twothree four. Five six a b 1 2 3"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "post-with-comments", "page-with-menu main", "notice-body", "legal-article",
                                  "search-results-page", "ad-free", "social-science"])
def test_a_word_of_a_wrappers_name_deletes_no_article(name):
    body = "<p>" + "real words of it " * 30 + "</p>"
    for inner in (body, "<h1>Title</h1>" + body):
        page = f'<html><body><div class="{name}">{inner}</div><div class="comments"><p>nice one</p></div></body></html>'
        text = page_text.main_text(page, {})
        assert text.count("real") == 30 and "nice" not in text


def test_forms_headers_and_stray_quotes_keep_the_text(spark):
    assert page_text.main_text("<body><form id=aspnetForm><h1>T</h1><p>one two three</p></form></body>", {}) == "T one two three"
    assert page_text.main_text("<body><main><header><h1>Title</h1><p>lead</p></header><p>text here</p></main></body>", {}) == "Title lead text here"
    assert page_text.main_text("<body><p data-x=it's>Hello there</p><p>we don't stop</p></body>", {}) == "Hello there we don't stop"
    long = "<div class='comments'><p>" + "long comment " * 100 + "</p></div><form><input><p>search words</p></form>"
    assert page_text.main_text("<body><header><h1>Site</h1></header><div><p>" + "a b c d " * 20 + f"</p></div>{long}</body>", {}) == " ".join(["a b c d"] * 20)
    rows = [(i, f"http://h/{i}", f"<html><body><div class=menu>Home News</div><main><h1>Notice {i}</h1><h2>Summary</h2><p>Text number {i} of all.</p>"
             f"<h2>What to do</h2><p>Boil the water.</p></main><div>Imprint of the site</div></body></html>") for i in range(12)]
    got = {r.id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Notice {i} Summary Text number {i} of all. What to do Boil the water." for i in range(12)}


def test_broken_pages_cost_time_in_proportion():
    import time
    for part in ('<a b="', "<a ", "<div class=x><p>", "<!--", "<form>"):
        t = time.perf_counter()
        page_text.main_text(part * 30_000, {})
        assert time.perf_counter() - t < 8, part


def test_site_template_is_deleted_where_it_recurs(spark):
    body = "<div><p>Stay on our list for more of this kind</p></div>"
    rows = [(i, f"http://h{i % 2}.example/{i}", f"<body>{body if i % 2 else ''}<div><p>Text number {i} with words of its own.</p></div></body>") for i in range(40)]
    rows.append((100, "http://h0.example/z", f"<body>{body}<div><p>More.</p></div></body>"))
    got = {r.id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Text number {i} with words of its own." for i in range(40))
    assert got[100] == "Stay on our list for more of this kind More."  # on one page of that host only


def test_template_of_any_length_and_share_goes_copies_stay(spark):
    legal = "<div>" + " ".join(f"term{i}" for i in range(300)) + "</div>"
    section = "<div>More of the section</div>"
    copied = "<p>An article that stands on several pages.</p><p>All of it is text.</p>"
    rows = [(i, f"http://big.example/{i}", f"<body>{legal}{section if i % 12 == 0 else ''}<div><p>Text {i} alone.</p></div></body>") for i in range(1200)]
    rows += [(2000 + i, f"http://a.example/{i}", f"<head><title>{i}</title></head><body><article>{copied}</article><div>Link {i}</div></body>") for i in range(6)]
    rows += [(3000 + i, f"http://d.example/{i}", f"<body><div>Link {i // 3}</div><div>{copied}</div></body>") for i in range(6)]
    got = {r.id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Text {i} alone." for i in range(1200))
    article = "An article that stands on several pages. All of it is text."
    assert all(article in got[i] for k in (2000, 3000) for i in range(k, k + 6))


def test_text_after_deep_elements_stays():
    deep = "<div>" * 3000 + "Deep." + "</div>" * 3000
    page = f"<body><div>Out.</div><div><article><p>Before.</p>{deep}<p>After.</p></article></div></body>"
    assert page_text.main_text(page, {}) == "Before. Deep. After."


# --- line dedup

def _brute_lines(texts):
    lines = {i: line_dedup.line_hashes(t or "") for i, t in texts.items()}
    first, seen = {}, []
    for i in sorted(texts):
        at, h, w = lines[i]
        for f, p in line_dedup.winnow(h, w):
            seen.append((f, i, p))
            first[f] = min(first.get(f, (i, p)), (i, p))
    gone = defaultdict(set)
    for f, i, p in seen:
        j, q = first[f]
        if (i, p) == (j, q):
            continue
        x, y, at = lines[i][1].tolist(), lines[j][1].tolist(), lines[i][0]
        k = 0
        while p + k < len(x) and q + k < len(y) and x[p + k] == y[q + k]:
            gone[i].add(at[p + k])
            k += 1
        k = 1
        while p >= k and q >= k and x[p - k] == y[q - k]:
            gone[i].add(at[p - k])
            k += 1
    return {i: sorted(gone[i]) for i in texts}


def test_line_query_equals_brute_force(spark, texts):
    want = _brute_lines(texts)
    got = QUERIES["op10_line_dedup"](spark, SF).collect()
    assert {r.doc_id: list(r.removed_lines) for r in got} == want


def test_repeated_passages_are_caught_and_others_left(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = lambda n: " ".join(word() for _ in range(n))
    passage = [line(n) for n in (9, 14, 3, 20, 11, 8)]
    one = line(55)
    short = [line(20), line(15)]
    docs = {}
    for i in range(60):
        body = [line(rng.randint(2, 25)) for _ in range(rng.randint(1, 12))]
        at = rng.randint(0, len(body))
        add = passage if i % 4 == 0 else [one] if i % 4 == 1 else short if i % 4 == 2 else []
        docs[i] = (body[:at] + add + body[at:], at, add)
    rows = [(i, "\n".join(b)) for i, (b, _, _) in docs.items()]
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, (_, at, add) in docs.items():
        first = i < 4 or i % 4 >= 2
        assert got[i] == ([] if first else list(range(at, at + len(add)))), i


def _runs_brute(texts, over=line_dedup.OVER_WORDS):
    """Lines in a run of over ``over`` words that stands earlier too, by trying all runs."""
    lines = {i: [(k, tuple(x.split())) for k, x in enumerate((t or "").split("\n")) if x.split()] for i, t in texts.items()}
    seen, gone = set(), {}
    for i in sorted(texts):
        own = lines[i]
        gone[i] = set()
        for b in range(len(own)):
            for a in range(b, -1, -1):
                run = tuple(w for _, w in own[a:b + 1])
                if sum(map(len, run)) > over and run in seen:
                    gone[i].update(k for k, _ in own[a:b + 1])
            # runs that end here may be found by later lines of the same text
            for a in range(b + 1):
                run = tuple(w for _, w in own[a:b + 1])
                if sum(map(len, run)) > over:
                    seen.add(run)
    return {i: sorted(g) for i, g in gone.items()}


def test_lines_equal_a_brute_force_over_all_runs(spark):
    rng = random.Random(21)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    pool = [line(n) for n in (20, 20, 20, 4, 5, 11, 30, 3, 9, 17, 52, 26)]
    texts = {1: "\n".join(pool[:3]), 2: "\n".join([line(1), *pool[:5]]), 3: "\n".join([line(1), *pool[:5]])}
    for i in range(4, 160):
        body = []
        while len(body) < rng.randint(3, 9):
            a = rng.randrange(len(pool))
            body += pool[a:a + rng.randint(1, 5)] if rng.random() < 0.8 else [line(rng.randint(1, 25))]
        texts[i] = "\n".join(body)
    want = _runs_brute(texts)
    assert want[3] == [1, 2, 3, 4, 5] and sum(map(len, want.values())) > 300
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup.digest(rows).collect()}
    assert got == want


def test_winnow_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(200):
        words = rng.integers(1, 30, 12)
        run, w = rng.integers(0, 1 << 62, 12).astype(np.uint64), words
        prints = []
        for _ in range(2):
            a, b = rng.integers(0, 1 << 62, 9).astype(np.uint64), rng.integers(0, 1 << 62, 9).astype(np.uint64)
            wa, wb = rng.integers(1, 30, 9), rng.integers(1, 30, 9)
            prints.append({f for f, _ in line_dedup.winnow(np.concatenate([a, run, b]), np.concatenate([wa, w, wb]))})
        if words.sum() >= line_dedup.MIN_WORDS + line_dedup.WINDOW_WORDS + 30:
            assert prints[0] & prints[1]


def _passages(texts, over=50):
    """Lines in runs of over ``over`` words that stand earlier too: all pairs of places, no fingerprints."""
    docs = [(i, [(k, " ".join(x.split())) for k, x in enumerate(t.split("\n")) if x.split()]) for i, t in sorted(texts.items())]
    gone = {i: set() for i in texts}
    for n, (i, later) in enumerate(docs):
        for _, earlier in docs[:n]:
            for p in range(len(later)):
                for q in range(len(earlier)):
                    k = 0
                    while p + k < len(later) and q + k < len(earlier) and later[p + k][1] == earlier[q + k][1]:
                        k += 1
                    if sum(len(x.split()) for _, x in later[p:p + k]) > over:
                        gone[i].update(a for a, _ in later[p:p + k])
    return {i: sorted(x) for i, x in gone.items()}


def test_passages_of_51_to_61_words_in_short_lines(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    texts, planted = {}, 0
    for shape in ([11] * 5, [9] * 6, [8] * 7, [3] * 18, [3] * 17, [1] * 51, [51], [30, 25], [10] * 5, [3] * 16):
        for _ in range(12):
            passage = [line(n) for n in shape]
            planted += sum(shape) > 50
            for _ in range(2):
                before, after = ([line(rng.randint(1, 12)) for _ in range(8)] for _ in range(2))
                texts[len(texts)] = "\n".join(before + passage + after)
    # a part of the later passage stands in a first document, too short by itself
    for _ in range(12):
        passage = [line(3) for _ in range(18)]
        for part in (passage[:15], passage, passage):
            texts[len(texts)] = "\n".join([line(5) for _ in range(6)] + part + [line(5) for _ in range(6)])
    rows = list(texts.items())
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = _passages(texts)
    assert sum(map(bool, want.values())) == planted + 12
    assert got == want


# --- pipeline

def test_pipeline_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    gone = _brute_lines(texts)
    kept = {}
    for i, t in texts.items():
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone[i]))
        if left.split() or not gone[i]:
            kept[i] = left
    _, group = _simhash_groups(kept)
    kept = {i: t for i, t in kept.items() if group[i] == i}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(kept)  # every text here has a language
    _check_pieces(pieces, kept)
