"""Language, licences and the masked network."""

import random
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fleetmeter.llm import language, licenses, masked_lm, queries
from fleetmeter.llm.support import SpanHasher, document_words
from odd import ROWS, empty, odd, words

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_language(spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r.lang_pred == docs[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held)


def test_language_of_odd_rows(spark):
    got = Counter((r.doc_id, r.lang_pred == "und", r.held_out) for r in language.identify(odd(spark)).collect())
    assert got == Counter(
        (i, not any(c.isalpha() for c in t or ""), i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, t, _ in ROWS)
    assert {r.lang_pred for r in language.identify(odd(spark)).collect()} <= {"und", "en", "fr", "de"}
    nothing = language.identify(odd(spark, [(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language.identify(empty(spark)).collect() == []


def test_bundles_add_up_and_bind_by_place():
    profiler = language.Profiler(256)
    parts = profiler.bundles(["abc", "abc def", "cba"])
    assert (profiler.bundles(["abc"]) == parts[:1]).all() and not (parts[0] == parts[2]).all()
    # By definition: gaps before and after each word, letters bound with rotations.
    vectors = {c: profiler.letters(np.array([ord(c) if c != " " else 0]))[0] for c in " abcdef"}
    expected = np.zeros(256)
    padded = " abc def"
    for i in range(len(padded) - 2):
        expected += np.roll(vectors[padded[i]], 2) * np.roll(vectors[padded[i + 1]], 1) * vectors[padded[i + 2]]
    expected += np.roll(vectors["e"], 2) * np.roll(vectors["f"], 1) * vectors[" "]
    assert (parts[1] == expected).all()


def test_licences():
    assert {ident for _, ids in licenses.RULES for ident in ids} == set(licenses.SENTENCES)
    assert len({len(i) for i in licenses.SENTENCES}) == 1


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
       "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
       "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
       'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
       "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT.")


def test_licences_of_texts(spark):
    texts = [
        (1, MIT, "MIT"), (2, "Intro without stop\nReleased under the MIT License. All rights reserved.", "MIT,proprietary"),
        (3, 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
            "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n", "Apache-2.0"),
        (4, "Licensed under CC BY-NC 4.0! Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,CC-BY-4.0"),
        (5, None, ""), (6, "", ""), (7, "Not released under the MIT License.", ""), (8, "x " * 100_000, ""),
        (9, "The software is provided as is without warranty of any kind.", ""),
    ]
    got = licenses.scan_licenses(odd(spark, [(i, t, None) for i, t, _ in texts])).collect()
    assert {r.doc_id: r.licenses for r in got} == {i: name for i, _, name in texts}
    assert licenses.scan_licenses(empty(spark)).collect() == []
    assert licenses.scan_licenses(odd(spark)).count() == len(ROWS)


def test_pseudo_likelihood_by_definition(spark, monkeypatch):
    """Scores equal a word-by-word evaluation of the trained network, whatever the batches."""
    monkeypatch.setattr(masked_lm, "BATCH", 16)
    docs = odd(spark)
    got = {r.doc_id: r for r in masked_lm.score(docs).collect()}
    rows = masked_lm.picked(docs).where("doc_id is not null")
    known, place = masked_lm.vocabulary(rows)
    net = masked_lm.train(rows, known, place)
    for i, t, _ in ROWS:
        if i is None or i in (8, 9):
            continue
        ((_, hashes),) = document_words(pa.record_batch({"text": pa.array([t or ""])}), SpanHasher(), True)
        entries = masked_lm._entries(hashes, known, place)
        total = 0.0
        for p in range(len(entries)):
            near = [entries[p + s] if 0 <= p + s < len(entries) else 0 for s in (-2, -1, 1, 2)]
            hidden = np.tanh(net["embed"][near].ravel() @ net["hidden"] + net["hidden_bias"])
            c, w = divmod(int(entries[p]), masked_lm.PER_CLASS)
            for logits, at in ((hidden @ net["class"] + net["class_bias"], c), (hidden @ net["word"][c] + net["word_bias"][c], w)):
                total += logits[at] - np.log(np.exp(logits).sum())
        assert got[i].n_words == len(words(t)) and abs(got[i].log_prob - total) < 1e-2 + 1e-4 * abs(total)
        assert (got[i].mean_log_prob is None) == (not words(t))
    assert masked_lm.score(empty(spark)).collect() == []


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(0)
    net = masked_lm.initial()
    sums = {k: np.zeros_like(v) for k, v in net.items()}
    target = rng.integers(1, 1024, 4000)
    context = np.stack([target, (target * 7) % 1024, target, target], 1)
    before = masked_lm._forward(net, context, target)[0].mean()
    for _ in range(30):
        masked_lm._step(net, sums, context, target)
    assert masked_lm._forward(net, context, target)[0].mean() > before + 1


def test_order_of_words_matters_to_the_network(spark):
    """Held against the same words shuffled, texts are more probable."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.limit(200).collect() if len(r.text.split()) > 50]
    rng = random.Random(1)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    top = int(docs.agg({"doc_id": "max"}).first()[0]) + 1
    both = spark.createDataFrame([(top + i, t) for i, t in enumerate(texts + mixed)], "doc_id long, text string")
    rows = masked_lm.picked(docs)
    known, place = masked_lm.vocabulary(rows)
    net = masked_lm.train(rows, known, place)

    def mean(text):
        ((_, hashes),) = document_words(pa.record_batch({"text": pa.array([text])}), SpanHasher(), True)
        e = masked_lm._entries(hashes, known, place)
        return masked_lm._forward(net, masked_lm._windows(e, np.array([0, len(e)])), e)[0].mean()

    wins = sum(mean(a) > mean(b) for a, b in zip(texts, mixed))
    assert both.count() == 2 * len(texts) and wins > 0.8 * len(texts)


def test_vocabulary_counts_all_documents(spark):
    known, place = masked_lm.vocabulary(masked_lm.picked(spark.read.parquet(f"{SF}/documents.parquet")))
    texts = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    counts = Counter(w.lower() for (t,) in texts for w in words(t))
    ((_, hashes),) = document_words(pa.record_batch({"text": pa.array([" ".join(w for w, _ in counts.most_common(50))])}), SpanHasher(), True)
    assert set(hashes[:50].tolist()) <= set(known.tolist()) and len(known) == 1024 - 256 - 1


def test_every_word_has_its_own_probability(spark):
    """Words outside the vocabulary take shares of their hash class that follow their counts and sum to one."""
    common = " ".join(f"c{i}" for i in range(767))
    texts = [(1, common), (2, common), (3, common), (4, common)] + [(10 + i, f"r{i} " * (1 + i % 3)) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in masked_lm.score(docs).collect()}
    known, _ = masked_lm.vocabulary(masked_lm.picked(docs))
    assert len(known) == 767 and all(got[i].word_log_prob == got[i].log_prob for i in range(1, 5))
    hashes = {i: document_words(pa.record_batch({"text": pa.array([f"r{i}"])}), SpanHasher(), True) for i in range(600)}
    of = {i: int(next(h)[1].view(np.int64)[0]) % 256 for i, h in hashes.items()}
    mass = Counter()
    for i, k in of.items():
        mass[k] += 2 + i % 3
    for i, k in of.items():
        share = got[10 + i].word_log_prob - got[10 + i].log_prob
        assert abs(share - (1 + i % 3) * np.log((2 + i % 3) / mass[k])) < 1e-3
    assert max(Counter(of.values()).values()) > 1 and len(got) == len(texts)


def test_vocabulary_grows_with_the_corpus(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 100000), i -> concat('w', (i * 7919 + id) % 20000))) AS text")
    known, place = masked_lm.vocabulary(masked_lm.picked(docs))
    side = masked_lm.side_of(len(known))
    assert len(known) == masked_lm.known_words(45) and side == 45 and sorted(place) == list(range(len(known)))
    assert all(masked_lm.side_of(masked_lm.known_words(s)) == s and masked_lm.side_of(masked_lm.known_words(s) + 1) == s + 1 for s in range(32, 600))
    assert {k: v.shape for k, v in masked_lm.initial(side=side).items()} == masked_lm.shapes(side)


def _trial(side, n, seed=0, scale=1.0):
    """A network, windows over some texts (the last ones short), and their targets."""
    rng = np.random.default_rng(seed)
    net = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) * np.float32(scale) for k, v in masked_lm.initial(side=side).items()}
    entries = np.minimum(rng.zipf(1.3, n) * 3, side**2 - 1)
    at = np.unique(np.concatenate((np.arange(0, n - 5, 50), [n - 4, n - 3, n - 1, n])))
    return net, masked_lm._windows(entries, at), entries


def _plain(net, context, target):
    """Log-probabilities and the gradient of their mean's negative, without blocks and in 64 bits."""
    net = {k: v.astype(float) for k, v in net.items()}
    n, side = len(target), net["word"].shape[2]
    c, w = np.divmod(target, side)
    inputs = net["embed"][context].reshape(n, -1)
    hidden = np.tanh(inputs @ net["hidden"] + net["hidden_bias"])
    logs, ds = 0, []
    for logits, at in ((hidden @ net["class"] + net["class_bias"], c), (np.einsum("nh,nhw->nw", hidden, net["word"][c]) + net["word_bias"][c], w)):
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
        logs = logs + logits[np.arange(n), at] - np.log(np.exp(logits).sum(1))
        p[np.arange(n), at] -= 1
        ds.append(p / n)
    g = {k: np.zeros_like(v) for k, v in net.items()}
    g["class"], g["class_bias"] = hidden.T @ ds[0], ds[0].sum(0)
    np.add.at(g["word"], c, np.einsum("nh,nw->nhw", hidden, ds[1]))
    np.add.at(g["word_bias"], c, ds[1])
    d = (ds[0] @ net["class"].T + np.einsum("nw,nhw->nh", ds[1], net["word"][c])) * (1 - hidden**2)
    g["hidden"], g["hidden_bias"] = inputs.T @ d, d.sum(0)
    np.add.at(g["embed"], context.ravel(), (d @ net["hidden"].T).reshape(-1, net["embed"].shape[1]))
    return logs, g


@pytest.mark.parametrize("together", [1, 2**13, 2**20])
def test_steps_equal_the_plain_gradient(monkeypatch, together):
    """Whatever classes are worked on at a time; what the batch does not hold stays as it is."""
    monkeypatch.setattr(masked_lm, "_TOGETHER", together)
    net, context, target = _trial(33, 700)
    sums = {k: np.full_like(v, 1e-6) for k, v in net.items()}
    before, (_, g) = {k: v.copy() for k, v in net.items()}, _plain(net, context, target)
    masked_lm._step(net, sums, context, target)
    for k in net:
        total = 1e-6 + g[k] ** 2
        assert np.allclose(sums[k], total, rtol=1e-3, atol=1e-10)
        assert np.allclose(net[k], before[k] - masked_lm.RATE * g[k] / np.sqrt(total + 1e-8), atol=2e-4), k
    absent = np.setdiff1d(np.arange(33), target // 33)
    assert len(absent) > 3 and (net["word"][absent] == before["word"][absent]).all() and (net["embed"][1:3] == before["embed"][1:3]).all()


@pytest.mark.parametrize("scale", [1.0, 60.0])
def test_probabilities_of_small_and_large_logits(monkeypatch, scale):
    """Logits beyond the bound are shifted first, others are not."""
    monkeypatch.setattr(masked_lm, "BATCH", 64)
    net, context, target = _trial(33, 700, 1, scale)
    logs, _ = _plain(net, context, target)
    assert (logs.min() < -200) == (scale > 1)
    assert np.allclose(masked_lm._forward(net, context, target)[0], logs, rtol=1e-3, atol=1e-3)


def test_scoring_holds_a_block_of_logits():
    net, context, target = _trial(101, 2**16)
    tracemalloc.start()
    masked_lm._forward(net, context, target)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * 101 * 2**16


def test_rare_words_meet_their_counts_once_a_chunk(spark, monkeypatch):
    """However often a task meets a word outside the vocabulary, it sends it once."""
    stored = {}
    spill = masked_lm.spill_to_table
    monkeypatch.setattr(masked_lm, "spill_to_table", lambda df, name: stored.setdefault(name, spill(df, name)))
    common = " ".join(f"c{i}" for i in range(767)) + " "
    texts = [(i, common * 3 + " ".join(f"r{i * 7 % 5 + j}" for j in range(20))) for i in range(8)] + [(8, None), (9, "")]
    masked_lm.score(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1))
    sent = stored["rated"].where("word is not null")
    assert sent.count() == sent.select("word").distinct().count() == 24 and sent.selectExpr("sum(size(docs))").first()[0] == 160


@pytest.mark.parametrize("n", [1, 3, 767, 30_000])
def test_search_by_leading_bits(n):
    rng = np.random.default_rng(n)
    edges = np.array([0, 1, 2**64 - 1], np.uint64)
    known = np.unique(np.concatenate((rng.integers(0, 2**64 - 1, n, np.uint64), edges[: n % 4], rng.integers(0, 99, n // 2, np.uint64))))
    words_ = np.concatenate((known, known + np.uint64(1), edges, rng.integers(0, 2**64 - 1, 5000, np.uint64)))
    assert (masked_lm._searched(known, words_) == np.searchsorted(known, words_)).all()


def test_windows_stay_in_their_text():
    rng = np.random.default_rng(0)
    for _ in range(300):
        at = np.concatenate(([0], np.cumsum(rng.integers(0, 4, rng.integers(1, 7)))))
        x = rng.integers(1, 99, at[-1])
        near = [[x[p + s] if a <= p + s < b else 0 for s in (-2, -1, 1, 2)] for a, b in zip(at, at[1:]) for p in range(a, b)]
        assert masked_lm._windows(x, at).tolist() == near
