"""LM scoring (12): gradients and recurrences by hand, counts and base scores by plain recomputation."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, empty, key, texts_of
from pyspark.sql import functions as F

from jobloom.llm import recurrent, scoring

SMALL = recurrent.Shape(hidden=4, classes=4, members=3)


def some_net(seed=0, dtype=np.float32, scale=0.7):
    net = recurrent.new_net(SMALL, np.arange(1, SMALL.symbols + 1), seed)
    rng = np.random.default_rng(seed)
    return {k: (v + rng.normal(0, scale, v.shape)).astype(dtype) for k, v in net.items()}


def plain_log_probability(net, text):
    """The definition, a symbol at a time: gates, class, member."""
    h, before, total = np.zeros(SMALL.hidden), SMALL.symbols, 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for y in text.tolist():
        gz, gr, gc = np.split(net["inputs"][before].astype(float), 3)
        uz, ur, uc = np.split(h @ net["state"].astype(float), 3)
        z, r = sigmoid(gz + uz), sigmoid(gr + ur)
        c = np.tanh(gc + r * uc)
        h = (1 - z) * c + z * h
        cls = 0 if y == recurrent.RARE else (y - 1) // SMALL.members + 1
        logits = h @ net["class_w"] + net["class_b"]
        total += logits[cls] - np.log(np.exp(logits).sum())
        if cls:
            logits = h @ net["word_w"][cls - 1] + net["word_b"][cls - 1]
            total += logits[(y - 1) % SMALL.members] - np.log(np.exp(logits).sum())
        before = y
    return total


def some_texts(seed, n, most):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, SMALL.symbols, rng.integers(1, most)).astype(np.uint16) for _ in range(n)]


@pytest.mark.parametrize(("width", "steps", "cells"), [(1, 1, 1 << 20), (3, 4, 1 << 20), (512, 32, 1 << 20), (8, 5, 60)])
def test_state_is_carried_through_whole_texts(width, steps, cells):
    net, texts = some_net(), some_texts(1, 23, 40)
    want = [plain_log_probability(net, t) for t in texts]
    assert np.allclose(recurrent.log_probabilities(net, texts, width=width, steps=steps, cells=cells), want, atol=1e-3)


def test_probabilities_of_all_symbols_sum_to_one():
    net = some_net(3)
    first = np.array([5, 0, 7], np.uint16)
    both = [np.append(first, s).astype(np.uint16) for s in range(SMALL.symbols)]
    p = np.exp(recurrent.log_probabilities(net, both) - recurrent.log_probabilities(net, [first])[0])
    assert abs(p.sum() - 1) < 1e-4


def test_gradients_equal_differences():
    net = some_net(5, np.float64, 0.4)
    dealt = recurrent.lanes(some_texts(2, 5, 9), 3)
    [(_, n, before, target, begin, live)] = recurrent.windows(dealt, SMALL.symbols, 100)
    h = np.random.default_rng(1).normal(0, 0.5, (n, SMALL.hidden))

    def loss():
        logp, _ = recurrent.window(net, before, target, begin, live, h)
        return -logp[live].sum()

    grads = {k: np.zeros_like(v, np.float64) for k, v in net.items()}
    recurrent.window(net, before, target, begin, live, h, grads)
    rng = random.Random(0)
    for k, v in net.items():
        for _ in range(12):
            i = tuple(rng.randrange(s) for s in v.shape)
            kept, step = v[i], 3e-3
            v[i] = kept + step
            up = loss()
            v[i] = kept - step
            down = loss()
            v[i] = kept
            assert abs((up - down) / (2 * step) - grads[k][i]) < 2e-2 * (1 + abs(grads[k][i])), (k, i)


def plain(docs, teaches):
    tokens = lambda t: (t or "").encode().lower().split()
    counts, ends = Counter(), 0
    for i, t in docs:
        if teaches(i):
            counts.update(tokens(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    base = lambda c: math.log10((c + 1) / (n + v + 1))
    out = []
    for i, t in docs:
        own = [counts[w] for w in tokens(t)] + [ends]
        out.append((i, len(own), sum(c > 0 for c in own), n, round(sum(map(base, own)), 6)))
    return sorted(out, key=key)


def scored(docs, **more):
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    df = scoring.score_documents(docs, remainder == 2, remainder != 2, **more)
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = df.collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows if r.train_tokens)
    assert all(r.held_out == held(r.doc_id) for r in rows)
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=key), rows


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def teaches(i):
    return i is not None and not held(i)


@pytest.mark.parametrize("head", [0, 40, 65_536])
def test_awkward_rows(spark, head):
    docs = awkward(spark, *((100 + i, f"Mixed CASE wörds {i} \t the the {'x' * 300} {'y' * 300}") for i in range(30)))
    assert scored(docs, head=head, shape=SMALL)[0] == plain(texts_of(docs), teaches)


def test_scores_do_not_depend_on_how_words_are_split_between_head_and_join(spark):
    docs = awkward(spark).repartition(1).cache()
    a, b = (sorted((r.doc_id or -1, r.n_tokens, round(r.score, 3)) for r in scored(docs, head=head, shape=recurrent.Shape(4, 2, 1))[1]) for head in (30, 65_536))
    assert a == b


def test_held_out_texts_of_a_grammar_score_better_than_by_frequency(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    follow = {w: rng.sample(words, 3) for w in words}

    def text():
        now, said = rng.choice(words), []
        for _ in range(rng.randint(5, 120)):
            said.append(now)
            now = rng.choice(follow[now])
        return " ".join(said)

    docs = spark.createDataFrame([(i, text()) for i in range(1500)], "doc_id long, text string").repartition(4)
    _, rows = scored(docs, shape=recurrent.Shape(16, 4, 16), part_tokens=8192)
    rows = [r for r in rows if r.held_out]
    assert len(rows) > 100
    assert sum(r.score for r in rows) > 0.75 * sum(r.base_score for r in rows)


def test_sums_of_many_parts_are_added_in_levels(spark):
    docs = spark.createDataFrame([(i, f"a b c d{i % 9} " * 20) for i in range(300)], "doc_id long, text string").repartition(3)
    assert scored(docs, shape=SMALL, part_tokens=60)[0] == plain(texts_of(docs), teaches)


def test_empty_tables_and_nothing_to_learn_from(spark):
    assert scored(empty(spark))[0] == []
    only_held = [i for i in range(100) if held(i)]
    docs = spark.createDataFrame([(i, "a b") for i in only_held], "doc_id long, text string")
    assert {r[1:] for r in scored(docs)[0]} == {(3, 0, 0, 0.0)}
