"""Spelling variants (11) against plain recomputation."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, empty, texts_of

from jobloom.llm import spelling


def plain_counts(docs, shortest=7):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_error(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times=10):
    near = {w: {v for v in counts if v != w and abs(len(v) - len(w)) < 2 and one_error(w, v)} for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def result(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = {r.word: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_words_and_forms_equal_plain_recomputation(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abnáÿ×") for _ in range(rng.randint(7, 10))) for _ in range(40)]
    docs = []
    for i in range(120):
        said = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.2)), 39)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abnZ") + w[at:], w[:at] + "x" + w[at + 1 :]])
            said.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i if i % 9 else None, " ".join(said)))
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain_variants(plain_counts(docs))
    assert sum(v[0] is not None for v in want.values()) > 10 and max(v[3] for v in want.values()) > 5
    assert result(spelling.group_variants(given)) == want
    # Groups are halved down to single letters and still every pair is met once.
    assert result(spelling.group_variants(given, most_words=1)) == want


def test_chains_end_at_their_root(spark):
    chain = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000)]
    text = " ".join(" ".join([w] * n) for w, n in chain)
    ids = (i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w, _ in chain))
    found = result(spelling.group_variants(spark.createDataFrame([(next(ids), text)], "doc_id long, text string")))
    assert [found[w][1] for w, _ in chain] == ["aaaabbb"] * 4
    assert found["aaaaaaa"] == ("aaaaaab", "aaaabbb", 2, 1, 20)


def test_block_of_all_short_words():
    words = ["".join(p) for n in range(1, 5) for p in itertools.product("ab", repeat=n)] + ["abababababab", "ababababab", "abababababb"]
    for s in range(1, 13):
        group = np.zeros(len(words), np.int64)
        near = spelling.near_in_block(words, group, np.full(len(words), s), np.full(len(words), s))
        want = [[min(len(a), len(b)) == s and one_error(a, b) for b in words] for a in words]
        assert (near == np.array(want)).all()


@pytest.mark.parametrize("most_words", [2, 2048])
def test_long_words_and_awkward_rows(spark, most_words):
    long = "ab" * 3000
    docs = awkward(spark, (20, f"{long} {long} {long}x {long}x {long[1:]} {long[1:]}"), (21, "Straße STRASSE"), (22, "straße straße"))
    assert result(spelling.group_variants(docs, most_words=most_words)) == plain_variants(plain_counts(texts_of(docs)))


def test_empty_tables(spark):
    out = spelling.group_variants(empty(spark))
    assert result(out) == {}
    assert result(spelling.group_variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string"))) == {}
