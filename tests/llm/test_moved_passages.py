"""Order MinHash on short texts: moved passages lower the likeness as much as on long ones."""

from __future__ import annotations

import random
import zlib

from helpers import words
from jobloom.llm import orderhash


def alike(a, b):
    either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either)


def independent(text):
    """64 orders over the whole text, the two least numbered pairs of words of each in text order."""
    said, seen, pairs = text.split(), {}, []
    for gram in zip(said, said[1:]):
        seen[gram] = seen.get(gram, 0) + 1
        pairs.append(zlib.crc32(repr((gram, seen[gram])).encode()))
    out = []
    for order in range(64):
        rank = lambda i: random.Random(pairs[i] * 64 + order).random()  # noqa: B023, E731
        out.append(tuple(pairs[i] for i in sorted(sorted(range(len(pairs)), key=rank)[:2])))
    return out


def test_moved_passages_show_in_short_texts(spark):
    docs, sizes = [], (30, 60, 120)
    for size in sizes:
        for i in range(20):
            said = words(31 * size + i, size).split()
            blocks = [said[j : j + 6] for j in range(0, size, 6)]
            random.Random(i).shuffle(blocks)
            docs += [(size * 1000 + 2 * i, " ".join(said)), (size * 1000 + 2 * i + 1, " ".join(w for b in blocks for w in b))]
    found = orderhash.fingerprint_edits(spark.createDataFrame(docs, "doc_id long, text string"), parts=2).collect()
    cells, orders = {r.doc_id: r.signature for r in found}, {d: independent(t) for d, t in docs}
    mean = lambda s, n: sum(alike(s[n * 1000 + 2 * i], s[n * 1000 + 2 * i + 1]) for i in range(20)) / 20
    both = {n: (round(mean(cells, n), 3), round(mean(orders, n), 3)) for n in sizes}
    print(both)
    assert all(abs(a - b) < 0.08 for a, b in both.values()), both


def test_filled_cells_go_round_and_stay_short_only_without_more(spark):
    texts = ["one", "one two three", ""]
    df = orderhash.with_signature(spark.createDataFrame(list(enumerate(texts)), "n int, text string"), "text", "s", filled=True)
    one, two, none = [r.s for r in df.orderBy("n").collect()]
    assert len([x for x in one if x is not None]) == 1 and none == [None] * orderhash.CELLS
    # Two pairs of words: both cells hold both.
    assert len({x for x in two if x is not None}) == 1
