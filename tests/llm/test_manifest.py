"""Merkle manifest (13) against plain recomputation."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from helpers import awkward, empty, words
from pyspark.sql import functions as F

from jobloom.llm import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(leaves):
    """Root, and per leaf the siblings (left, right) from the bottom up."""
    now, paths = [(d, [i]) for i, d in enumerate(leaves)], [[] for _ in leaves]
    while len(now) > 1:
        above = []
        for k in range(0, len(now), 2):
            run = now[k : k + 2]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append((run[0][0] if j else "", run[1][0] if not j and len(run) == 2 else ""))
            above.append((digest(*(d for d, _ in run)), sum((b for _, b in run), [])))
        now = above
    return now[0][0], paths


def plain(rows, claim):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in groups[g]])
    root, top = tree([trees[g][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for r, path in zip(groups[g], trees[g][1], strict=True):
            folded = leaf_of({**r, "n_chars": claim(r)})
            for left, right in path + top[place]:
                folded = digest(left, folded, right)
            proof = digest(*(a + b for a, b in path + top[place]))
            out.append((r["doc_id"], leaf_of(r), trees[g][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def claimed():
    return {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def claim(row):
    tampered = row["doc_id"] is not None and row["doc_id"] % 3 == 0 and row["n_chars"] is not None
    return row["n_chars"] + 1 if tampered else row["n_chars"]


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1, 1], [64, 65, 63, 1], [130, 3], [4100]])
def test_trees_of_all_shapes(spark, sizes, monkeypatch):
    monkeypatch.setattr(manifest, "SHARE", 50)
    rows, n = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n * 7 % 4999, f"text {n}", None if g == 1 else f"l{g}é", "s" if n % 5 else None, n if n % 4 else None))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = plain([r.asDict() for r in docs.collect()], claim)
    assert found(manifest.merkle_manifest(docs, tampered=claimed())) == want
    assert {w[6] for w in want} == ({True, False} if n > 3 else {w[6] for w in want})


def test_many_groups(spark):
    rows = [(i, words(i, 3), f"g{i % 150:03d}", "s", i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(manifest.merkle_manifest(docs, tampered=claimed())) == plain([r.asDict() for r in docs.collect()], claim)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert found(manifest.merkle_manifest(docs, tampered=claimed())) == plain([r.asDict() for r in docs.collect()], claim)


def test_one_id_for_most_rows(spark):
    docs = spark.createDataFrame([(None if i % 3 else i, "same", "x", None, 4) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    assert found(manifest.merkle_manifest(docs)) == plain([r.asDict() for r in docs.collect()], lambda r: r["n_chars"])


def test_empty_table(spark):
    assert found(manifest.merkle_manifest(empty(spark))) == []
