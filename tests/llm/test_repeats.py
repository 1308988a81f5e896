"""Exact repeats (1) and SimHash near-duplicates (8) against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import awkward, empty, key, texts_of, words

from jobloom.llm import simhash, suffix
from jobloom.llm.components import components


@pytest.mark.parametrize("seed", range(60))
def test_interval_expansion_finds_exactly_the_repeated_strings(seed):
    r = random.Random(seed)
    alphabet, length = r.choice([b"a", b"ab", b"abcdef"]), r.choice([3, 5, 9, 20, 40])
    pieces = [bytes(r.choice(alphabet) for _ in range(r.randint(1, 70))) for _ in range(r.randint(1, 8))]
    text = b"\xff".join([*pieces, pieces[0][:25] + b"z" + pieces[0], b""])
    starts, leaders = suffix.repeated_starts(np.frombuffer(text, np.uint8), length, at_once=64)
    places = defaultdict(list)
    for i in range(len(text) - length + 1):
        if b"\xff" not in text[i : i + length]:
            places[text[i : i + length]].append(i)
    for at in places.values():
        assert all(starts[i] == (len(at) > 1) for i in at)
        assert sum(leaders[i] for i in at) == (len(at) > 1)


def removed(docs, length):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    out = []
    for d, t in data:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~covered])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[False], covered]).astype(np.int8)) == 1))
        out.append((d, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=key)


@pytest.mark.parametrize("salted", [False, True])
def test_remove_repeats_equals_brute_force(spark, salted):
    common = words(50, 40)
    extra = [(100 + i, f"{words(60 + i, 20)} {common} {words(90 + i, 20)}") for i in range(12)]
    extra += [(200, "x" * 50 + common), (201, common * 3)]
    docs = awkward(spark, *extra)
    got = suffix.remove_repeats(docs, length=48, anchor=16, block_bytes=150 if salted else 3000)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    found = sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in got.select(*names).collect()), key=key)
    assert found == removed(texts_of(docs), 48)


def test_remove_repeats_of_nothing(spark):
    assert suffix.remove_repeats(empty(spark)).count() == 0


def plain_fingerprint(text):
    said = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(said[i : i + 4]) for i in range(len(said) - 3)] or ([b" ".join(said)] if said else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fingerprints):
    """(id, class) per row by comparing all pairs."""
    parent = list(range(len(fingerprints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(fingerprints):
        for j, (_, b) in enumerate(fingerprints[:i]):
            if (a ^ b).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fingerprints):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, f, least.get(root(i))) for i, (d, f) in enumerate(fingerprints)]


def test_near_duplicates_equal_all_pairs(spark):
    base = words(7, 400).split()
    near = [(300 + i, " ".join([*base[:i], "other", *base[i + 1 :]])) for i in range(0, 60, 4)]
    docs = awkward(spark, *near, (400, "Shout AND whisper"), (401, "shout and whisper"))
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, passes=3).collect()), key=key)
    assert got == sorted(classes([(d, plain_fingerprint(t)) for d, t in texts_of(docs)]), key=key)


def test_one_document_of_each_class_stays(spark):
    found = simhash.near_duplicates(awkward(spark), passes=2).collect()
    by_class = defaultdict(set)
    for r in found:
        if r.stays:
            by_class[r.component_id].add((r.doc_id, r.tie))
    # Two different texts carry the id 8, so two classes do.
    assert all(len(s) == 1 + (c == 8) for c, s in by_class.items())
    assert by_class.keys() == {r.component_id for r in found}


@pytest.mark.parametrize("buckets", [8, 100_000])
def test_all_values_go_to_one_bucket_each(buckets):
    fps = np.array([0, 1, 2**63, 12345], np.uint64)
    masks, placed, seen = simhash.ball_masks(2), {}, []
    for this in range(3):
        for out in simhash._ball(2, 3, this, buckets)(iter([pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64))], names=["fp"])])):
            for bucket, values, which in zip(*(c.to_pylist() for c in out.columns)):
                values, which = np.frombuffer(values, np.uint64), np.frombuffer(which, np.uint16)
                assert 0 <= bucket < buckets
                for v, w in zip(values.tolist(), which.tolist()):
                    assert placed.setdefault(v, (this, bucket)) == (this, bucket)
                    seen.append((v, v ^ int(masks[w])))
    want = [(f ^ int(m), f) for f in fps.tolist() for m in masks]
    assert sorted(seen) == sorted(want)
    assert buckets == 8 or max(b for _, b in placed.values()) >= 1 << 16


def test_no_documents(spark):
    assert simhash.near_duplicates(empty(spark), passes=1).count() == 0


def test_long_chains_and_hubs_are_one_component(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 50)]
    pairs = spark.createDataFrame([*chain, *hub, (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(pairs).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 50)}}
