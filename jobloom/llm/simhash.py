"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart have a value at most ``r`` bits from both.  Every distinct fingerprint
sends all values within ``r`` bits (2,081 for 64 bits and r = 2) to the place of that value; those that meet there are
at most ``2 r`` bits apart, all of them, so a star from the least one keeps every link's component.  At most 2,081
distinct fingerprints can meet at a value, so there are no hot values however many copies a text has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import setting, slices, written
from jobloom.llm.components import components

SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """Majority bits of the XXH64 of all ``width``-word shingles; 0 without a word."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(lengths + 1) - lengths - 1
    end = begin + lengths
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _SHINGLES_AT_ONCE):
        hi = min(n, lo + _SHINGLES_AT_ONCE)
        spans = zip(begin[lo:hi].tolist(), end[lo + width - 1 : hi + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: b.column(2)):
            found = np.array([fingerprint(t, width) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], names=["id", "tie", "fp"])

    return run


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(``id``, ``tie``, ``fp``): a hash of the text and one 64-bit fingerprint, as signed longs, per row.

    Null and blank texts have fingerprint 0.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text")
    )
    return given.mapInArrow(_fingerprints(width), "id long, tie long, fp long")


def ball_masks(radius: int) -> np.ndarray:
    """All 64-bit masks with at most ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)], np.uint64)


def _ball(radius: int, passes: int, this: int, buckets: int):
    """Fingerprints to the part ``this`` of their balls, packed per bucket of values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball_masks(radius)
        kind = np.uint16 if buckets <= 1 << 16 else np.uint32  # small ones sort faster
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(fps), 1024):
                values = (fps[lo : lo + 1024, None] ^ masks[None, :]).ravel()
                spread = (values * _MIX) >> np.uint64(34)
                mine = np.flatnonzero(spread % np.uint64(passes) == np.uint64(this))
                bucket = ((spread[mine] // np.uint64(passes)) % np.uint64(buckets)).astype(kind)
                order = np.argsort(bucket, kind="stable")
                bucket, mine = bucket[order], mine[order]
                values, which = values[mine], (mine % len(masks)).astype(np.uint16)
                edges = np.flatnonzero(np.diff(bucket)) + 1
                begin = np.concatenate([[0], edges]) if len(mine) else np.empty(0, np.int64)
                end = np.concatenate([edges, [len(mine)]])
                spans = [(int(i), int(j)) for i, j in zip(begin, end)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(bucket[i]) for i, _ in spans], pa.int32()),
                        pa.array([values[i:j].tobytes() for i, j in spans], pa.binary()),
                        pa.array([which[i:j].tobytes() for i, j in spans], pa.binary()),
                    ],
                    names=["bucket", "values", "which"],
                )

    return run


def least_in_component(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs and, for each, the least node it is connected with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _meet(radius: int):
    """Packed balls of a partition to its links, as one star per component of what met here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball_masks(radius)
        values, which = [], []
        for batch in batches:
            values += [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(0)]
            which += [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(1)]
        if not values:
            return
        value, mask = np.concatenate(values), np.concatenate(which)
        del values, which
        order = np.argsort(value)
        value = value[order]
        same = value[1:] == value[:-1]
        shared = np.zeros(len(value), bool)
        shared[1:] |= same
        shared[:-1] |= same
        at = np.flatnonzero(shared)
        if not len(at):
            return
        value, mask = value[at], mask[order[at]]
        del order
        node = value ^ masks[mask]
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        size = np.diff(np.concatenate([first, [len(value)]]))
        centre = np.repeat(np.minimum.reduceat(node, first), size)
        link = np.flatnonzero((centre != node) & (np.bitwise_count(centre ^ node) <= 2 * radius))
        nodes, least = least_in_component(centre[link], node[link])
        keep = nodes != least
        yield pa.RecordBatch.from_arrays(
            [pa.array(least[keep].view(np.int64)), pa.array(nodes[keep].view(np.int64))], names=["a", "b"]
        )

    return run


def links(distinct: DataFrame, n: int, *, radius: int = 2, passes: int = 8) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints of ``distinct`` (column ``fp``) at most ``2 * radius`` bits apart.

    The values are worked off in ``passes`` parts of equal size, each a job of its own, so that the shuffle files on
    disk at one time are a fixed share of all.  ``n`` (the number of rows) sets how many buckets a part has, so a task
    gets about a million values at any size.
    """
    spark = distinct.sparkSession
    per_pass = n * len(ball_masks(radius)) // passes
    parts = max(1, per_pass // 1_000_000, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    out = None
    for this in range(passes):
        packed = distinct.select("fp").mapInArrow(_ball(radius, passes, this, 4 * parts), "bucket int, values binary, which binary")
        met = packed.repartition(parts, "bucket").select("values", "which").mapInArrow(_meet(radius), "a long, b long")
        done = written(met, "simhash-links")
        out = done if out is None else out.union(done)
    return out


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    radius: int = 2,
    passes: int = 8,
) -> DataFrame:
    """(``doc_id``, ``tie``, ``fp``, ``component_id``, ``stays``), one row per row of ``docs``.

    Documents link when their fingerprints differ in at most ``2 * radius`` bits; ``component_id`` is the smallest id
    that can be reached, null where every reachable id is null.  ``tie`` is a hash of the text; ``stays`` marks the row
    with the smallest id (null last) and, among equal ids, the smallest ``tie`` of its component, so of a group one
    document stays, and two only if they are equal in id and text.  Null and blank texts have fingerprint 0 and link like
    any other.  Equal fingerprints are one node from the start, so a group of copies costs one row.  Rows with equal
    ids stay separate rows.  An empty table gives an empty result; only the two named columns are read.
    """
    spark = docs.sparkSession
    # A finished job's shuffle files go at once, not when the driver next collects garbage.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        marked = written(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "simhash-marks")
        least = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")
        distinct = written(marked.groupBy("fp").agg(F.min(least).alias("least")), "simhash-distinct")
        n = distinct.count()
        spread = distinct.repartition(max(1, n // 8192, spark.sparkContext.defaultParallelism))
        found = components(links(spread, n, radius=radius, passes=passes))
        placed = distinct.join(found, distinct["fp"] == found["node"], "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        )
        heads = placed.groupBy("component").agg(F.min("least").alias("head"))
        classes = written(placed.join(heads, "component").select("fp", "head"), "simhash-classes")
    stays = F.col("id").eqNullSafe(F.col("head.id")) & (F.col("tie") == F.col("head.tie"))
    return marked.join(classes, "fp", "left").select(
        F.col("id").alias("doc_id"), "tie", "fp", F.col("head.id").alias("component_id"), stays.alias("stays")
    )
