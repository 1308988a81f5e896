"""Exact removal of byte strings that occur more than once, by bounded interval expansion on a Burrows-Wheeler transform.

Suffixes are never compared across the corpus.  The least 128-byte hash inside a 400-byte string is a function of that
string alone, so equal strings meet under equal values.  Consecutive strings of a document with one value are a run;
runs are counted by value, equal runs become one, and only values with several different runs (or a run that repeats
itself) need a transform.  Their bytes go, value by value, to blocks of bounded size, and the transform decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import written

MIN_LENGTH = 400
ANCHOR = 128
_SEGMENT = 1 << 21
_LONGEST_RUN = 1 << 16
_SEPARATOR = b"\xff"  # no byte of UTF-8


# --- the transform -----------------------------------------------------------


def bounded_suffix_array(text: np.ndarray, length: int) -> np.ndarray:
    """Rotations of ``text`` (uint8) in the order of at least their first ``length`` bytes, by prefix doubling."""
    n = len(text)
    around = np.concatenate([text, np.resize(text, 8)])
    key = np.ndarray((n,), dtype=">u8", buffer=around.tobytes(), strides=(1,)).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = 8
    while k < length:
        alone = new.copy()
        alone[:-1] &= new[1:]
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        at = order[rows]
        both = (rank[at] << 32) | rank[(at + k) % n]
        inside = np.argsort(both)
        order[rows], both = at[inside], both[inside]
        new[rows[1:]] = both[1:] != both[:-1]
        rank[order[rows]] = np.maximum.accumulate(np.where(new[rows], rows, 0))
        k *= 2
    return order


def repeated_starts(text: np.ndarray, length: int, at_once: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Which rotations share their first ``length`` bytes with another one; also one of each such class.

    Backward extension turns the interval of a string w into those of all strings cw.  Breadth first, level l finds
    exactly the places where neighbours in suffix order share l bytes: the right ends of intervals not found on an
    earlier level.  Only those are extended further, and after ``length`` levels the search stops: places still open
    have neighbours with at least ``length`` common bytes.
    """
    n = len(text)
    order = bounded_suffix_array(text, length)
    before = text[order - 1]
    came_from = np.argsort(before, kind="stable")  # row whose extension is row k
    goes_to = np.empty(n, np.int64)
    goes_to[came_from] = np.arange(n)
    first_byte = before[came_from]
    following = np.full(n, n, np.int64)  # next row with the same byte before it
    same = first_byte[1:] == first_byte[:-1]
    following[:-1][same] = came_from[1:][same]
    key = first_byte.astype(np.int64) * n + came_from
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(low):
            break
        lows, highs = [], []
        width = np.cumsum(high - low)
        cuts = [0, *np.searchsorted(width, np.arange(at_once, int(width[-1]) + at_once, at_once), "left").tolist()]
        cuts = sorted({min(c, len(low)) for c in cuts} | {len(low)})
        for i, j in zip(cuts, cuts[1:], strict=False):
            size = high[i:j] - low[i:j]
            begin = np.repeat(low[i:j], size)
            row = begin - np.repeat(np.cumsum(size) - size, size) + np.arange(int(size.sum()))
            there = goes_to[row]
            good = np.flatnonzero(open_[there + 1] & (following[there] >= np.repeat(high[i:j], size)))
            there = there[good]
            highs.append(there + 1)
            lows.append(np.searchsorted(key, first_byte[there].astype(np.int64) * n + begin[good]))
        low, high = np.concatenate(lows), np.concatenate(highs)
        open_[high] = False
    shared = open_[:-1] | open_[1:]
    starts, leaders = np.zeros(n, bool), np.zeros(n, bool)
    starts[order[shared]] = True
    leaders[order[shared & ~open_[:-1]]] = True
    return starts, leaders


# --- runs ----------------------------------------------------------------------


def _anchor_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (a multiple of 8) from each place on."""
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    n = len(data) - width + 1
    h = np.zeros(n, np.uint64)
    for k in range(0, width, 8):
        h ^= words[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(h)] = h
    square = padded.reshape(blocks, width)
    upto = np.minimum.accumulate(square, axis=1).ravel()
    onward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int, anchor: int):
    """Runs (begin, size, value, repeats itself) of the texts that lie in ``data`` one after the other."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none.astype(bool)
    hashes = _anchor_hashes(data, anchor)
    width = length - anchor + 1
    value = _window_minima(hashes, width)
    n = len(value)
    valid = np.ones(n, bool)
    for e in ends[:-1].tolist():  # strings that would cross into the next text
        valid[max(0, e - length + 1) : min(e, n)] = False
    cut = np.ones(n, bool)
    cut[1:] = (value[1:] != value[:-1]) | ~valid[:-1]
    border = np.flatnonzero(cut | ~valid)
    begin = np.flatnonzero(cut & valid)
    after = np.searchsorted(border, begin, "right")
    size = np.concatenate([border, [n]])[after] - begin
    if len(size) and size.max() > _LONGEST_RUN:
        pieces = -(-size // _LONGEST_RUN)
        number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(begin + size, pieces)
        begin = np.repeat(begin, pieces) + number * _LONGEST_RUN
        size = np.minimum(end - begin, _LONGEST_RUN)
    # A run can only repeat itself if its value occurs at two places in it.
    span = size + width - 1
    place = np.repeat(begin - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
    hits = (hashes[place] == np.repeat(value[begin], span)).astype(np.int64)
    twice = np.add.reduceat(hits, np.cumsum(span) - span) > 1 if len(begin) else none.astype(bool)
    return begin, size, value[begin], twice


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column, uncopied; nulls are empty."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, texts, begin, end) of stretches of about ``_SEGMENT`` bytes; a longer text is cut with overlap."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        if offsets[j] - offsets[i] > _SEGMENT:
            for at in range(int(offsets[i]), int(offsets[j]) - length + 1, _SEGMENT):
                yield i, 1, at, min(int(offsets[j]), at + _SEGMENT + length - 1)
        else:
            while j < n and offsets[j + 1] - offsets[i] <= _SEGMENT:
                j += 1
            yield i, j - i, int(offsets[i]), int(offsets[j])
        i = j


_RUNS = "doc_id long, tie long, begin long, size int, value long, run_1 long, run_2 long, twice boolean"


def _find_runs(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            data, offsets = _raw(batch.column(2))
            for first, n_docs, lo, hi in _segments(offsets, length):
                part = np.ascontiguousarray(data[lo:hi])
                ends = np.minimum(offsets[first + 1 : first + n_docs + 1], hi) - lo
                begin, size, value, twice = runs_of(part, ends, length, anchor)
                if not len(begin):
                    continue
                view = memoryview(part)
                spans = zip(begin.tolist(), (begin + size + length - 1).tolist(), strict=True)
                name = np.frombuffer(b"".join([digest(view[i:j]) for i, j in spans]), "<i8").reshape(-1, 2)
                doc = np.searchsorted(ends, begin, "right") + first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc)),
                        batch.column(1).take(pa.array(doc)),
                        pa.array(begin + lo - offsets[doc]),
                        pa.array(size.astype(np.int32)),
                        pa.array(value.view(np.int64)),
                        pa.array(np.ascontiguousarray(name[:, 0])),
                        pa.array(np.ascontiguousarray(name[:, 1])),
                        pa.array(twice),
                    ],
                    names=["doc_id", "tie", "begin", "size", "value", "run_1", "run_2", "twice"],
                )

    return run


# --- blocks --------------------------------------------------------------------

_PIECES = "value long, salt int, run_1 long, run_2 long, bytes binary"
_FOUND = "value long, run_1 long, run_2 long, lo int, hi int, window binary"


def _cut(length: int):
    """Documents with the runs wanted of them to the bytes of those runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                text = memoryview(text.as_buffer())
                for w in wanted.as_py():
                    piece = bytes(text[w["begin"] : w["begin"] + w["size"] + length - 1])
                    rows.append((w["value"], w["salt"], w["run_1"], w["run_2"], piece))
                    held += len(piece)
                if held > 8 << 20:
                    yield _piece_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _piece_batch(rows)

    return run


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["value", "salt", "run_1", "run_2", "bytes"])


def _decide(length: int, block_bytes: int):
    """Pieces, ordered by value and salt, to the stretches of them that occur again.

    A salted value's pieces are spread over several blocks; what is alone in its block, and one string of each class
    that is not, is also named by a hash, by which the blocks are compared afterwards.
    """

    def solve(block: dict) -> pa.RecordBatch | None:
        import xxhash

        names = list(block)
        sizes = np.array([len(p) for p in block.values()], np.int64)
        text = np.frombuffer(_SEPARATOR.join([*block.values(), b""]), np.uint8)
        starts, leaders = repeated_starts(text, length)
        offset = np.cumsum(sizes + 1) - sizes - 1
        out = []
        for i, (value, salt, one, two) in enumerate(names):
            here = starts[offset[i] : offset[i] + sizes[i] - length + 1]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8)))
            out += [(value, one, two, int(a), int(b), None) for a, b in zip(edge[::2], edge[1::2], strict=True)]
            if salt >= 0:
                lead = leaders[offset[i] : offset[i] + len(here)]
                piece = memoryview(block[names[i]])
                for k in np.flatnonzero(~here | lead).tolist():
                    out.append((value, one, two, k, k + 1, xxhash.xxh3_128_digest(piece[k : k + length])))
        if not out:
            return None
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["value", "run_1", "run_2", "lo", "hi", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, last = {}, 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if row[:2] != last and held >= block_bytes:
                    if (done := solve(block)) is not None:
                        yield done
                    block, held = {}, 0
                last = row[:2]
                if row[:4] not in block:
                    block[row[:4]] = bytes(row[4].as_buffer())
                    held += len(block[row[:4]])
        if block and (done := solve(block)) is not None:
            yield done

    return run


def _remove(keep_text: bool):
    """Documents with the spans to remove to what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                merged: list[list[int]] = []
                if spans.is_valid:
                    flat = spans.values
                    pairs = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], axis=1)
                    for lo, hi in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], hi)
                        else:
                            merged.append([lo, hi])
                at, sha, left = 0, hashlib.sha256(), []
                for lo, hi in [*merged, [len(data), len(data)]]:
                    sha.update(data[at:lo])
                    if keep_text:
                        left.append(bytes(data[at:lo]))
                    at = hi
                removed = sum(hi - lo for lo, hi in merged)
                rows.append((doc_id.as_py(), len(data), removed, len(merged), sha.hexdigest(), b"".join(left) if keep_text else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = MIN_LENGTH,
    anchor: int = ANCHOR,
    block_bytes: int = 4 << 20,
    keep_text: bool = True,
) -> DataFrame:
    """Removes every byte covered by a ``length``-byte string that also starts anywhere else in ``docs``.

    Returns per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed stretches), ``kept_sha256`` and,
    with ``keep_text``, ``kept`` (the remaining bytes; a cut may split a character).  Strings are judged on the input;
    overlaps count, so do repeats inside a document.  Texts are UTF-8 bytes, null is empty, and matches never cross
    documents.  Texts shorter than ``length`` stay whole.  Rows equal in id and text are copies of each other like any
    others and lose everything from ``length`` bytes on.  Ids have to be integers or null; other columns are not read.
    An empty table gives an empty result.

    ``anchor`` (a multiple of 8, below ``length``) is the width of the hashes.  A value whose different runs have more
    than ``block_bytes`` bytes is split over blocks, whose classes are then compared by 128-bit hashes of whole strings,
    so no block grows with the corpus.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))
    runs = written(given.mapInArrow(_find_runs(length, anchor), _RUNS), "repeat-runs")
    values = runs.groupBy("value").agg(F.count("*").alias("n"), F.max("twice").alias("any_twice")).where("n > 1 or any_twice")
    # As tables, both sides of a join are plain scans, and adaptive execution can split a hot value's partition.
    values = written(values.select("value"), "repeat-values")
    shared = written(runs.join(values, "value"), "repeat-shared")
    # first() of several columns comes from one row: all are updated together.
    distinct = shared.groupBy("value", "run_1", "run_2").agg(
        F.count("*").alias("n"),
        F.first("doc_id").alias("doc_id"),
        F.first("tie").alias("tie"),
        F.first("begin").alias("begin"),
        F.first("size").alias("size"),
        F.first("twice").alias("twice"),
    )
    distinct = written(distinct, "repeat-distinct")
    kinds = distinct.groupBy("value").agg(
        F.count("*").alias("n_runs"), F.sum(F.col("size") + length).alias("n_bytes"), F.max("twice").alias("any_twice")
    )
    kinds = written(kinds.where("n_runs > 1 or any_twice").drop("any_twice"), "repeat-kinds")
    salt = F.when(
        F.col("n_bytes") > block_bytes, F.pmod(F.col("run_1"), F.ceil(F.col("n_bytes") / (block_bytes / 2))).cast("int")
    ).otherwise(F.lit(-1))
    asked = distinct.join(kinds, "value").select(
        "doc_id", "tie", F.struct("value", salt.alias("salt"), "run_1", "run_2", "begin", "size").alias("wanted")
    )
    per_doc = asked.groupBy("doc_id", "tie").agg(F.collect_list("wanted").alias("wanted"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])
    pieces = given.join(per_doc, same(given, per_doc)).select("text", "wanted").mapInArrow(_cut(length), _PIECES)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = pieces.repartition(parts, "value", "salt").sortWithinPartitions("value", "salt")
    found = written(blocks.mapInArrow(_decide(length, block_bytes), _FOUND), "repeat-found")
    across = found.where("window is not null").groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    inside = found.where("window is null").drop("window").union(found.join(across, "window").select("value", "run_1", "run_2", "lo", "hi"))
    whole = distinct.where("n > 1").select("value", "run_1", "run_2", F.lit(0).alias("lo"), F.col("size").alias("hi"))
    stretches = whole.union(inside)
    spans = shared.join(stretches, ["value", "run_1", "run_2"]).select(
        "doc_id", "tie", F.struct((F.col("begin") + F.col("lo")).alias("lo"), (F.col("begin") + F.col("hi") + length - 1).alias("hi")).alias("span")
    )
    spans = spans.groupBy("doc_id", "tie").agg(F.collect_set("span").alias("spans"))
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return given.join(spans, same(given, spans), "left").select(given["doc_id"], "text", "spans").mapInArrow(_remove(keep_text), kind)
