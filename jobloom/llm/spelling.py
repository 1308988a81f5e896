"""Spelling variants by a bit-sliced position index.

Words of a block have a bit each; the index holds, per position and letter, the bitset of words with that letter
there.  A query word walks the positions once and keeps four bitsets: words without an error so far, and those with
one replaced, one inserted, one missing letter.  The last two read the index one position ahead or behind.  All words
of a block are queries at the same time, so each step is a few operations on whole matrices of 64-bit words.

A word meets only words that can be near it.  Two words at one error, the shorter of length ``s``, agree outside some
stretch (``lo``, ``hi``) of the shorter one: the error lies in its right half, then they agree on the left half, or it
does not, then they agree on what follows the left half.  Halving goes on for groups above ``most_words``, until the
stretch has one letter, so no group is large however many words share a beginning.  Each pair is found in one group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import slices, written

#: Maximal runs of these letters are words; only A-Z are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FLUSH = 200_000


def edited_words(doc_id: int | None, text: str, shortest: int, one_in: int) -> Counter:
    """Occurrences per word of a text, after the letter that the fixed rule deletes from some runs."""
    counts = Counter()
    head = zlib.crc32(b"" if doc_id is None else str(doc_id).encode(), 0)
    head = zlib.crc32(b":", head)
    runs = Counter(re.findall(f"[{LETTERS}]{{{shortest},}}", text.translate(_LOWER)))
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= shortest:
            counts[run] += n
    return counts


def _counted(shortest: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        counts = Counter()
        for batch in slices(batches, lambda b: b.column(1)):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    counts.update(edited_words(doc_id, text, shortest, one_in))
                    if len(counts) > _FLUSH:
                        yield full()
                        counts = Counter()
        if counts:
            yield full()

    return run


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2, one_in: int = 31
) -> DataFrame:
    """(``word``, ``n``): words of at least ``shortest`` letters that occur at least ``least`` times in all texts.

    From a run whose crc32 of ``<id>:<run>`` is divisible by ``one_in`` the letter at crc32 modulo its length is
    deleted first.  Null and empty texts have no words; a null id counts as an empty one.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = given.mapInArrow(_counted(shortest, one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _bitsets(member: np.ndarray) -> np.ndarray:
    """Boolean rows packed to 64-bit words."""
    wide = -member.shape[-1] % 64
    padded = np.pad(member, [(0, 0)] * (member.ndim - 1) + [(0, wide)])
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def near_in_block(words: list[str], group: np.ndarray, s: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Matrix of near words: row ``q`` marks the words of ``q``'s group with exactly one error against it.

    ``group`` numbers the groups, ``s`` and ``hi`` are those of the word's group (see the module).  Texts end in an
    endless row of signs for "no letter", so an error at the end is a replaced letter.
    """
    n, longest = len(words), max(map(len, words))
    length = np.fromiter(map(len, words), np.int64, n)
    codes = np.zeros((n, longest + 3), np.uint32)
    for i, word in enumerate(words):
        codes[i, : len(word)] = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    signs, codes = np.unique(codes, return_inverse=True)
    codes = codes.reshape(n, longest + 3)
    letter = np.arange(len(signs))[:, None]

    def index(position: int) -> np.ndarray:
        return _bitsets(codes[:, position][None, :] == letter)

    same_group = _bitsets(group[:, None] == group[None, :])
    none, behind, here = same_group, None, index(0)
    replaced, inserted, missing = (np.zeros_like(none) for _ in range(3))
    early = np.zeros_like(none)  # words that agree before ``hi`` belong to another group
    for i in range(longest + 2):
        ahead, q = index(i + 1), codes[:, i]
        stop = np.flatnonzero((hi == i) & (hi < s))
        early[stop] = none[stop]
        hit = here[q]
        inserted = (inserted | none) & ahead[q]
        missing = none if behind is None else (missing & behind[q]) | none
        replaced = (replaced & hit) | (none & ~hit)
        none = none & hit
        behind, here = here, ahead
    near = (replaced | inserted | missing) & ~none & ~early
    bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :n].view(bool)
    # A longer word meets only shorter ones here; words of its own length wait in their own groups.
    return bits & (np.minimum(length[:, None], length[None, :]) == s[:, None])


def _zone_matches(at_once: int):
    """Words sorted by zone to (word, number of near words, best near word with its count), one row per word and zone."""

    def solve(rows: list) -> Iterator[pa.RecordBatch]:
        # In order of preference as a form: the first bit of a row is the best near word.
        rows.sort(key=lambda r: (-r[2], r[1]))
        zones = {z: i for i, z in enumerate(dict.fromkeys(r[0] for r in rows))}
        words = [r[1] for r in rows]
        as_array = lambda c: np.fromiter((r[c] for r in rows), np.int64, len(rows))
        near = near_in_block(words, np.array([zones[r[0]] for r in rows]), as_array(3), as_array(4))
        found = near.sum(axis=1)
        best = near.argmax(axis=1)
        hits = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in hits], pa.string()),
                pa.array(found[hits].astype(np.int64)),
                pa.array([words[i] for i in best[hits]], pa.string()),
                pa.array([rows[i][2] for i in best[hits]], pa.int64()),
            ],
            names=["word", "n_near", "near", "near_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, zone, own = [], None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != zone:
                    if len(own) > 1:
                        block += own
                    zone, own = row[0], []
                    if len(block) >= at_once:
                        yield from solve(block)
                        block = []
                own.append(row)
        if len(own) > 1:
            block += own
        if block:
            yield from solve(block)

    return run


def _zoned(rows: DataFrame) -> DataFrame:
    """The two halves of each row's stretch, with the text outside as the group's name."""
    mid = F.expr("lo + (hi - lo + 1) div 2")
    halves = F.array(F.struct(mid.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), mid.alias("hi")))
    split = rows.select("word", "n", "s", F.explode(halves).alias("half")).select("word", "n", "s", "half.lo", "half.hi")
    outside = F.concat_ws(
        ",",
        "s", "lo", "hi",
        F.expr("substring(word, 1, lo)"),
        F.expr("substring(word, length(word) - s + hi + 1, s - hi)"),
    )
    return split.select(outside.alias("zone"), "word", "n", "s", "hi", "lo")


def near_words(words: DataFrame, *, most_words: int = 2048, at_once: int = 512) -> DataFrame:
    """(``word``, ``n``, ``n_near``, ``near``, ``near_n``) for distinct ``words`` (``word``, ``n``).

    Near words differ by exactly one inserted, deleted or replaced code point.  ``near`` is the near word with the
    largest count, the smallest in code-point order among equals; null without one.  Words have a letter at least.
    """
    lengths = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("s")
    whole = words.select("word", "n", lengths).where("s > 0").withColumns({"lo": F.lit(0), "hi": F.col("s")})
    waiting, ready = _zoned(whole), []
    spark = words.sparkSession
    while True:
        rows = written(waiting, "spelling-zones")
        sizes = rows.groupBy("zone").agg(F.count("*").alias("members"), F.first("hi").alias("z_hi"), F.first("lo").alias("z_lo"))
        large = written(sizes.where((F.col("members") > most_words) & (F.col("z_hi") - F.col("z_lo") > 1)).select("zone"), "spelling-large")
        if not large.head(1):
            ready.append(rows)
            break
        ready.append(rows.join(large, "zone", "left_anti"))
        waiting = _zoned(rows.join(large, "zone", "left_semi"))
    total, found = 0, None
    for rows in ready:
        total = rows.count()
        parts = max(spark.sparkContext.defaultParallelism, total // 100_000)
        dealt = rows.select("zone", "word", "n", "s", "hi").repartition(parts, "zone").sortWithinPartitions("s", "zone")
        hits = dealt.mapInArrow(_zone_matches(at_once), "word string, n_near long, near string, near_n long")
        found = hits if found is None else found.union(hits)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    met = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "near", "near_n")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), "near")))
    merged = none.unionByName(met).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def roots(words: DataFrame) -> DataFrame:
    """``words`` (``word``, ``form``, ...) with ``root``: the end of the chain of forms, by doubling the step.

    Forms must not run in circles; here their counts grow tenfold, so a chain has at most 18 steps.
    """
    now = written(words.withColumn("root", F.coalesce("form", "word")), "spelling-roots")
    while True:
        steps = now.where("form is not null").select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        ahead = now.join(steps, F.col("root") == F.col("_at"), "left").withColumn("_moved", F.col("_to").isNotNull())
        moved = written(ahead.withColumn("root", F.coalesce("_to", "root")).drop("_at", "_to"), "spelling-roots")
        now = moved.drop("_moved")
        if not moved.where("_moved").head(1):
            return now


def group_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2, one_in: int = 31, times: int = 10, most_words: int = 2048
) -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``), one row per word of ``word_counts``.

    ``form`` is the best near word if it occurs at least ``times`` as often, else null; ``root`` is the word at the end
    of the chain of forms, the word itself without a form.  Nulls, blank texts and empty tables give no rows; repeated
    rows count as often as they occur; only the two named columns are read.
    """
    words = written(word_counts(docs, id_col=id_col, text_col=text_col, shortest=shortest, least=least, one_in=one_in), "spelling-words")
    near = near_words(words, most_words=most_words)
    chosen = F.col("near_n") >= times * F.col("n")
    formed = near.select("word", F.when(chosen, F.col("near")).alias("form"), "n", "n_near", F.when(chosen, F.col("near_n")).alias("form_n"))
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
