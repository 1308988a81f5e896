"""Log-likelihood of whole documents under a recurrent language model trained on the corpus itself.

1. Word counts of all training texts, pre-aggregated in the tasks.  The most frequent ones (``HEAD`` at most) go to all
   tasks; a prefix of them is the net's vocabulary, every other word its symbol for rare words.
2. All texts are encoded once, as 16-bit symbols, with the sums that the head's counts give.  Words outside the head meet
   their counts in a join; none of them is frequent, so no join key is hot.
3. The net is trained in ``rounds``; each takes its share of all training texts, cut into parts of about
   ``part_tokens``.  Every part starts from the same net, and the changes are averaged, each weight by the evidence
   (summed squared gradients) the parts have for it.  The sums are added up in groups of 64 parts, level by level.
4. Every text is scored whole, the state carried from its first token to its end.

A rare word has the probability of the rare symbol times its smoothed share among the rare words, so the probabilities
of all words, with one for anything unseen, sum to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm import recurrent
from jobloom.llm.common import setting, slices, written

#: Most words whose counts every task holds, and their greatest length in bytes; others are joined.
HEAD, HEAD_BYTES = 131_072, 256
_FLUSH = 300_000
_SCORED_AT_ONCE = 4 << 20
_BLOCK = 1 << 14


@dataclass(frozen=True)
class Vocabulary:
    """Head words by falling count, their counts, and the totals of the training tokens."""

    words: list[bytes]
    counts: np.ndarray
    ends: int
    tokens: int
    distinct: int
    shape: recurrent.Shape

    @property
    def known(self) -> int:
        """Words that are symbols of the net."""
        return min(len(self.words), self.shape.symbols - 2)

    def symbol_counts(self) -> np.ndarray:
        own = self.counts[: self.known]
        return np.concatenate([[self.tokens - self.ends - own.sum(), self.ends], own])

    def base_total(self) -> int:
        """Denominator of the base probability."""
        return self.tokens + self.distinct + 1

    def rare_total(self) -> int:
        """The same among the words that are not symbols."""
        return int(self.symbol_counts()[0]) + self.distinct - (self.ends > 0) - self.known + 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def full():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    counts, ends = Counter(), 0
    for batch in slices(batches, lambda b: b.column(0)):
        ends += batch.num_rows
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(text.lower().split())
                if len(counts) > _FLUSH:
                    yield full()
                    counts = Counter()
    counts[None] = ends  # no word is null, so this is the end of a text
    yield full()


def word_counts(texts: DataFrame) -> DataFrame:
    """(``word``, ``n``) over all of ``texts`` (a binary column); the null word is the end of a text."""
    return texts.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def vocabulary(counts: DataFrame, shape: recurrent.Shape, head: int = HEAD) -> Vocabulary:
    """Totals and head of written ``counts``.

    The head holds all words from the least count on at which they are at most ``head``, counts grouped to sixteenths of
    a power of two; a few thousand such groups, and the head, are all that reaches the driver.
    """
    short = F.col("word").isNotNull() & (F.octet_length("word") <= HEAD_BYTES)
    level = F.floor(F.log2("n") * 16)
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("ends")).first()
    levels = sorted(counts.where(short).groupBy(level.alias("level")).count().collect(), reverse=True)
    lowest, held = None, 0
    for step, n in levels:
        held += n
        if held > head:
            break
        lowest = step
    rows = counts.where(short & (level >= lowest)).collect() if lowest is not None else []
    rows = sorted(((bytes(r.word), r.n) for r in rows), key=lambda r: (-r[1], r[0]))
    return Vocabulary([w for w, _ in rows], np.array([n for _, n in rows], np.int64), totals.ends or 0, totals.tokens or 0, totals.distinct, shape)


def _encoded(v: Vocabulary):
    """Texts to symbols and sums of what the head knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = {w: i for i, w in enumerate(v.words)}.get
        smoothed = np.log10(np.append(v.counts, 0) + 1.0)  # the last is for words outside the head, which are joined
        row = TaskContext.get().partitionId() << 33
        end = np.log10(v.ends + 1.0)
        for batch in slices(batches, lambda b: b.column(3), 4 << 20):
            out = {name: [] for name in ("n_tokens", "n_known", "smoothed", "rare", "n_rare", "symbols", "tail", "times")}
            for text in batch.column(3).to_pylist():
                words = text.lower().split() if text else []
                at = np.fromiter(map(place, words, repeat(-1)), np.int64, len(words))
                joined = at < 0
                rare = (at >= v.known) | joined
                tail = Counter(compress(words, joined.tolist()))
                known = smoothed[at]
                out["n_tokens"].append(len(words) + 1)
                out["n_known"].append(len(words) - int(joined.sum()) + (v.ends > 0))
                out["smoothed"].append(float(known.sum()) + end)
                out["rare"].append(float(known[rare].sum()))
                out["n_rare"].append(int(rare.sum()))
                out["symbols"].append(np.append(np.where(rare, recurrent.RARE, at + 2), recurrent.END).astype(np.uint16).tobytes())
                out["tail"].append(list(tail))
                out["times"].append(list(tail.values()))
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([rows, *batch.columns[:3], *columns], names=["row", *batch.schema.names[:3], *out])

    return run


_ENCODED = "row long, doc_id long, held_out boolean, teaches boolean, n_tokens long, n_known long, smoothed double, rare double, n_rare long, symbols binary, tail array<binary>, times array<long>"


_SUMS = "block int, part long, sums binary"


def _trained(flat: np.ndarray, like: dict, rate: float, part_tokens: int):
    """A part's texts to blocks of evidence and evidence-weighted changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start, net = recurrent.unpacked(flat, like), recurrent.unpacked(flat, like)
        sums = {k: np.ones_like(x) for k, x in net.items()}
        texts, held = [], 0
        for batch in batches:
            for symbols in batch.column(0).to_pylist():
                texts.append(np.frombuffer(symbols, np.uint16))
                held += len(texts[-1])
                if held >= 2 * part_tokens:
                    recurrent.train(net, texts, sums, rate=rate)
                    texts, held = [], 0
        if texts:
            recurrent.train(net, texts, sums, rate=rate)
        evidence = recurrent.packed(sums) - 1
        if not evidence.any():
            return
        change = evidence * (recurrent.packed(net) - recurrent.packed(start))
        cuts = range(0, len(evidence), _BLOCK)
        part = TaskContext.get().partitionId()
        values = [np.concatenate([evidence[i : i + _BLOCK], change[i : i + _BLOCK]]).tobytes() for i in cuts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array([part] * len(values), pa.int64()), pa.array(values, pa.binary())],
            names=["block", "part", "sums"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    """Sums of a group of up to 64 parts, in the order of their numbers."""
    ordered = table.sort_by("part")
    total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in ordered["sums"].to_pylist())
    first = ordered.slice(0, 1)
    return pa.table({"block": first["block"], "part": pa.array([first["part"][0].as_py() // 64], pa.int64()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(encoded: DataFrame, v: Vocabulary, *, rounds: int = 4, part_tokens: int = 1 << 20, rate: float = 0.2, seed: int = 0) -> dict[str, np.ndarray]:
    """The net after one pass over all training texts of ``encoded``; its size does not depend on them."""
    net = recurrent.new_net(v.shape, v.symbol_counts(), seed)
    flat = recurrent.packed(net)
    per_round = v.tokens // rounds
    parts = max(1, -(-per_round // part_tokens))
    for r in range(rounds):
        mine = encoded.where(F.col("teaches") & (F.pmod(F.xxhash64("row"), F.lit(rounds)) == r))
        dealt = mine.select("symbols", F.xxhash64("row", F.lit(1)).alias("deal")).repartition(parts, "deal").sortWithinPartitions("deal")
        sums, groups = dealt.select("symbols").mapInArrow(_trained(flat, net, rate, part_tokens), _SUMS), None
        while groups != 1:
            sums = written(sums.groupBy("block", F.expr("part div 64").alias("_of")).applyInArrow(_added, _SUMS), "scoring-sums")
            groups = 1 + (sums.agg(F.max("part")).first()[0] or 0)
        for row in sums.collect():  # as many bytes as two nets
            evidence, change = np.split(np.frombuffer(row["sums"], np.float32), 2)
            at = row["block"] * _BLOCK
            flat[at : at + len(change)] += np.divide(change, evidence, out=np.zeros_like(change), where=evidence > 0)
    return recurrent.unpacked(flat, net)


def _scored(net: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored():
            found = recurrent.log_probabilities(net, texts) / np.log(10)
            table = pa.Table.from_batches(held).append_column("lm", pa.array(found))
            return table.combine_chunks().to_batches()

        held, texts, size = [], [], 0
        for batch in batches:
            of = [np.frombuffer(x, np.uint16) for x in batch.column("symbols").to_pylist()]
            held.append(batch.drop_columns(["symbols"]))
            texts += of
            size += sum(map(len, of))
            if size >= _SCORED_AT_ONCE:
                yield from scored()
                held, texts, size = [], [], 0
        if texts:
            yield from scored()

    return run


def score_documents(
    docs: DataFrame,
    held_out: Column,
    teaches: Column | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shape: recurrent.Shape | None = None,
    rounds: int = 4,
    part_tokens: int = 1 << 20,
    head: int = HEAD,
) -> DataFrame:
    """(``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``), a row per row.

    Tokens are runs of non-blank characters with A-Z lower-cased, then one end.  The rows where ``teaches`` holds (not
    ``held_out`` by default; null is false) train the net and the counts.  ``base_score`` adds the log10 of
    add-one-smoothed frequencies, ``score`` is the net's log10 probability of the whole text.  Null and blank texts are
    their end alone.  Repeated rows teach and are scored as often as they occur.  Without training texts the base
    probabilities are 1 and the net stays as it began.  An empty table gives an empty result; only the two named columns
    and those of the conditions are read.
    """
    spark = docs.sparkSession
    shape = shape or recurrent.Shape()
    held = F.coalesce(held_out, F.lit(False))
    learns = ~held if teaches is None else F.coalesce(teaches, F.lit(False))
    text = F.col(text_col).cast("binary").alias("text")
    # A finished job's shuffle files go at once, not when the driver next collects garbage.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        counts = written(word_counts(docs.where(learns).select(text)), "scoring-counts")
        v = vocabulary(counts, shape, head)
        given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), learns.alias("teaches"), text)
        encoded = written(given.mapInArrow(_encoded(v), _ENCODED), "scoring-encoded")
        net = train(encoded, v, rounds=rounds, part_tokens=part_tokens)
        tails = encoded.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", F.col("t.tail").alias("word"), F.col("t.times").alias("k"))
        c = F.coalesce("n", F.lit(0))
        met = tails.join(counts.where("word is not null"), "word", "left").select(
            "row", (F.col("k") * F.log10(c + 1.0)).alias("more"), F.when(c > 0, F.col("k")).otherwise(0).alias("found")
        )
        rest = written(met.groupBy("row").agg(F.sum("more").alias("more"), F.sum("found").alias("found")), "scoring-tails")
        columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "smoothed", "rare", "n_rare"]
        types = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, smoothed double, rare double, n_rare long, lm double"
        scored = encoded.select(*columns, "symbols").mapInArrow(_scored(net), types)
        joined = written(scored.join(rest, "row", "left"), "scoring-scores")
    more, found = F.coalesce("more", F.lit(0.0)), F.coalesce("found", F.lit(0))
    log10 = lambda n: float(np.log10(n))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + found).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("smoothed") + more - F.col("n_tokens") * log10(v.base_total())).alias("base_score"),
        (F.col("lm") + F.col("rare") + more - F.col("n_rare") * log10(v.rare_total())).alias("score"),
    )
