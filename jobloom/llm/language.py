"""Language identification by word-first backoff."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobloom.llm.common import slices

UNKNOWN = "und"
#: Runs of letters and combining marks are words if they have a letter.
_RUN, _LETTER = r"[\p{L}\p{M}]+", r"\p{L}"
#: Words longer than this are scored by n-grams alone, so one endless word costs no more than its length.
_LONGEST = 40
#: Places of a word whose n-grams are listed in one row.
_STRETCH = 1000


@dataclass
class Model:
    """Log frequencies per language: ``words[w]`` and ``grams[n][g]`` are tuples in the order of ``languages``."""

    languages: list[str]
    prior: list[float]
    words: dict[str, tuple[float, ...]] = field(default_factory=dict)
    grams: dict[int, dict[str, tuple[float, ...]]] = field(default_factory=dict)
    floor: tuple[float, ...] = ()
    longest: int = 5


def _logs(counts: dict[str, list[int]], totals: list[int], smoothing: float) -> dict[str, tuple[float, ...]]:
    """Log frequencies per key; keys with equal counts share one tuple, here and in every task's copy."""
    bottoms = [math.log(t + smoothing * (len(counts) + 1)) for t in totals]
    made: dict[tuple[int, ...], tuple[float, ...]] = {}
    for row in set(map(tuple, counts.values())):
        made[row] = tuple(math.log(c + smoothing) - b for c, b in zip(row, bottoms, strict=True))
    return {key: made[tuple(row)] for key, row in counts.items()}


def _most_frequent(counted: DataFrame, key: str, classes: list, limit: int, languages: list[str]) -> dict[str, list[int]]:
    """Counts per language of the ``limit`` most frequent keys of each language (and class of key)."""
    rank = F.row_number().over(Window.partitionBy("lang", *classes).orderBy(F.col("n").desc(), key))
    place = {name: i for i, name in enumerate(languages)}
    out: dict[str, list[int]] = {}
    for r in counted.withColumn("rank", rank).where(F.col("rank") <= limit).collect():
        out.setdefault(r[key], [0] * len(languages))[place[r["lang"]]] += r["n"]
    return out


def fit(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    order_col: str = "doc_id",
    rows_per_language: int = 4000,
    words_per_language: int = 20_000,
    grams_per_language: int = 20_000,
    longest: int = 5,
    smoothing: float = 0.5,
) -> Model:
    """Counts words and character n-grams of a bounded sample of labelled rows.

    ``rows_per_language`` is the documented bound: of each language about that many rows are drawn by a hash of id and
    text, the same ones in every run.  Words and n-grams (1 to ``longest`` characters, word ends marked by a blank)
    are counted on the cluster; the most frequent per language reach the driver, which bounds the model.  Words of over
    40 letters are counted by their n-grams only.  Rows with a
    null text or label teach nothing; without any labelled row the model has no language.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(order_col).alias("id"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    seen = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not seen:
        return Model([], [])
    languages = sorted(seen)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / seen[k]))])
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < share[F.col("lang")])
    units = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(_RUN), F.lit(0)), lambda w: w.rlike(_LETTER))
    words = sample.select("lang", F.explode(units).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    words = words.persist()
    try:
        padded = words.select("lang", "n", F.concat(F.lit(" "), F.col("word"), F.lit(" ")).alias("padded"))
        starts = F.explode(F.sequence(F.lit(1), F.length("padded"), F.lit(_STRETCH)))
        pieces = padded.withColumn("at", starts).select("lang", "n", F.expr(f"substring(padded, at, {_STRETCH + longest - 1})").alias("piece"))
        last = lambda n: F.least(F.length("piece") - n + 1, F.lit(_STRETCH))
        spans = F.flatten(
            F.transform(
                F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.length("piece") >= n),
                lambda n: F.transform(F.sequence(F.lit(1), last(n)), lambda i: F.substring(F.col("piece"), i, n)),
            )
        )
        grams = pieces.select("lang", F.explode(spans).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

        kept = words.where((F.col("n") >= 2) & (F.length("word") <= _LONGEST))
        word_counts = _most_frequent(kept, "word", [], words_per_language, languages)
        gram_counts = _most_frequent(grams, "gram", [F.length("gram")], grams_per_language, languages)
        totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    finally:
        words.unpersist()
    model = Model(languages, [0.0] * len(languages), longest=longest)
    n_words = [totals.get(k, 0) for k in languages]
    model.words = _logs(word_counts, n_words, smoothing)
    for n in range(1, longest + 1):
        kept = {g: c for g, c in gram_counts.items() if len(g) == n}
        model.grams[n] = _logs(kept, [sum(c[i] for c in kept.values()) for i in range(len(languages))], smoothing)
    model.floor = tuple(-math.log(len(model.grams[1]) + sum(c[i] for g, c in gram_counts.items() if len(g) == 1) + 1) for i in range(len(languages)))
    return model


def word_score(word: str, model: Model) -> tuple[float, ...]:
    """Log frequency per language: of the word if known, else of its n-grams.

    The word, with a blank at each end, is walked from the left; at each place the longest known n-gram that starts
    there counts and the walk goes on behind it.  A character that no language knows counts the same for all.
    """
    known = model.words.get(word)
    if known is not None:
        return known
    padded = f" {word} "
    total, at = [0.0] * len(model.languages), 0
    while at < len(padded):
        for n in range(min(model.longest, len(padded) - at), 0, -1):
            found = model.grams[n].get(padded[at : at + n])
            if found is not None:
                total = [a + b for a, b in zip(total, found, strict=True)]
                at += n
                break
        else:
            total = [a + b for a, b in zip(total, [min(model.floor)] * len(total), strict=True)]
            at += 1
    return tuple(total)


class Scorer:
    """Predicts texts under a model; scores of words met before are kept, up to ``kept`` of them."""

    def __init__(self, model: Model, kept: int = 150_000):
        import regex

        self.model, self.kept = model, kept
        self.find = regex.compile(_RUN).findall
        self.scores: dict[str, tuple[float, ...]] = {}

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share, in [0, 1], of the geometric mean likelihood per word; ``und`` without a letter."""
        model = self.model
        words = Counter(self.find(text.lower())) if text else {}
        bare = [w for w in words if not (w.isalpha() or any(map(str.isalpha, w)))]
        for word in bare:  # marks without a letter
            del words[word]
        if not words or not model.languages:
            return UNKNOWN, 0.0
        total = [0.0] * len(model.languages)
        for word, n in words.items():
            score = self.scores.get(word)
            if score is None:
                score = word_score(word, model)
                if len(self.scores) < self.kept and len(word) <= _LONGEST:
                    self.scores[word] = score
            for i, s in enumerate(score):
                total[i] += n * s
        n_words = sum(words.values())
        best = max(range(len(total)), key=lambda i: (total[i], -i))
        return model.languages[best], 1.0 / sum(math.exp(max(-700.0, (t - total[best]) / n_words)) for t in total)


def _predictions(model: Model, place: int | None):
    def texts(batch: pa.RecordBatch) -> pa.Array:
        return batch.column(1) if place is None else batch.column(0).field(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches, texts):
            row = batch.column(0)
            found = [scorer.predict(t) for t in texts(batch).to_pylist()]
            added = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([row, *added], names=["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default, as a struct), ``lang_pred`` and ``score``.

    Whole texts are read, nothing else of the row.  Null, empty and letterless texts are ``und`` with score 0, also those of
    digits, fractions and combining marks; equal
    scores go to the language that sorts first.  ``score`` compares the mean likelihood per word, so a long text is
    not sure just because it is long.  Rows keep their number; an empty table gives an empty result.
    """
    keep = list(docs.columns if keep is None else keep)
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    place = keep.index(text_col) if text_col in keep else None
    packed = docs.select(row) if place is not None else docs.select(row, F.col(text_col).alias("text"))
    kind = f"row {packed.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return packed.mapInArrow(_predictions(model, place), kind)
