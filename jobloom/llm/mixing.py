"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from jobloom.llm.common import BLANK, word_count, written

_BUCKET_BITS = 12
_SALTS = 64
_EXACT = T.DecimalType(38, 0)


def _exact(value: int) -> Column:
    return F.lit(str(value)).cast(_EXACT)


def _weighed(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(``m_source``, ``n``) with ``m_weight``: weights in rotation over the sources in code point order, null last.

    The sources are sorted across tasks; a place is its place in the task and the rows of the tasks before.
    """
    spark = sizes.sparkSession
    order = F.col("m_source").asc_nulls_last()
    place = F.monotonically_increasing_id()
    sorted_ = written(sizes.orderBy(order).select("m_source", "n", F.shiftright(place, 33).alias("m_task"), place.alias("m_at")), "mixing-sources")
    before, offsets = 0, []
    for task, rows in sorted(tuple(r) for r in sorted_.groupBy("m_task").count().collect()):
        offsets.append((task, before))
        before += rows
    # One row per task that sorted.
    offsets = F.broadcast(spark.createDataFrame(offsets, "m_task long, m_before long"))
    rank = F.col("m_before") + F.col("m_at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))).cast("int"))
    return sorted_.join(offsets, "m_task").select("m_source", "n", weight.cast("long").alias("m_weight"))


def _is_full(level: Fraction, cap: Fraction) -> Column:
    """Whether weight * level is above cap * size, in whole numbers."""
    asked = F.col("m_weight").cast(_EXACT) * _exact(level.numerator * cap.denominator)
    return asked > F.col("n").cast(_EXACT) * _exact(cap.numerator * level.denominator)


def water_level(sources: DataFrame, total_share: Fraction, cap: Fraction) -> Fraction | None:
    """The level at which shares of weight * level, stopped at cap * size, sum to ``total_share`` of all sizes.

    ``sources`` has ``n`` and ``m_weight``; those of size 0 have no part.  Exact arithmetic.  Each round finds the
    sources that the level fills above their cap and shares what they leave among the others, until none is new; a
    round is one sum over the sources, of which only two numbers reach the driver.  None if all sources are full.
    """
    given = sources.where("n > 0")
    total, weight = given.agg(F.sum(F.col("n").cast(_EXACT)), F.sum("m_weight")).first()
    if total is None:
        return None
    total = total_share * int(total)
    level, before = total / weight, None
    while level != before:
        full = _is_full(level, cap)
        capped, weight = given.agg(F.sum(F.when(full, F.col("n").cast(_EXACT))), F.sum(F.when(~full, F.col("m_weight")))).first()
        if not weight:
            return None
        before, level = level, (total - cap * int(capped or 0)) / weight
    return level


def _allotted(sources: DataFrame, level: Fraction | None, cap: Fraction) -> DataFrame:
    """(``m_source``, ``m_source_size``, ``m_target``, ``m_whole``, ``m_rest``): whole repetitions of each document and
    the words that a further one gives.  The target is rounded to whole words, half to even, and never above the cap."""
    size, weight = F.col("n").cast(_EXACT), F.col("m_weight").cast(_EXACT)
    full = F.lit(True) if level is None else _is_full(level, cap)
    level = Fraction(0) if level is None else level
    over = F.when(full, size * _exact(cap.numerator)).otherwise(weight * _exact(level.numerator))
    under = F.when(full, _exact(cap.denominator)).otherwise(_exact(level.denominator))
    parts = sources.select("m_source", "n", over.alias("o"), under.alias("u")).withColumn("floor", F.expr("o div u"))
    twice = 2 * (F.col("o") - F.col("floor").cast(_EXACT) * F.col("u")) - F.col("u")
    up = (twice > 0) | ((twice == 0) & (F.col("floor") % 2 == 1))
    most = F.expr(f"(cast(n as decimal(38,0)) * {cap.numerator}) div {cap.denominator}")
    words = F.least(F.col("floor") + F.when(up, F.lit(1)).otherwise(F.lit(0)), most)
    whole = F.when(F.col("n") > 0, F.expr("words div n")).otherwise(F.lit(0))
    return parts.withColumn("words", F.when(F.col("n") > 0, words).otherwise(F.lit(0))).select(
        "m_source",
        F.col("n").alias("m_source_size"),
        F.when(F.col("n") > 0, F.col("o").cast("double") / F.col("u").cast("double")).otherwise(F.lit(0.0)).alias("m_target"),
        whole.cast("long").alias("m_whole"),
        F.when(F.col("n") > 0, F.col("words") % F.col("n")).otherwise(F.lit(0)).cast("long").alias("m_rest"),
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    total_share: Fraction = Fraction(3, 2),
    cap: Fraction = Fraction(2),
    seed: int = 42,
    most_broadcast: int = 16 << 20,
) -> DataFrame:
    """How often each document is taken so that every source meets its target number of words.

    Returns ``row`` (all columns of ``docs`` as a struct, so no name can clash), ``size`` (words), ``source_size``,
    ``target`` (of its source), ``whole`` (whole repetitions), ``part`` (words of one further, partial repetition)
    and ``taken`` = whole * size + part.

    Sources in code point order, null last, get ``weights`` in rotation.  A source's target is rounded to whole words
    and divided by its size: the quotient is the whole repetitions of each document, the remainder goes to documents
    in the order of a seeded hash of id and text.  The document at the cut gives only the words still missing, so a
    source's taken words equal its rounded target.

    The order is cut without sorting a source: sizes are summed per source and hash range (4,096 ranges), the range
    that holds the cut is found from those sums, and only its rows are ordered.  Any number of sources will do: the
    level is found by sums over them (:func:`water_level`), and the driver sees none of them.  Tables of a row per
    source are broadcast while their bytes are at most ``most_broadcast``, else rows meet them by source and one of 64
    salts, over which a hot source is spread.  A null or blank text has size 0 and takes 0 words.  Rows that
    equal each other in id and text stand at one place in the order; at the cut they share the missing words evenly.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)), 1)
    base = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(source_col).cast("string").alias("m_source"),
        word_count(text_col).alias("size"),
        place.alias("m_place"),
        F.shiftright(place, 63 - _BUCKET_BITS).alias("m_bucket"),
    )
    sums = written(
        base.groupBy("m_source", "m_bucket").agg(F.sum("size").alias("m_size")),
        "mixing-sums",
    )
    sources = _weighed(sums.groupBy("m_source").agg(F.sum("m_size").alias("n")), weights)
    shares = written(_allotted(sources, water_level(sources, total_share, cap), cap), "mixing-shares")
    row_bytes = F.coalesce(F.octet_length("m_source"), F.lit(0)) + 64
    small = (shares.agg(F.sum(row_bytes)).first()[0] or 0) <= most_broadcast

    def with_sources(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """``left`` with the columns of its source's row of ``right``, which has one row per source or none."""
        if small:
            right = F.broadcast(right)
            joined = left.join(right, left["m_source"].eqNullSafe(right["m_source"]), how)
            return joined.drop(right["m_source"])
        right = right.withColumn("m_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        left = left.withColumn("m_salt", F.pmod("m_bucket", F.lit(_SALTS)).cast("int"))
        joined = left.join(right, left["m_source"].eqNullSafe(right["m_source"]) & (left["m_salt"] == right["m_salt"]), how)
        return joined.drop(right["m_source"], right["m_salt"]).drop("m_salt")

    below = F.coalesce(
        F.sum("m_size").over(Window.partitionBy("m_source").orderBy("m_bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    ranges = sums.withColumn("m_below", below)
    cut_ranges = (
        with_sources(ranges, shares)
        .where((F.col("m_below") <= F.col("m_rest")) & (F.col("m_rest") < F.col("m_below") + F.col("m_size")))
        .select("m_source", F.col("m_bucket").alias("m_cut_bucket"), (F.col("m_rest") - F.col("m_below")).alias("m_want"))
    )
    cut_ranges = written(cut_ranges, "mixing-ranges")
    inside = with_sources(base.select("m_source", "m_place", "m_bucket", "size"), cut_ranges).where(F.col("m_bucket") == F.col("m_cut_bucket"))
    places = inside.groupBy("m_source", "m_place", "m_cut_bucket", "m_want").agg(F.sum("size").alias("m_size"), F.count("*").alias("m_rows"))
    before = F.coalesce(
        F.sum("m_size").over(Window.partitionBy("m_source").orderBy("m_place").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    cuts = (
        places.withColumn("m_before", before)
        .where((F.col("m_before") <= F.col("m_want")) & (F.col("m_want") < F.col("m_before") + F.col("m_size")))
        .select(
            "m_source",
            F.col("m_place").alias("m_cut"),
            F.floor((F.col("m_want") - F.col("m_before")) / F.col("m_rows")).cast("long").alias("m_part"),
        )
    )
    joined = with_sources(with_sources(base, shares, "left"), written(cuts, "mixing-cuts"), "left")
    part = (
        F.when(F.col("m_cut").isNull() | (F.col("m_place") > F.col("m_cut")), F.lit(0))
        .when(F.col("m_place") < F.col("m_cut"), F.col("size"))
        .otherwise(F.least(F.col("size"), F.col("m_part")))
        .cast("long")
    )
    return joined.select(
        "row",
        "size",
        F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"),
        F.col("m_whole").alias("whole"),
        part.alias("part"),
        (F.col("m_whole") * F.col("size") + part).alias("taken"),
    )


def repeated(mixed: DataFrame, columns: Sequence[str], *, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The mixture itself: each row of :func:`mix` as often as it is taken, a partial repetition cut after its words.

    ``columns`` are the columns of the mixed documents; ``length_col`` names one that holds the text's length.
    """
    cut = F.array_join(F.slice(F.regexp_extract_all("row." + text_col, F.lit(f"[^{BLANK}]+"), F.lit(0)), F.lit(1), F.col("part").cast("int")), " ")
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("whole").cast("int")),
        F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")),
    )
    is_cut = F.col("m_partial") & (F.col("part") < F.col("size"))
    text = F.when(is_cut, cut).otherwise(F.col("row." + text_col))
    out = mixed.select("*", F.explode(copies).alias("m_partial"))
    chosen = []
    for c in columns:
        value = F.col(f"row.`{c}`")
        if c == text_col:
            value = text
        elif c == length_col:
            value = F.when(is_cut, F.length(cut).cast(mixed.schema["row"].dataType[c].dataType)).otherwise(value)
        chosen.append(value.alias(c))
    return out.select(*chosen)
