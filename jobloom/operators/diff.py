"""Comparison of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_diff(a: DataFrame, b: DataFrame, ignore: Sequence[str] = (), all_rows: bool = False) -> DataFrame:
    """One row with ``row_count_stable``, ``only_in_a`` and ``only_in_b``.

    Counts distinct rows of one side that the other lacks, like EXCEPT; with
    ``all_rows`` repeated rows count each time, like EXCEPT ALL.  Both directions
    and the row counts come from one grouping of the union, which folds repeats
    before the shuffle.
    """
    columns = [c for c in a.columns if c not in ignore]
    sides = (
        a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
        .unionByName(b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        .groupBy(*columns)
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )
    if all_rows:
        surplus = F.col("_a") - F.col("_b")
        zero = F.lit(0).cast("bigint")
        only_a = F.sum(F.greatest(surplus, zero))
        only_b = F.sum(F.greatest(-surplus, zero))
    else:
        only_a, only_b = F.count_if(F.col("_b") == 0), F.count_if(F.col("_a") == 0)
    nothing = F.lit(0).cast("bigint")
    return sides.agg(
        F.coalesce(F.sum("_a") == F.sum("_b"), F.lit(True)).alias("row_count_stable"),
        F.coalesce(only_a, nothing).alias("only_in_a"),
        F.coalesce(only_b, nothing).alias("only_in_b"),
    )


def _part(key: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def digests(df: DataFrame, key: Sequence[str], parts: int = 256, ignore: Sequence[str] = ()) -> DataFrame:
    """Q8: what a table holds, as a row per part: ``part``, ``row_count``, ``low``, ``high``.

    A part is a hash range of ``key``.  Both sums of row hashes are the same in whatever order and layout the rows lie,
    so stored digests prove a rerun without the rows before it.  Rows that occur twice count twice.  The map side folds
    each part to a row, so the shuffle has at most ``parts`` rows per task.
    """
    columns = sorted(c for c in df.columns if c not in ignore)
    # The hash skips nulls, so which columns are null is hashed along.
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)"))
    return (
        df.groupBy(_part(key, parts).alias("part"))
        .agg(F.count(F.lit(1)).alias("row_count"), wide("low").alias("low"), wide("high").alias("high"))
    )


def differing_parts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q8: the parts whose digests differ, those that one side lacks included."""
    state = lambda df, name: df.select("part", F.struct("row_count", "low", "high").alias(name))
    met = state(a, "_a").join(state(b, "_b"), "part", "full_outer")
    return met.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("part")


def located_changes(
    a: DataFrame, b: DataFrame, parts_of: DataFrame, key: Sequence[str], parts: int = 256, ignore: Sequence[str] = ()
) -> DataFrame:
    """Q8: the rows that differ, read from the differing parts alone: all compared columns, ``only_in_a``, ``only_in_b``.

    The two counts say how many more times a side has the row.  Rows of other parts are left out before the shuffle.
    """
    columns = [c for c in a.columns if c not in ignore]
    sides = []
    for df, name in ((a, "_a"), (b, "_b")):
        mine = df.withColumn("part", _part(key, parts)).join(parts_of, "part", "left_semi")
        sides.append(mine.select(*columns, *[F.lit(int(n == name)).alias(n) for n in ("_a", "_b")]))
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    more = lambda x, y: F.greatest(F.col(x) - F.col(y), F.lit(0).cast("bigint"))
    return counted.where("_a <> _b").select(*columns, more("_a", "_b").alias("only_in_a"), more("_b", "_a").alias("only_in_b"))
