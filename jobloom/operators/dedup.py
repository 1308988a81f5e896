"""Newest row per key, and the upsert built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in ``order``.

    ``row_number() = 1`` plans as a group limit before and after the shuffle, so
    a key with very many rows sends at most one of them per map task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where("_rank = 1").drop("_rank")


def upsert_latest(batch: DataFrame, current: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row per key of both inputs; repeating a batch changes nothing."""
    return latest_per_key(current.unionByName(batch), keys, order)
