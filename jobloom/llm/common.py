"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.session import shared_dir

#: ASCII white space as the contracts name it, as a character class body.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run inside; what stood there before comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def slices(batches: Iterator, text_of: Callable, most: int = 8 << 20) -> Iterator:
    """Arrow batches cut to about ``most`` bytes of the text column, so that few Python strings exist at a time."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.binary_length(text_of(batch)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:], strict=False):
            if i < j:
                yield batch.slice(i, j - i)


def word_count(text: str | Column) -> Column:
    """Number of runs of non-blank characters; null counts as zero."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANK}]+")), F.lit(0)).cast("long")
