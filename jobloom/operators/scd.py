"""Slowly changing history of postings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.schemas import POSTING_KEY, VERSIONED_COLUMNS

OBSERVED = "snapshot_observed_at"


def snapshot_input(silver: DataFrame) -> DataFrame:
    """The columns a snapshot keeps of a silver posting."""
    return silver.select(
        *POSTING_KEY, "slug", "title", "company_name", "remote", "location", F.col("last_seen_at").alias(OBSERVED)
    )


def scd2_from_history(
    log: DataFrame,
    keys: Sequence[str] = POSTING_KEY,
    check_cols: Sequence[str] = VERSIONED_COLUMNS,
    order: Sequence[str] = (OBSERVED,),
    grain: str = "week",
    ranges: int | None = None,
) -> DataFrame:
    """Every version of every key, from a log of observations.

    A version opens at the first row and wherever a checked column changes; it
    ends where the next one opens.  ``order`` starts with the observation time,
    later columns break ties; columns of ``order`` outside the log's own set stay
    in the result.

    The history of a key is cut into chunks, each a stretch of ``order``: changes
    inside a chunk are found first, and only each chunk's first and last kept row
    meet in a second, per-key window.  Chunks are time units of ``grain``, which
    should hold many observations of a key: a week of observations every quarter
    of an hour is 672 rows, of which two and the changes go on.  With ``ranges`` they are that many sampled ranges
    over keys and order, for logs in which one key repeats a single timestamp
    very often.
    """
    at = order[0]
    if ranges is None:
        chunked = log.withColumn("_chunk", F.date_trunc(grain, F.col(at)))
    else:
        chunked = log.repartitionByRange(ranges, *keys, *order).withColumn("_chunk", F.spark_partition_id())

    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    whole_chunk = Window.partitionBy(*keys, "_chunk")
    state = F.col("_state")
    inside = (
        chunked.withColumn("_state", F.struct(*check_cols))
        .withColumns(
            {
                "_before": F.lag("_state").over(in_chunk),
                "_chunk_end": F.last("_state").over(
                    in_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                ),
            }
        )
        .withColumn("_head", F.col("_before").isNull())
        .withColumn("_changed", ~F.col("_head") & ~F.col("_before").eqNullSafe(state))
        .withColumn("_first_change", F.min(F.when(F.col("_changed"), F.col(at))).over(whole_chunk))
        .where(F.col("_head") | F.col("_changed"))
        .withColumn("_next", F.lead(at).over(in_chunk))
    )

    # Heads and last kept rows of all chunks of a key meet; the rest keep their chunk.
    edge = F.col("_head") | F.col("_next").isNull()
    across = [*keys, "_group"]
    forward = Window.partitionBy(*across).orderBy(*order)
    backward = Window.partitionBy(*across).orderBy(*[F.col(c).desc() for c in order])
    opens = F.when(F.col("_head"), F.when(F.col("_changed"), F.col(at)).otherwise(F.col("_first_change")))
    joined = (
        inside.withColumn("_group", F.when(~edge, F.col("_chunk")))
        .withColumn("_before", F.lag("_chunk_end").over(forward))
        .withColumn("_changed", F.when(F.col("_head"), ~F.col("_before").eqNullSafe(state)).otherwise(F.col("_changed")))
        .withColumn("_opens", opens)
        .withColumn(
            "_later",
            F.last("_opens", ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .where("_changed")
    )
    return joined.select(
        *log.columns,
        F.col(at).alias("valid_from"),
        F.coalesce("_next", "_later").alias("valid_to"),
    )


def _side(prefix: str, columns: Sequence[str], valid_from: Column, valid_to: Column) -> Column:
    return F.struct(
        *[F.col(f"{prefix}.{c}").alias(c) for c in columns],
        valid_from.cast("timestamp_ntz").alias("valid_from"),
        valid_to.cast("timestamp_ntz").alias("valid_to"),
    )


def scd2_changes(
    still_open: DataFrame,
    current: DataFrame,
    run_ts: datetime,
    keys: Sequence[str] = POSTING_KEY,
    check_cols: Sequence[str] = VERSIONED_COLUMNS,
) -> DataFrame:
    """The open versions after observing ``current`` at ``run_ts``, and those the observation closes.

    New key: a version opens.  Checked column changed: the open version closes and
    a new one opens.  Unchanged: the version stays as it is.  Missing key: its
    version stays open.  Both sides have one row per key; where both are stored in
    equal buckets of the keys the join shuffles neither.
    """
    columns = [c for c in still_open.columns if c not in ("valid_from", "valid_to")]
    no_time, run = F.lit(None), F.lit(run_ts)

    h = still_open.withColumn("_known", F.lit(True)).alias("h")
    c = current.select(*columns).withColumn("_seen", F.lit(True)).alias("c")
    match = [F.col(f"h.{k}") == F.col(f"c.{k}") for k in keys]
    same = F.lit(True)
    for name in check_cols:
        same = same & F.col(f"h.{name}").eqNullSafe(F.col(f"c.{name}"))

    kept = _side("h", columns, F.col("h.valid_from"), no_time)
    ended = _side("h", columns, F.col("h.valid_from"), run)
    opened = _side("c", columns, run, no_time)
    versions = (
        F.when(F.col("h._known").isNull(), F.array(opened))
        .when(F.col("c._seen").isNull() | same, F.array(kept))
        .otherwise(F.array(ended, opened))
    )
    return h.join(c, match, "full_outer").select(F.inline(versions))


def scd2_apply(
    history: DataFrame,
    current: DataFrame,
    run_ts: datetime,
    keys: Sequence[str] = POSTING_KEY,
    check_cols: Sequence[str] = VERSIONED_COLUMNS,
) -> DataFrame:
    """The whole history after observing ``current`` at ``run_ts`` (``scd2_changes``).

    Closed versions, the bulk of a long history, bypass the join.
    """
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    closed = history.where(F.col("valid_to").isNotNull())
    touched = scd2_changes(history.where(F.col("valid_to").isNull()), current, run_ts, keys, check_cols)
    return closed.select(*columns, "valid_from", "valid_to").unionByName(touched)


def scd2_as_of(history: DataFrame, ts: datetime | Column) -> DataFrame:
    """The version of every key that was valid at ``ts``."""
    moment = (ts if isinstance(ts, Column) else F.lit(ts)).cast("timestamp_ntz")
    ends_later = F.col("valid_to").isNull() | (moment < F.col("valid_to"))
    return history.where((F.col("valid_from") <= moment) & ends_later)
