"""Stored tables: versions behind views, history by runs, daily tables by day.

A name that readers use is a view.  Its rows lie in catalog tables beside it, and replacing the view, one catalog call,
is what makes a finished build visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.operators.scd import scd2_changes, snapshot_input
from jobloom.schemas import POSTING_KEY, SNAPSHOT
from jobloom.session import setting, shared_dir

VERSION, PREVIOUS, RUN, SPAN = "jobloom.version", "jobloom.previous", "jobloom.run", "jobloom.span"
OPEN, CLOSED = "open", "closed"


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property of the view ``name``; null without the view or the property."""
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).first()
    return row and row["value"]


def version_of(spark: SparkSession, name: str) -> str | None:
    """The catalog table that the view ``name`` shows."""
    return _property(spark, name, VERSION)


def _create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0] or 'default'}")


def write_version(
    df: DataFrame,
    name: str,
    buckets: int | None = None,
    keys: Sequence[str] = POSTING_KEY,
    partition_by: Sequence[str] = (),
) -> str:
    """Action: ``df`` as a new catalog table beside ``name``, which no reader sees yet; returns its name."""
    spark = df.sparkSession
    _create_database(spark, name)
    version = f"{name}__{uuid.uuid4().hex}"
    if buckets is not None:
        df = df.repartition(buckets, *keys)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)  # a folder's rows in few files, a large folder over several tasks
    writer = df.write.format("parquet").option("compression", "zstd")
    if buckets is not None:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)
    return version


def publish(
    spark: SparkSession, name: str, version: str, columns: Sequence[str] | None = None, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """Action: the view ``name`` shows ``version`` from now on, in the order of ``columns``.

    The version before stays for readers that have begun; older ones, and those of builds that died, are dropped.
    """
    before = version_of(spark, name)
    shown = ", ".join(f"`{c}`" for c in columns or spark.table(version).columns)
    properties = {**(properties or {}), VERSION: version} | ({PREVIOUS: before} if before else {})
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT {shown} FROM {version}")
    database, _, short = name.rpartition(".")
    for row in spark.sql(f"SHOW TABLES IN {database or 'default'} LIKE '{short}__*'").collect():
        other = f"{database}.{row['tableName']}" if database else row["tableName"]
        if other.lower() not in (version.lower(), (before or "").lower()):
            spark.sql(f"DROP TABLE IF EXISTS {other}")
    return spark.table(name)


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "table",
    buckets: int | None = None,
    keys: Sequence[str] = POSTING_KEY,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """S13 (action for tables): the data under ``name``, and a DataFrame reading it.

    Readers see the old rows or the new ones; a build that dies loses nothing, and a table may be built from itself.
    ``buckets`` stores the rows hashed and sorted by ``keys``: later joins on the keys need no shuffle;
    ``partition_by`` makes folders that a filter on those columns prunes.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError("kind must be 'table' or 'view'")
    return publish(spark, name, write_version(df, name, buckets, keys, partition_by), df.columns)


# --- history ------------------------------------------------------------------------


def _runs(spark: SparkSession, store: str) -> list[dict[str, str]]:
    """The folders of a history: a row per run and kind of version, a few bytes each."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {store}").collect()]
    return [dict(part.split("=", 1) for part in n.split("/")) for n in names]


def open_versions(spark: SparkSession, name: str) -> DataFrame | None:
    """The versions of the history ``name`` that no run has closed; reads one folder."""
    run = _property(spark, name, RUN)
    if run is None:
        return None
    store = spark.table(f"{name}_runs")
    return store.where((F.col("run") == run) & (F.col("part") == OPEN)).select(*SNAPSHOT.fieldNames())


def observe_run(silver: DataFrame, name: str, run_ts: datetime, buckets: int | None = None) -> DataFrame:
    """C2 (action): adds one observation of ``silver`` to the stored history ``name``; returns the history.

    A run reads and writes the open versions and writes those it closes, into folders of its own; what earlier runs have
    closed is neither read nor written, and a run that closes nothing adds no closed file.  Replacing the view ends a
    run.  Folders of a run that died before are cleared first.  The open folder of the run before stays for readers that
    have begun.  Runs go forward in time.
    """
    spark, store = silver.sparkSession, f"{name}_runs"
    _create_database(spark, name)
    run, last = run_ts.strftime("%Y%m%dT%H%M%S%f"), _property(spark, name, RUN)
    if last is not None and run <= last:
        raise ValueError(f"{name} has been observed at {last} already")
    if spark.catalog.tableExists(store):
        for folder in _runs(spark, store):
            # Later than the last finished run: left by one that died.  Open versions before it: seen by nobody now.
            if last is None or folder["run"] > last or (folder["part"] == OPEN and folder["run"] < last):
                spark.sql(f"ALTER TABLE {store} DROP IF EXISTS PARTITION (run = '{folder['run']}', part = '{folder['part']}')")
    columns = SNAPSHOT.fieldNames()
    before = open_versions(spark, name)
    if before is None:
        before = spark.createDataFrame([], SNAPSHOT)
    versions = scd2_changes(before, snapshot_input(silver), run_ts).select(*columns).withColumns(
        {"run": F.lit(run), "part": F.when(F.col("valid_to").isNull(), OPEN).otherwise(CLOSED)}
    )
    if buckets is not None:
        versions = versions.repartition(buckets, *POSTING_KEY)
    if spark.catalog.tableExists(store):
        versions.write.insertInto(store)
    else:
        writer = versions.write.format("parquet").option("compression", "zstd").partitionBy("run", "part")
        if buckets is not None:
            writer = writer.bucketBy(buckets, *POSTING_KEY).sortBy(*POSTING_KEY)
        writer.saveAsTable(store)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{RUN}' = '{run}') AS SELECT {', '.join(columns)} FROM {store} "
        f"WHERE part = '{CLOSED}' AND run <= '{run}' OR part = '{OPEN}' AND run = '{run}'"
    )
    return spark.table(name)


# --- daily tables -------------------------------------------------------------------

_BUILD, _SPAN, _FOLDER = "_build", "_span", "_folder"
#: A table of more days than this gets a folder per span of equally many days.
MOST_FOLDERS = 1_000
_WIDTHS = [4**k for k in range(1, 14)]


def _folder_of(at: str | Column, width: int | None) -> Column:
    """The folder of a day: the day itself, or the number of its span."""
    at = F.col(at) if isinstance(at, str) else at
    return at if width is None else F.floor(F.unix_date(at.cast("date")) / width)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Action: rows computed once, in the cluster's shared folder."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _span_width(rows: DataFrame, day: str) -> int | None:
    """Action: days per folder, the least width that needs at most ``MOST_FOLDERS``; None for a folder per day."""
    days = rows.select(day).distinct()
    counted = [F.count_distinct(_folder_of(day, w)).alias(f"w{w}") for w in _WIDTHS]
    found = days.agg(F.count(F.lit(1)).alias("n"), *counted).first()
    if found.n <= MOST_FOLDERS:
        return None
    return next((w for w in _WIDTHS if found[f"w{w}"] <= MOST_FOLDERS), _WIDTHS[-1])


@contextmanager
def _many_folders(spark: SparkSession) -> Iterator[None]:
    """A folder costs the same however few rows it has, so small shuffle partitions are not joined to one writing task."""
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        yield


def build_daily(df: DataFrame, name: str, day: str) -> DataFrame:
    """Action: the whole table ``name``, a folder per ``day``, or per span of days when there are very many.

    The rows are computed once, and their days counted before folders are made of them.
    """
    spark = df.sparkSession
    marked = _stored(df.withColumn(_BUILD, F.lit(uuid.uuid4().hex)), "daily")
    width = _span_width(marked, day)
    folder = day if width is None else _SPAN
    with _many_folders(spark):
        version = write_version(marked.withColumn(folder, _folder_of(day, width)), name, partition_by=[folder])
    return publish(spark, name, version, df.columns, None if width is None else {SPAN: str(width)})


def read_since(spark: SparkSession, name: str, day: str, since: date) -> DataFrame:
    """The rows of the daily table ``name`` from ``since`` on; of its folders only those of these days are read."""
    from_day, span = F.lit(since), _property(spark, name, SPAN)
    recent = F.col(day) >= from_day.cast("timestamp_ntz")
    if span is None:
        return spark.table(name).where(recent)
    in_folders = F.col(_SPAN) >= _folder_of(from_day, int(span))
    return spark.table(version_of(spark, name)).where(in_folders & recent).select(*spark.table(name).columns)


def rebuild_days(
    source: DataFrame, days: DataFrame, at: Column, compute: Callable[[DataFrame], DataFrame], name: str, day: str
) -> DataFrame:
    """Action: the folders of ``days`` (one column, ``day``) of the daily table ``name``, computed anew.

    ``compute`` makes the table's rows of a day from the rows of ``source`` on that day by ``at``.  Only the rows of those
    folders are read on, and only those folders are written; a folder that has lost all its rows goes.  Repeating the
    call gives the same rows.  A table that outgrows a folder per day is built whole, in spans, once.
    """
    spark, stored = source.sparkSession, version_of(source.sparkSession, name)
    span = _property(spark, name, SPAN)
    width, folder = (None, day) if span is None else (int(span), _SPAN)
    folders = _stored(days.select(_folder_of(day, width).alias(_FOLDER)).distinct(), "days")
    if width is None:
        there = spark.table(stored).select(F.col(day).alias(_FOLDER))
        if there.union(folders).distinct().count() > MOST_FOLDERS:
            return build_daily(compute(source), name, day)
    mine = source.withColumn("_on", _folder_of(at, width)).join(folders, F.col("_on").eqNullSafe(F.col(_FOLDER)), "left_semi").drop("_on")
    build = uuid.uuid4().hex
    rows = _stored(compute(mine).withColumn(_BUILD, F.lit(build)), "daily").withColumn(folder, _folder_of(day, width))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), _many_folders(spark):
        rows.select(*spark.table(stored).columns).hint("rebalance", folder).write.insertInto(stored, overwrite=True)
    left = spark.table(stored).where(F.col(_BUILD) != build).join(folders, F.col(folder).eqNullSafe(F.col(_FOLDER)), "left_semi")
    for row in left.select(F.col(folder).cast("string").alias("folder")).distinct().collect():  # at most one row per folder
        value = "null" if row.folder is None else f"'{row.folder}'"
        spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS PARTITION ({folder} = {value})")
    spark.catalog.refreshTable(stored)
    return spark.table(name)
