"""Versioned tables on Parquet, run ledger, schema conformance (SNK-1..6, WIN-3, LIF-2).

Plain Parquet has no transactions.  Every change is a numbered commit of a
root folder: its data goes to ``<root>/<table>/commit=<n>``, and then one small
marker ``<root>/_commits/<n>`` is created, never overwritten or deleted.  The
largest complete marker is the state; it names the newest commit of every
snapshot table.  Append tables are all their commits up to the state's number.

A *merged* table is cut into key ranges of a fixed width.  A commit rewrites
the ranges its keys touch and leaves the files of the others alone; the state
names the newest commit of every range.  As keys are unique, a range holds at
most ``width`` rows, whatever the batches bring.  Narrow ranges are files of their
own only while they are few: beyond ``MAX_STORED`` of them, 2, 4, 8 ... neighbours
are stored together, up to ``FULL_WIDTH`` keys, so that the number of files follows
the rows and not the keys' spread.  A commit that joins them rewrites the table,
which happens once per doubling.

A job that fails before its marker leaves folders nobody reads; the retry gets
the same number and overwrites them, so a replay is harmless.  One writer
per root is expected; a second one fails when it creates the marker.
The markers go through the Hadoop FileSystem of the path, so the same code
works on HDFS or object stores.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LISTING_COLUMNS, RUN_EVENTS
from .tables import empty_table, materialize

COMMITS = "_commits"
#: State entry of the schemas that the commits of each table were written with.
SCHEMAS = "schemas"
#: Stored ranges of a merged table before neighbours are joined, and the most keys that joining makes of one.
MAX_STORED = 64
FULL_WIDTH = 1_000_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """(newest commit number or 0, its content)."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(folder):
        return 0, {}
    names = sorted((int(f.getPath().getName()) for f in fs.listStatus(folder)
                    if f.getPath().getName().isdigit()), reverse=True)
    for n in names:                       # a marker cut off while written is no commit
        jvm = spark.sparkContext._jvm
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, str(n)))
        try:
            text = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream)).readLine()
        finally:
            stream.close()
        try:
            return n, json.loads(text or "")
        except json.JSONDecodeError:
            continue
    return 0, {}


def range_of(key: str, width: int) -> Column:
    """Number of the key range that a key belongs to."""
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def touched_ranges(df: DataFrame, key: str, width: int) -> list[int]:
    """The key ranges of ``df``; as many numbers as ranges, not rows."""
    return sorted(r[0] for r in df.where(F.col(key).isNotNull()).select(range_of(key, width)).distinct().collect())


def outside(df: DataFrame, key: str, width: int, ranges: list[int]) -> DataFrame:
    """The rows whose key is in none of ``ranges``."""
    known = df.sparkSession.createDataFrame([(r,) for r in ranges], "_range long")
    return df.join(F.broadcast(known), range_of(key, width) == F.col("_range"), "left_anti")


def _shift(entry: dict, ranges: list[int]) -> int:
    """2 to the result is how many ranges are stored together once ``ranges`` are live too."""
    shift = entry.get("shift", 0)
    live, new = {int(r) for r in entry["live"]}, {r >> shift for r in ranges}
    while len(live | new) > MAX_STORED and (entry["width"] << shift + 1) <= FULL_WIDTH:
        shift += 1
        live, new = {r >> 1 for r in live}, {r >> 1 for r in new}
    return shift


class Commit:
    """The next commit of a root: write tables, then ``finish``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before, self.content = state(spark, root)
        self.number = self.before + 1
        fs, _ = _fs(spark, self.root)
        while fs.exists(_fs(spark, f"{self.root}/{COMMITS}/{self.number}")[1]):
            self.number += 1              # past markers that were cut off

    def snapshot(self, df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
        """The whole new content of ``table``."""
        self.append(df, table, partition_by)
        self.content = {**self.content, table: self.number}

    def append(self, df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
        """Rows added to an append table."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{table}/commit={self.number}")
        self._wrote_with(table, df.schema)

    def _wrote_with(self, table: str, schema: T.StructType) -> None:
        """Keep the schema with the state, if it is not that of the commit before."""
        known = self.content.get(SCHEMAS, {})
        text = schema.json()
        if not known.get(table) or known[table][-1][1] != text:
            self.content = {**self.content, SCHEMAS: {**known, table: [*known.get(table, []), [self.number, text]]}}

    def merge(self, df: DataFrame, table: str, key: str, width: int, ranges: list[int]) -> None:
        """The new content of some key ranges of a merged table, and of those that ``read`` gives with
        them; the other ranges are not touched."""
        entry = self.content.get(table) or {"width": width, "live": {}}
        if entry["width"] != width:
            raise ValueError(f"{table} has key ranges of {entry['width']}")
        shift, live = _shift(entry, ranges), {int(r): n for r, n in entry["live"].items()}
        replaced = {r >> shift for r in ranges}
        if wider := shift - entry.get("shift", 0):         # the stored ranges change: all are written again
            replaced, live = replaced | {r >> wider for r in live}, {}
        folder = f"{self.root}/{table}/commit={self.number}"
        rows = df.withColumn("range", F.shiftright(range_of(key, width), shift))
        rows.hint("rebalance", "range").write.mode("overwrite").partitionBy("range").parquet(folder)
        fs, path = _fs(self.spark, folder)
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        written = {int(n.split("=")[1]) for n in names if n.startswith("range=")}
        if not written <= replaced:
            raise ValueError(f"{table}: rows of ranges that the commit does not replace")
        live = {str(r): n for r, n in live.items() if r not in replaced}
        live |= {str(r): self.number for r in sorted(written)}
        stored = {"width": width, "shift": shift, "live": live} if shift else {"width": width, "live": live}
        self.content = {**self.content, table: stored}

    def read(self, table: str, schema: T.StructType, ranges: list[int] | None = None) -> DataFrame:
        """The table as this commit found or has made it.

        ``ranges`` reads some key ranges of a merged table: them and the ranges that are stored, or that
        a ``merge`` of them would store, with them."""
        entry = self.content.get(table)
        if ranges is not None and isinstance(entry, dict) and _shift(entry, ranges) > entry.get("shift", 0):
            ranges = None
        return _read_state(self.spark, self.root, self.content, table, schema, ranges)

    def append_numbered(self, df: DataFrame, table: str, id_col: str, order_by: list[str]) -> None:
        """SNK-3: rows added to an append table with ids that go on from the last commit's.

        Ids are dense and follow ``order_by``.  The rows are written once in
        ranges of the order; a part's first id comes from the counts of the
        parts before it (one small row per part), so no window sees the rows."""
        last = self.content.get(f"{table}.{id_col}", 0)
        ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        placed = materialize(ordered.withColumns({"_part": F.spark_partition_id(),
                                                  "_at": F.monotonically_increasing_id()}), "numbered")
        counts = sorted(tuple(r) for r in placed.groupBy("_part").count().collect())
        firsts, n = [], last
        for part, count in counts:
            firsts.append((part, n + 1))
            n += count
        starts = self.spark.createDataFrame(firsts, "_part int, _first long")
        at = F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)      # place within its part
        rows = placed.join(F.broadcast(starts), "_part")                      # a row per part
        self.append(rows.select((F.col("_first") + at).alias(id_col), *df.columns), table)
        self.note(f"{table}.{id_col}", n)

    def note(self, key: str, value) -> None:
        """A small fact kept with the state, e.g. the last batch of a stream."""
        self.content = {**self.content, key: value}

    def finish(self) -> int:
        fs, marker = _fs(self.spark, f"{self.root}/{COMMITS}/{self.number}")
        out = fs.create(marker, False)    # fails if another writer was first
        try:
            out.write(bytearray((json.dumps(self.content) + "\n").encode()))
        finally:
            out.close()
        return self.number


def _read_state(spark: SparkSession, root: str, content: dict, table: str, schema: T.StructType,
                ranges: list[int] | None = None) -> DataFrame:
    entry, folder = content.get(table), f"{root.rstrip('/')}/{table}"
    if entry is None:
        return empty_table(spark, schema)
    if isinstance(entry, int):
        return conform(spark.read.parquet(f"{folder}/commit={entry}"), schema)
    live = {int(r): n for r, n in entry["live"].items()}
    shift = entry.get("shift", 0)
    wanted = sorted(live if ranges is None else live.keys() & {r >> shift for r in ranges})
    if not wanted:
        return empty_table(spark, schema)
    wide = T.StructType([*schema.fields, T.StructField("commit", T.LongType()), T.StructField("range", T.LongType())])
    rows = (spark.read.schema(wide).option("basePath", folder)
            .parquet(*[f"{folder}/commit={live[r]}/range={r}" for r in wanted]))
    if ranges is not None:
        rows = rows.where(F.col("range").isin(wanted))
    return conform(rows.drop("commit", "range"), schema)


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType,
               ranges: list[int] | None = None) -> DataFrame:
    """SNK-6: the current snapshot or merged table, or an empty frame of ``schema`` if none.

    ``ranges`` reads some key ranges of a merged table only, and those stored with them."""
    return _read_state(spark, root, state(spark, root)[1], table, schema, ranges)


def range_width(spark: SparkSession, root: str, table: str) -> int | None:
    """Width of the key ranges of a merged table."""
    entry = state(spark, root)[1].get(table)
    return entry["width"] if isinstance(entry, dict) else None


def write_table(df: DataFrame, root: str, table: str,
                partition_by: list[str] | None = None) -> int:
    """SNK-2: commit a new snapshot; returns the commit's number."""
    commit = Commit(df.sparkSession, root)
    commit.snapshot(df, table, partition_by)
    return commit.finish()


def append_table(df: DataFrame, root: str, table: str) -> int:
    """SNK-3: commit rows added to an append table (quarantine, run events)."""
    commit = Commit(df.sparkSession, root)
    commit.append(df, table)
    return commit.finish()


def read_appended(spark: SparkSession, root: str, table: str, schema: T.StructType,
                  parts: T.StructType | None = None) -> DataFrame:
    """All committed rows of an append table (SNK-5: whatever schema they were written with).

    ``parts`` are partition columns of its folders, kept in the result.  Commits
    written with one schema are one scan; each is conformed to ``schema``, so a
    column that older files lack is NULL and a narrower type is widened."""
    n, content = state(spark, root)
    fs, p = _fs(spark, f"{root.rstrip('/')}/{table}")
    if n == 0 or not fs.exists(p):
        return empty_table(spark, T.StructType([*schema.fields, *(parts.fields if parts else [])]))
    extra = [*(parts.fields if parts else []), T.StructField("commit", T.LongType())]
    names = {f.name for f in extra}
    written = content.get(SCHEMAS, {}).get(table) or [[0, schema.json()]]
    out = None
    for (first, text), after in zip(written, [w[0] for w in written[1:]] + [n + 1]):
        own = T.StructType([f for f in T.StructType.fromJson(json.loads(text)).fields if f.name not in names])
        rows = (spark.read.schema(T.StructType([*own.fields, *extra])).parquet(f"{root.rstrip('/')}/{table}")
                .where(F.col("commit").between(first, after - 1)))
        rows = conform(rows, T.StructType([*schema.fields, *(parts.fields if parts else [])]))
        out = rows if out is None else out.unionByName(rows)
    return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SNK-5: additive schema migration: columns missing from older files
    are added as NULL, every column is cast to the target type (a value that
    does not fit becomes NULL), order fixed."""
    have = set(df.columns)
    return df.selectExpr(*[
        (f"TRY_CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in have
         else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`") for f in schema.fields])


def export_parquet(listings: DataFrame, path: str) -> bool:
    """SNK-1: the 28 declared columns; nothing is written for an empty table."""
    if listings.isEmpty():
        return False
    listings.select(*LISTING_COLUMNS).write.mode("overwrite").parquet(path)
    return True


# ---------------------------------------------------------------------------
# Run ledger (SNK-4, WIN-3, LIF-2): one appended event per state change.
# ---------------------------------------------------------------------------
def run_event(spark: SparkSession, run_id: int, status: str, at: dt.datetime,
              pages_fetched: int | None = None, listings_count: int | None = None) -> DataFrame:
    started = at if status == "running" else None
    finished = None if status == "running" else at
    return spark.createDataFrame(
        [(run_id, at, started, finished, pages_fetched, listings_count, status)], RUN_EVENTS)


def run_state(events: DataFrame) -> DataFrame:
    """Latest state per run: the newest event wins, and at equal timestamps
    a terminal event (completed/failed) wins over ``running``; ``started_at``
    comes from the run's first event (partial aggregates, no group is
    collected)."""
    order = F.struct(F.col("event_ts"), (F.col("status") != "running").cast("int"))
    return events.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max_by(F.struct("finished_at", "pages_fetched", "listings_count", "status"),
                 order).alias("s")).select(
        "run_id", "started_at", "s.finished_at", "s.pages_fetched", "s.listings_count", "s.status")


def last_run(events: DataFrame) -> DataFrame:
    """WIN-3: the most recent run (top-1 by id)."""
    return run_state(events).orderBy(F.desc("run_id")).limit(1)


def resume_page(events: DataFrame) -> DataFrame:
    """LIF-2: the page to resume from: last run's ``pages_fetched + 1``."""
    return last_run(events).select((F.coalesce(F.col("pages_fetched"), F.lit(0)) + 1)
                                   .alias("resume_page"))
