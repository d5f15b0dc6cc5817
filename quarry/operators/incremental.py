"""Incremental, duplicate-free loading of an event feed.

Rules (INC-1, INC-2, INC-4; the reference leaves the edges open, these are
our choices, see SURVEY §2.9):

* the cursor is the largest ``created_at`` loaded so far, starting at
  1970-01-01T00:00:00Z; it is fixed for the whole run;
* a row without an id or without a readable time, or of a line that is not JSON, is
  rejected with its reason and text;
* of rows of one id in a batch the earliest stays, the others are repeats;
* a row older than the cursor (less ``delay``) is late and kept aside, unless its id is
  stored already: then it is a repeat, whatever its age;
* rows at or after it are loaded unless their id is stored.

So loaded + late + repeated + rejected rows are the rows read, and a run says how many
there were of each.

Each run writes its rows, late rows, rejected rows, pulls and id filters into folders of
its own number, and then one ledger entry, which is the commit. A run that dies leaves
folders without an entry: nobody reads them and the next run removes them. A run
that comes again after its commit is known by its token and skipped.

What a run reads follows its batch: recent rows meet the table's folders from the cursor
on (a pushed filter and pruned date folders); the late ones meet the id filters of their
own days, and the table's folders of those days only where a filter says perhaps.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from quarry.functions.naming import flat_columns, readable_timestamp, snake
from quarry.functions.running import exclusive_running
from quarry.operators import id_index
from quarry.sinks.ledger import Folder, Ledger
from quarry.sinks.staging import stage_parquet

INITIAL_CURSOR = "1970-01-01T00:00:00Z"
_INITIAL = dt.datetime(1970, 1, 1)
#: Columns that say where a row came from; they are not stored with it.
LANDED = ("corrupt", "raw", "pull")
COUNTS = ("read", "loaded", "late", "repeated", "rejected")


def _ts(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal, exact to the microsecond and free of time zones."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def events_from_feed(feed: DataFrame, pull_col: str | None = None) -> DataFrame:
    """Landed REST events (text envelope) to typed rows.

    Envelope objects present in the feed (``actor``, ``repo``, ``org``) are
    flattened to ``actor__login``-style columns; ``payload`` stays packed JSON
    (see ``nested.unpacked``). ``created_date`` is kept for partition
    pruning of the cursor filter. A time that cannot be read is null. Of landed
    lines (``landing.read_events``) the mark of a broken one and its text come along,
    and with ``pull_col`` the landed file, folder or date as ``pull``.
    """
    ts = readable_timestamp(F.col("created_at"))
    envelope = []
    for obj in ("actor", "repo", "org"):
        if obj in feed.columns:
            envelope.extend(flat_columns(obj, feed.schema[obj].dataType))
    if "public" in feed.columns:
        envelope.append(F.col("public"))
    landed = []
    if "corrupt" in feed.columns:
        as_read = F.to_json(F.struct("id", "type", "created_at", "payload"))
        broken = F.col("corrupt_line") if "corrupt_line" in feed.columns else F.lit(None).cast("string")
        useless = F.col("id").isNull() | ts.isNull()
        landed = [F.col("corrupt"), F.when(F.col("corrupt"), broken).when(useless, as_read).alias("raw")]
    if pull_col:
        landed.append(F.col(pull_col).alias("pull"))
    return feed.select(
        F.col("id").cast("string").alias("id"),
        F.col("type"),
        ts.alias("created_at"),
        F.col("payload"),
        *envelope,
        ts.cast("date").alias("created_date"),
        *landed,
    )


@dataclass
class IncrementalTable:
    spark: SparkSession
    path: str
    key: str = "id"
    cursor_col: str = "created_at"
    partition_by: tuple[str, ...] = ("type", "created_date")
    delay: dt.timedelta = field(default_factory=dt.timedelta)
    day_col: str = "created_date"

    def __post_init__(self):
        self.path = self.path.rstrip("/")
        self.ledger = Ledger(self.spark, self.path + "__ledger")

    @property
    def late_path(self) -> str:
        return self.path + "__late"

    @property
    def rejected_path(self) -> str:
        return self.path + "__rejected"

    @property
    def ids_path(self) -> str:
        return self.path + "__ids"

    @property
    def pulls_path(self) -> str:
        return self.path + "__pulls"

    def cursor(self) -> dt.datetime:
        """INC-1: the stored cursor, or the initial value."""
        last = self.ledger.last()
        return dt.datetime.fromisoformat(last["cursor"]) if last else _INITIAL

    def runs(self) -> DataFrame:
        """One row per committed run: its number, cursor and counts."""
        return self.ledger.rows("number long, cursor string, " + ", ".join(f"{c} long" for c in COUNTS))

    def _committed(self, path: str, schema=None) -> DataFrame | None:
        """Rows of committed runs below ``path``, with their ``run``; None without any."""
        last = self.ledger.last_number()
        there = [int(n[4:]) for n in Folder(self.spark, path).names() if n.startswith("run=")]
        if min(there, default=last + 1) > last:
            return None
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        rows = reader.option("basePath", path).parquet(path)
        return rows if max(there) <= last else rows.where(F.col("run") <= last)

    @staticmethod
    def _with_run(fields: str) -> str:
        return f"{fields}, run long"

    def target(self, schema=None) -> DataFrame | None:
        """Loaded rows, in the columns of the newest run (or of ``schema``)."""
        if schema is None and (last := self.ledger.last()):
            schema = StructType.fromJson(json.loads(last["schema"]))
        rows = self._committed(self.path, None if schema is None else self._stored(schema).add("run", "long"))
        return None if rows is None else rows.drop("run")

    def late(self) -> DataFrame | None:
        """Late rows, each with the cursor it missed."""
        rows = self._committed(self.late_path)
        return None if rows is None else rows.drop("run")

    def rejected(self) -> DataFrame | None:
        """Rows that could not be loaded: ``reason`` and ``raw`` text beside what was read."""
        rows = self._committed(self.rejected_path)
        return None if rows is None else rows.drop("run")

    def pulls(self) -> DataFrame | None:
        """INC-5: pull, number of rows, oldest and newest time, of all committed runs."""
        rows = self._committed(self.pulls_path)
        return None if rows is None else rows.drop("run")

    def _stored(self, schema):
        """The columns that are stored, of a batch's schema."""
        kept = type(schema)()
        for f in schema.fields:
            if f.name not in LANDED:
                kept = kept.add(f)
        return kept

    def _reason(self, batch: DataFrame) -> Column:
        corrupt = F.coalesce(F.col("corrupt"), F.lit(False)) if "corrupt" in batch.columns else F.lit(False)
        return (
            F.when(corrupt, "line is not JSON")
            .when(F.col(self.key).isNull(), "no id")
            .when(F.col(self.cursor_col).isNull(), "no readable time")
        )

    def _earliest(self, batch: DataFrame) -> DataFrame:
        """Of the usable rows of one id the earliest, whatever order the batch comes in.

        A partial aggregate: a key that comes again and again shrinks before the shuffle.
        """
        stored = [f.name for f in self._stored(batch.schema).fields]
        order = F.struct(self.cursor_col, F.xxhash64(*stored).alias("_h"), F.struct(*stored).alias("row"))
        usable = batch.where(self._reason(batch).isNull())
        return usable.groupBy(self.key).agg(F.min(order).alias("_least")).select("_least.row.*")

    def new_rows(self, batch: DataFrame, cursor: dt.datetime) -> DataFrame:
        """INC-2: rows of ``batch`` to append under ``cursor``."""
        return self._unstored(self._earliest(batch), cursor - self.delay)

    def _unstored(self, rows: DataFrame, floor: dt.datetime) -> DataFrame:
        fresh = rows.where(F.col(self.cursor_col) >= _ts(floor))
        recent = self._recent(rows.schema, floor)
        return fresh if recent is None else fresh.join(recent.select(self.key), self.key, "left_anti")

    def _recent(self, schema, floor: dt.datetime) -> DataFrame | None:
        """Target rows at or after ``floor``: a pushed filter and pruned date folders."""
        rows = self.target(schema)
        if rows is None:
            return None
        recent = rows.where(F.col(self.cursor_col) >= _ts(floor))
        if self.day_col in schema.names:
            recent = recent.where(F.col(self.day_col) >= _ts(floor).cast("date"))
        return recent

    def _stored_late(self, late: DataFrame) -> DataFrame | None:
        """Ids of ``late`` rows that are stored already, loaded or late: asked of the id
        filters first, and of the folders of the days where a filter says perhaps."""
        index = self._committed(self.ids_path, self._with_run(id_index.SCHEMA))
        if index is None or self.day_col not in late.columns:
            return None
        days = id_index.days_of(late, self.day_col)
        index = id_index.on_days(index, "day", days)
        perhaps = stage_parquet(id_index.perhaps_stored(late, self.key, self.day_col, index), "perhaps_stored")
        days = id_index.days_of(perhaps, self.day_col)
        if not days and days is not None:
            return None
        found = None
        schema = f"{self.key} string, {self.day_col} date"
        for path in (self.path, self.late_path):
            there = self._committed(path, self._with_run(schema))
            if there is not None:
                ids = id_index.on_days(there, self.day_col, days).select(self.key)
                found = ids if found is None else found.unionByName(ids)
        return perhaps.join(found, self.key, "left_semi").select(self.key)

    def load(self, batch: DataFrame, token: str | None = None) -> dict:
        """Load one batch as the next run; returns its counts and cursors.

        A batch with the ``token`` of the newest run is that run come again: it is
        skipped and the run's counts are returned.
        """
        last = self.ledger.last()
        if token is not None and last is not None and last["token"] == token:
            return self._result(last)
        number = 0 if last is None else last["number"] + 1
        for path in (self.path, self.late_path, self.rejected_path, self.ids_path, self.pulls_path):
            Folder(self.spark, path).delete(f"run={number}")  # of a run that died
        before = self.cursor()
        floor = before - self.delay
        is_late = F.col(self.cursor_col) < _ts(floor)
        batch = stage_parquet(batch, "batch")
        reason = self._reason(batch)
        n_read, n_rejected, newest = batch.agg(
            F.count(F.lit(1)), F.count_if(reason.isNotNull()), F.max(F.when(reason.isNull(), F.col(self.cursor_col)))
        ).first()
        if n_rejected:
            given = [c for c in batch.columns if c not in LANDED]
            raw = F.col("raw") if "raw" in batch.columns else F.to_json(F.struct(*given))
            kept = batch.select(*given, *(["pull"] if "pull" in batch.columns else []), reason.alias("reason"), raw.alias("raw"))
            self._write(kept.where("reason IS NOT NULL"), self.rejected_path, number)
        if "pull" in batch.columns:
            self._write(pull_summary(batch, [], "pull", self.cursor_col), self.pulls_path, number)
        rows = stage_parquet(self._earliest(batch), "batch_rows")
        # rebalance: rows of one (type, day) go to few tasks -> few files, and
        # AQE splits an oversized partition instead of one task writing it all
        new = self._unstored(rows, floor).hint("rebalance", *self.partition_by)
        n_loaded = self._write(new, self.path, number, self.partition_by)
        late, n_late = rows.where(is_late), 0
        if not late.isEmpty():
            stored = self._stored_late(late)
            late = late if stored is None else late.join(stored, self.key, "left_anti")
            days = (self.day_col,) if self.day_col in late.columns else ()
            n_late = self._write(late.withColumn("missed_cursor", _ts(before)), self.late_path, number, days)
        if self.day_col in rows.columns and n_loaded + n_late:
            kept = [self.spark.read.schema(rows.schema).parquet(f"{self.path}/run={number}")]
            if n_late:
                kept.append(self.spark.read.schema(rows.schema).parquet(f"{self.late_path}/run={number}"))
            ids = reduce(DataFrame.unionByName, [k.select(self.key, self.day_col) for k in kept])
            self._write(id_index.filters_of(ids, self.key, self.day_col), self.ids_path, number, ("day",))
        # What is loaded already is not newer than the cursor, so the batch alone tells.
        after = max(before, newest) if newest is not None else before
        entry = {
            "cursor": after.isoformat(),
            "cursor_before": before.isoformat(),
            "read": n_read,
            "loaded": n_loaded,
            "late": n_late,
            "repeated": n_read - n_rejected - n_loaded - n_late,
            "rejected": n_rejected,
            "schema": rows.schema.json(),
            "token": token,
        }
        self.ledger.append(number, entry)
        return self._result(entry)

    @staticmethod
    def _result(entry: dict) -> dict:
        return {
            "cursor_before": dt.datetime.fromisoformat(entry["cursor_before"]),
            "cursor_after": dt.datetime.fromisoformat(entry["cursor"]),
            "late_rows": entry["late"],
            **{c: entry[c] for c in COUNTS},
        }

    def _write(self, rows: DataFrame, path: str, number: int, partition_by: tuple[str, ...] = ()) -> int:
        """Into the run's own folder; the number of rows, counted while they are written."""
        written = Observation()
        counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/run={number}")
        return written.get["n"]


def pull_summary(events: DataFrame, repo_cols: list[str], pull_col: str, time_col: str = "created_at") -> DataFrame:
    """What each pull brought: number of rows, oldest and newest time."""
    return events.groupBy(*repo_cols, pull_col).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min(time_col).alias("oldest"),
        F.max(time_col).alias("newest"),
    )


def gaps_between(per_pull: DataFrame, repo_cols: list[str], pull_col: str, cap: int = 300) -> DataFrame:
    """INC-5: flag pulls that may have missed events.

    A pull returns at most ``cap`` events, newest first. If it is full and its
    oldest event is newer than everything loaded by earlier pulls, events in
    between may never have been fetched. One row per pull; the running maximum
    over earlier pulls is the blocked one, so a long pull history is not one
    task. ``pull_col`` is an integer or a date.
    """
    is_date = isinstance(per_pull.schema[pull_col].dataType, DateType)
    ordered = per_pull.withColumn("_ord", F.unix_date(pull_col) if is_date else F.col(pull_col))
    prev = exclusive_running(ordered, repo_cols, "_ord", "newest", "prev_cursor", how="max")
    return prev.select(
        *repo_cols,
        pull_col,
        "n_events",
        "oldest",
        "newest",
        "prev_cursor",
        F.coalesce((F.col("n_events") >= cap) & (F.col("oldest") > F.col("prev_cursor")), F.lit(False)).alias(
            "possible_gap"
        ),
    )


def pull_gaps(pulls: DataFrame, repo_cols: list[str], pull_col: str, cap: int = 300) -> DataFrame:
    """``gaps_between`` of event rows that carry their pull."""
    return gaps_between(pull_summary(pulls, repo_cols, pull_col), repo_cols, pull_col, cap)


MICROS_PER_BLOCK = 3_600 * 1_000_000


def covered_intervals(per_pull: DataFrame, repo_cols: list[str]) -> DataFrame:
    """Stretches of time that pulls cover without a break, merged from the pulls'
    [oldest, newest]: one row each, with its pulls and events and ``gap_from``, the end of
    what was covered before it (null for the first stretch).

    A stretch begins where the oldest event is later than all that is covered before
    it. Pulls of one oldest event are one interval first, so that the order is strict;
    the running maximum and count are the blocked ones, by the hour of the oldest.
    """
    since = F.to_timestamp_ntz(F.lit("1970-01-01"))
    intervals = (
        per_pull.where(F.col("oldest").isNotNull())
        .groupBy(*repo_cols, "oldest")
        .agg(F.max("newest").alias("newest"), F.count(F.lit(1)).alias("n_pulls"), F.sum("n_events").alias("n_events"))
        .withColumn("_ord", F.timestamp_diff("MICROSECOND", since, F.col("oldest")))
    )
    reached = exclusive_running(intervals, repo_cols, "_ord", "newest", "_reach", how="max", block=MICROS_PER_BLOCK)
    starts = reached.withColumn("_starts", F.when(F.col("_reach") >= F.col("oldest"), 0).otherwise(1))
    numbered = exclusive_running(starts, repo_cols, "_ord", "_starts", "_earlier", block=MICROS_PER_BLOCK)
    merged = numbered.groupBy(*repo_cols, (F.col("_earlier") + F.col("_starts")).alias("stretch")).agg(
        F.min("oldest").alias("oldest"),
        F.max("newest").alias("newest"),
        F.sum("n_pulls").alias("n_pulls"),
        F.sum("n_events").alias("n_events"),
        F.max(F.when(F.col("_starts") == 1, F.col("_reach"))).alias("gap_from"),
    )
    return merged.select(*repo_cols, "stretch", "oldest", "newest", "n_pulls", "n_events", "gap_from")


def split_by_type(events: DataFrame, types: list[str] | None = None) -> dict[str, DataFrame]:
    """SNK-3 read side: one DataFrame per event type over the type-partitioned
    table; each is a pruned scan of its own folder."""
    if types is None:
        types = [r[0] for r in events.select("type").distinct().collect()]
    kind = F.col("type")
    return {t: events.where(kind.isNull() if t is None else kind == t) for t in types}


def register_type_views(events: DataFrame, types: list[str], prefix: str = "repo_events") -> list[str]:
    """SNK-3: a temporary view per event type over the type-partitioned table
    (``<prefix>_<type>``, snake-cased); each view scans only its folder."""
    names = []
    for t, df in split_by_type(events, types).items():
        name = f"{prefix}_{snake(t) if t is not None else 'untyped'}"
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
