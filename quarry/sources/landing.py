"""Readers for landed API responses (one JSON document per line).

Fetching over HTTP is outside this library: a fetcher lands each response as
one line, wrapped with where it came from (``owner``, ``name``, ``resource``,
``page_no``, ``landed_at``). Everything after landing is a Spark job: files
are read in parallel, each page is one row, and items come out by ``explode``
without any shuffle.

Landing folders may be laid out as ``owner=<o>/name=<n>/...`` or
``landed_date=<d>/...`` directories: Spark's partition discovery turns them into
columns, the readers keep them, and a filter on one prunes whole folders
(SRC-10, FLT-8).

A line that is not the JSON it should be is kept as a row with ``corrupt`` set,
so that the load checks can fail on it; it is never skipped in silence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry import schemas


CORRUPT = "_corrupt"
DATA_KEYS = "data map<string, struct<nothing: boolean>>"


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def read_pages(spark: SparkSession, path: str, with_keys: bool = True) -> DataFrame:
    """Landed GraphQL pages (issues, pull requests, stargazers) as rows.

    With ``with_keys`` the top-level keys of ``data`` are kept as
    ``data_keys`` for the one-connection check (FLT-7); it costs a second,
    shallow parse of each line, so it can be turned off once a source is
    trusted.
    """
    raw = spark.read.text(path)
    folders = [c for c in raw.columns if c != "value"]
    parsed = F.from_json(
        "value", with_corrupt(schemas.PAGE), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ).alias("p")
    cols = [parsed, *folders]
    if with_keys:
        # The shallow parse skips what the keys hold; only where a key holds no object
        # (or there is no ``data``) is it copied out and parsed again.
        shallow = F.map_keys(F.from_json("value", DATA_KEYS)["data"])
        cols.append(F.coalesce(shallow, F.json_object_keys(F.get_json_object("value", "$.data"))).alias("data_keys"))
    fields = [F.col(c) if c in folders else F.col(f"p.{c}") for c in schemas.PAGE.names]
    more = [c for c in folders if c not in schemas.PAGE.names]
    return raw.select(*cols).select(
        *fields, *more, *(["data_keys"] if with_keys else []), F.col(f"p.{CORRUPT}").isNotNull().alias("corrupt")
    )


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Landed comment-reaction responses: ``data`` is alias -> node."""
    reader = spark.read.schema(with_corrupt(schemas.BUNDLE_PAGE)).option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.json(path)
    return rows.withColumn("corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def read_events(spark: SparkSession, path: str, landed_since: str | None = None) -> DataFrame:
    """Landed REST event pages, one page (a JSON array) or one event per line.

    A line holding an array gives one row per element and ``[]`` gives none;
    ``_metadata.file_path`` tells which landed file an event came from. With
    ``landed_date=<d>`` folders, ``landed_since`` opens only those of that day or
    later: an event is never landed before it was created, so a load needs no
    folder older than its cursor. A line that is not JSON is a row with ``corrupt``
    set and its text in ``corrupt_line``.
    """
    reader = spark.read.schema(with_corrupt(schemas.EVENT)).option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.json(path)
    if landed_since is not None:
        rows = rows.where(F.col("landed_date") >= F.lit(landed_since).cast("date"))
    return marked_events(rows)


def marked_events(rows: DataFrame) -> DataFrame:
    """Event rows with the file they came from and the mark and text of a broken line."""
    return (
        rows.select("*", F.col("_metadata.file_path").alias("page_path"))
        .withColumn("corrupt", F.col(CORRUPT).isNotNull())
        .withColumnRenamed(CORRUPT, "corrupt_line")
    )


def page_items(pages: DataFrame, resource: str) -> DataFrame:
    """One row per item (issue, pull request) with its page and list position.

    SRC-1/SRC-2/MAP-2: the single connection under ``data.repository``.
    """
    conn = schemas.CONNECTIONS[resource]
    return pages.select(
        "owner",
        "name",
        "page_no",
        list_offset(pages).alias("list_offset"),
        F.posexplode(f"data.repository.{conn}.nodes").alias("item_idx", "item"),
    )


def list_offset(rows: DataFrame) -> Column:
    """Position of the first child in a row's child lists (0 unless it continues a page)."""
    return F.coalesce(F.col("list_offset"), F.lit(0)) if "list_offset" in rows.columns else F.lit(0).cast("long")


def page_list(pages: DataFrame, resource: str) -> str:
    """SRC-8: the list field of a connection, ``nodes`` or else ``edges``."""
    conn = schemas.CONNECTIONS[resource]
    fields = {f.name for f in pages.schema["data"].dataType["repository"].dataType[conn].dataType.fields}
    return f"data.repository.{conn}." + ("nodes" if "nodes" in fields else "edges")


def land_json(pages: DataFrame, path: str, folders: tuple[str, ...] = ()) -> str:
    """Write page rows as landed JSON lines (what a fetcher leaves behind), gzipped."""
    writer = pages.drop("data_keys").write.mode("errorifexists").option("compression", "gzip")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.json(path)
    return path
