"""Writing tables: full replace, append, schema-per-database, contracts, stats.

Tables are external Parquet tables under a warehouse root (a shared folder on
a cluster). A replace writes a fresh version, and a commit says which versions a
database consists of: one manifest of all its tables, written as one ledger entry. So a
job may read the old version of the very table it replaces, several tables are
swapped at once, and a load that dies leaves the whole old set in place.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType,
    StructField, StructType, TimestampNTZType,
)

from quarry.sinks.ledger import Folder, Ledger


class ContractError(ValueError):
    pass


def enforce_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """SNK-8: exactly the declared columns, in order, cast to the declared types.

    A missing or extra column is an error; casts run under the session's ANSI
    setting, so a value that does not fit fails the job instead of turning NULL.
    Column descriptions travel as field metadata (``comment``).
    """
    have = df.columns
    want = [f.name for f in contract.fields]
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    if missing or extra:
        raise ContractError(f"contract mismatch: missing={missing} extra={extra}")
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in contract.fields]
    )


def _comment(field: StructField) -> str:
    text = field.metadata.get("comment", "")
    return " COMMENT '" + text.replace("'", "\\'") + "'" if text else ""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Types a column may grow to, each holding every value of the one before it.
WIDER = (
    (ByteType, ShortType, IntegerType, LongType),
    (ByteType, ShortType, IntegerType, DoubleType),
    (FloatType, DoubleType),
    (DateType, TimestampNTZType),
)


def widened(old: DataType, new: DataType, where: str) -> DataType:
    """The contract's type for values of ``new`` where it said ``old``.

    A wider type widens the contract; a narrower or other one is refused.
    """
    if isinstance(old, StructType) and isinstance(new, StructType):
        return widened_schema(old, new, where)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(widened(old.elementType, new.elementType, where), True)
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        return MapType(old.keyType, widened(old.valueType, new.valueType, where), True)
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        if new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale:
            return new
    elif old == new:
        return new
    else:
        for line in WIDER:
            if type(old) in line and type(new) in line and line.index(type(new)) > line.index(type(old)):
                return new
    raise ContractError(f"{where}: {old.simpleString()} does not widen to {new.simpleString()}")


def widened_schema(old: StructType, new: StructType, where: str = "") -> StructType:
    """The contract after a load of ``new`` columns: the old ones first, wider where the
    new are, then the new ones. Columns that do not come any more stay (as nulls)."""
    given = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        to = given.pop(f.name, f)
        kind = widened(f.dataType, to.dataType, f"{where}.{f.name}".lstrip("."))
        fields.append(StructField(f.name, kind, True, to.metadata or f.metadata))
    return StructType(fields + [StructField(f.name, f.dataType, True, f.metadata) for f in new.fields if f.name in given])


def contract_changes(old: StructType, new: StructType) -> list[str]:
    """What differs between two versions' contracts, in words."""
    had = {f.name: f.dataType for f in old.fields}
    out = [f"new column {f.name} {f.dataType.simpleString()}" for f in new.fields if f.name not in had]
    for f in new.fields:
        if f.name in had and had[f.name] != f.dataType:
            out.append(f"{f.name} widened from {had[f.name].simpleString()} to {f.dataType.simpleString()}")
    return out


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the columns of a contract that was widened for it."""
    return df.select(
        *(
            (F.col(quoted(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        )
    )


class Snapshot:
    """A database's tables as one commit left them."""

    def __init__(self, warehouse: Warehouse, database: str, entry: dict):
        self.number, self.warehouse, self.database = entry["number"], warehouse, database
        self.versions = {table: versions[0] for table, versions in entry["tables"].items()}

    def table(self, table: str) -> DataFrame:
        return self.warehouse.version(self.database, self.versions[table])


class Commit:
    """Tables written for one commit: seen by nobody before it."""

    def __init__(self, warehouse: Warehouse, database: str):
        self.warehouse, self.database = warehouse, database
        self.versions: dict[str, str] = {}

    def replace_table(self, df: DataFrame, table: str, **options) -> str:
        """Write a version of ``table`` (options as ``Warehouse.replace_table``)."""
        self.versions[table] = self.warehouse.write_version(df, self.database, table, **options)
        return f"{self.database}.{table}"


class Warehouse:
    """Databases and tables below one root folder.

    A database's name in the session catalog carries a mark of its root, so
    warehouses of different roots (or runs) live side by side. Each version of a table
    is an external table of its own with its declared schema, the version's contract.
    The newest manifest says which version is the table; a view of the table's name
    follows it, for SQL. The last ``keep_versions`` versions stay, for readers that
    started on them; older ones, and those of loads that died, are dropped with their
    files by the next commit of their table.
    """

    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions

    def catalog_name(self, database: str) -> str:
        return f"{database}_{hashlib.md5(self.root.encode()).hexdigest()[:8]}"

    def database_path(self, database: str) -> str:
        return f"{self.root}/{database}.db"

    def create_schema(self, database: str) -> None:
        """SNK-5: ``CREATE SCHEMA IF NOT EXISTS``."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {quoted(self.catalog_name(database))} LOCATION '{self.database_path(database)}'"
        )

    def name(self, database: str, table: str) -> str:
        return f"{quoted(self.catalog_name(database))}.{quoted(table)}"

    def _manifests(self, database: str) -> Ledger:
        return Ledger(self.spark, f"{self.database_path(database)}/_commits")

    def _versions(self, database: str, table: str) -> list[str]:
        """Version tables of a table, oldest first."""
        rows = self.spark.sql(f"SHOW TABLES IN {quoted(self.catalog_name(database))} LIKE '{table.lower()}__v_*'").collect()
        return sorted(r.tableName for r in rows)

    def current_version(self, database: str, table: str) -> str | None:
        manifest = self._manifests(database).last()
        versions = manifest["tables"].get(table) if manifest else None
        return versions[0] if versions else None

    def version(self, database: str, version: str) -> DataFrame:
        return self.spark.table(self.name(database, version))

    def write_version(
        self,
        df: DataFrame,
        database: str,
        table: str,
        contract: StructType | None = None,
        partition_by: list[str] | None = None,
        order_by: list[str] | None = None,
        evolve: bool = False,
    ) -> str:
        """Write a new version of a table, seen by nobody until a commit names it.

        Rows are counted while they are written (an observed metric, behind the last
        shuffle, so each written row counts once) and kept with the version, as is
        ``order_by`` ("column" or "column desc"), which ``ordered_table`` reads by.
        """
        self.create_schema(database)
        if contract is not None:
            df = enforce_contract(df, contract)
        current = self.current_version(database, table)
        if evolve and current:
            df = fitted(df, widened_schema(self.version(database, current).schema, df.schema))
        last = self._versions(database, table)[-1:]
        number = int(last[0].rsplit("_", 2)[1]) + 1 if last else 0
        version = f"{table.lower()}__v_{number:010d}_{uuid.uuid4().hex[:8]}"  # as the catalog spells it
        path = f"{self.database_path(database)}/{version}"
        if partition_by:
            # few files per partition value; AQE splits skewed values
            df = df.hint("rebalance", *partition_by)
        written = Observation()
        writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
        properties = {
            "num_rows": written.get["rows"],
            "size_bytes": Folder(self.spark, path).size(),
            "sort_order": ", ".join(order_by or []),
        }
        fields = [f for f in df.schema.fields if f.name not in (partition_by or [])]
        fields += [df.schema[c] for c in partition_by or []]
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}{_comment(f)}" for f in fields)
        parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        full = self.name(database, version)
        # The declared schema: partition values are read back as they were written.
        self.spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{parts} LOCATION '{path}' TBLPROPERTIES ({listed})")
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {full}")
        return version

    @contextmanager
    def commit(self, database: str) -> Iterator[Commit]:
        """SNK-1: replace several tables of a database at once.

        Inside, versions are written; at the end one manifest makes them the database's
        tables. If anything raises, the database stays as it was.
        """
        self.create_schema(database)
        writing = Commit(self, database)
        yield writing
        manifests = self._manifests(database)
        last = manifests.last() or {"number": -1, "tables": {}}
        tables = dict(last["tables"])
        for table, version in writing.versions.items():
            tables[table] = [version, *tables.get(table, [])][: self.keep_versions]
        manifests.append(last["number"] + 1, {"tables": tables})
        self.point_views(database, list(writing.versions))
        for table in writing.versions:
            for old in set(self._versions(database, table)) - set(tables[table]):
                self._retire(database, old)

    def point_views(self, database: str, tables: list[str] | None = None) -> None:
        """Let the names of tables (all of them, if none are named) show the versions of
        the newest manifest; a commit that died before it did so is made good by this."""
        manifest = self._manifests(database).last() or {"tables": {}}
        for table in manifest["tables"] if tables is None else tables:
            version = manifest["tables"][table][0]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name(database, table)} "
                f"TBLPROPERTIES ('current_version' = '{version}') AS SELECT * FROM {self.name(database, version)}"
            )

    def snapshot(self, database: str, number: int | None = None) -> Snapshot:
        """The tables of one commit (the newest, if not given), all as of that commit."""
        manifests = self._manifests(database)
        entry = manifests.last() if number is None else manifests.get(number)
        if entry is None:
            raise ValueError(f"{database} has no commit")
        return Snapshot(self, database, entry)

    def _retire(self, database: str, version: str) -> None:
        full = self.name(database, version)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").first()
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")
        Folder(self.spark, described.data_type).delete()

    def replace_table(
        self,
        df: DataFrame,
        database: str,
        table: str,
        contract: StructType | None = None,
        partition_by: list[str] | None = None,
        order_by: list[str] | None = None,
        evolve: bool = False,
    ) -> str:
        """SNK-1 / SNK-4: create or replace ``database.table`` from ``df``; its folder.

        ``contract`` names the exact columns and types. With ``evolve`` the contract of
        the version before is widened by what comes (new columns, wider types); what
        would narrow it is refused before anything is written.
        """
        with self.commit(database) as writing:
            writing.replace_table(
                df, table, contract=contract, partition_by=partition_by, order_by=order_by, evolve=evolve
            )
        return f"{self.database_path(database)}/{writing.versions[table]}"

    def append(self, df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
        """SNK-2: add rows to a Parquet table folder."""
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("append").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)

    def table(self, database: str, table: str) -> DataFrame:
        """The table as the newest manifest has it (tables made elsewhere by their name)."""
        version = self.current_version(database, table)
        return self.version(database, version) if version else self.spark.table(self.name(database, table))

    def _properties(self, database: str, table: str) -> dict[str, str]:
        full = self.name(database, self.current_version(database, table))
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}

    def ordered_table(self, database: str, table: str) -> DataFrame:
        """SRT-1..3: the table's rows in the order it was stored with."""
        order = self._properties(database, table)["sort_order"]
        keys = [c.rsplit(" ", 1) if c.endswith(" desc") else [c, "asc"] for c in order.split(", ") if c]
        rows = self.table(database, table)
        return rows.orderBy(*(F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c) for c, way in keys)) if keys else rows

    def contracts(self, database: str, table: str) -> dict[str, StructType]:
        """SNK-8: the contract of each version that is kept, the newest first."""
        manifest = self._manifests(database).last() or {"tables": {}}
        return {v: self.version(database, v).schema for v in manifest["tables"].get(table, [])}

    def statistics(self, database: str, table: str) -> DataFrame:
        """SNK-7 / AG-6: one row: names, row count, column count, size.

        All of it was kept when the version was written, so nothing is scanned.
        """
        kept = self._properties(database, table)
        return self.spark.range(1).select(
            F.lit(self.spark.catalog.currentCatalog()).alias("database_name"),
            F.lit(database).alias("schema_name"),
            F.lit(table).alias("table_name"),
            F.lit(int(kept["num_rows"])).cast("long").alias("num_rows"),
            F.lit(len(self.table(database, table).columns)).alias("column_count"),
            F.lit(int(kept["size_bytes"])).cast("long").alias("estimated_size"),
        )
