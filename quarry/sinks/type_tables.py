"""SNK-3: one catalog table for each event type of an incremental table.

The rows stay where the load wrote them; a type's table is an external table whose
partitions (run, day) point at its folders. Only folders of committed runs are added,
so a run that died is in no table. What was published is noted in a ledger of its own:
a publication that died is made good by the next one, and one that comes again adds
nothing. A new type makes a new table, a new column is added to the tables.
"""

from __future__ import annotations

import hashlib
import json
import re
from urllib.parse import unquote

from pyspark.sql.types import StructType

from quarry.functions.naming import snake
from quarry.operators.incremental import IncrementalTable
from quarry.sinks.ledger import Folder, Ledger
from quarry.sinks.warehouse import Warehouse, quoted

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def table_name(event_type: str | None, prefix: str) -> str:
    """``PushEvent`` -> ``<prefix>_push_event``; other signs become ``_`` and a mark of
    the whole type keeps such names apart."""
    if event_type is None:
        return f"{prefix}_untyped"
    name = snake(event_type)
    plain = re.sub(r"\W", "_", name, flags=re.ASCII)
    return f"{prefix}_{plain}" if plain == name else f"{prefix}_{plain}_{hashlib.md5(event_type.encode()).hexdigest()[:6]}"


def _value(folder: str) -> str | None:
    value = folder.split("=", 1)[1]
    return None if value == NO_VALUE else unquote(value)


def publish_types(
    table: IncrementalTable, warehouse: Warehouse, database: str = "repo_events", prefix: str = "repo_events"
) -> list[str]:
    """Bring the type tables up to the newest committed run; returns all their names.

    Looks at the folders of runs not published yet, so a publication's cost follows
    the runs, not the history. The table must be partitioned by type and day.
    """
    kind, day = table.partition_by
    spark = table.spark
    noted = Ledger(spark, table.path + "__published")
    last = noted.last()
    names = set(last["tables"]) if last else set()
    for number in table.ledger.numbers():
        if last and number <= last["number"]:
            continue
        entry = table.ledger.get(number)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        warehouse.create_schema(database)
        folder = f"{table.path}/run={number}"
        for type_folder in _folders(spark, folder, kind):
            name = table_name(_value(type_folder), prefix)
            full = warehouse.name(database, name)
            columns = [f for f in schema.fields if f.name not in (kind, day)]
            if name not in names:
                listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
                spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {full} ({listed}, run BIGINT, {quoted(day)} DATE) USING parquet "
                    f"PARTITIONED BY (run, {quoted(day)}) LOCATION '{table.path}__tables/{name}'"
                )
            have = set(spark.table(full).columns)
            new = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns if f.name not in have]
            if new:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(new)})")
            for day_folder in _folders(spark, f"{folder}/{type_folder}", day):
                value = _value(day_folder)
                spec = f"run = {number}, {quoted(day)} = " + ("NULL" if value is None else f"DATE'{value}'")
                spark.sql(
                    f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION ({spec}) "
                    f"LOCATION '{folder}/{type_folder}/{day_folder}'"
                )
            names.add(name)
        noted.append(number, {"tables": sorted(names)})
        last = {"number": number, "tables": sorted(names)}
    return sorted(names)


def _folders(spark, path: str, column: str) -> list[str]:
    return [n for n in Folder(spark, path).names() if n.startswith(f"{column}=")]
