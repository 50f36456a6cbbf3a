"""Tables that are replaced in one step: written beside the old ones, shown by a pointer that is written last.

A warehouse folder holds a folder per table with one folder per version, and ``pointers``, an append-only log of
one small file per publication. A table is what the newest pointer that names it says: a schema and the folders of its
parts, one for each partition or a single one. A landing that dies midway leaves folders nobody points to, so every reader
keeps the rows from before; several tables published together change together. Partitions that are not replaced keep
their files. One writer at a time; readers may read whenever they like, and what they resolved stays until the
second publication after it.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.session import child_folders, exists, remove_folder

POINTERS = "pointers"
KEPT = 2  # publications of a table whose files are kept
PLAIN = re.compile(r"[A-Za-z0-9_.-]+")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """A version of a table: for each of its parts the folder, seen from the warehouse."""
    name: str
    schema: StructType
    parts: dict[str, str]
    rows: int | None = None  # that were written for it


def part_name(key: str, value) -> str:
    """The name of a partition; values are numbers or plain codes, which stand for themselves in a path."""
    text = NO_VALUE if value is None else str(value)
    if not PLAIN.fullmatch(text):
        raise ValueError(f"{value!r} is no plain partition value")
    return f"{key}={text}"


def written_parts(spark: SparkSession, folder: str, version: str, levels: int) -> dict[str, str]:
    """Partition -> folder of a version that was just written. Folders are listed, nothing is read."""
    parts = [""]
    for _ in range(levels):
        parts = [f"{p}/{c}" for p in parts for c in child_folders(spark, f"{folder}/{version}{p}", "") if "=" in c]
    return {p[1:]: f"{version}{p}" for p in parts}


def stage(df: DataFrame, folder: str, name: str, partition_by: list[str] | None = None) -> Table:
    """Write a whole new version. Nobody sees it before :func:`publish`."""
    seen, version = Observation(), f"{name}/_version={uuid.uuid4().hex}"
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if not partition_by:
        writer.parquet(f"{folder}/{version}")
        return Table(name, df.schema, {"": version}, seen.get["rows"])
    writer.partitionBy(*partition_by).parquet(f"{folder}/{version}")
    return Table(name, df.schema, written_parts(df.sparkSession, folder, version, len(partition_by)), seen.get["rows"])


def stage_parts(df: DataFrame, folder: str, name: str, key: str, values: list) -> Table:
    """A version in which the partitions of ``values`` hold the rows of ``df`` (none, if it has none of them) and
    every other partition keeps the files it has. ``df`` has no other values of ``key``."""
    before, new = published(df.sparkSession, folder).get(name), stage(df, folder, name, [key])
    gone = {part_name(key, v) for v in values}
    if stray := set(new.parts) - gone:
        raise ValueError(f"{name}: rows of partitions that are not replaced: {', '.join(sorted(stray))}")
    kept = {p: f for p, f in before.parts.items() if p not in gone} if before else {}
    return Table(name, new.schema, {**kept, **new.parts}, new.rows)


def entries(spark: SparkSession, folder: str) -> list[tuple[str, dict]]:
    """(file, pointer) of the log, which :func:`vacuum` keeps as short as a few publications of each table. A file that
    goes while the log is read has newer ones beside it."""
    if not exists(spark, f"{folder}/{POINTERS}"):
        return []
    lines = spark.read.option("ignoreMissingFiles", "true").text(f"{folder}/{POINTERS}")
    rows = lines.select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).collect()
    return [(r["file"], json.loads(r["value"])) for r in rows]


def publish(spark: SparkSession, folder: str, *tables: Table) -> None:
    """Show staged versions, all at once: one file is added to the log, which is there whole or not at all."""
    number = 1 + max((e["number"] for _, e in entries(spark, folder)), default=0)
    lines = [json.dumps({"number": number, "name": t.name, "schema": t.schema.jsonValue(), "parts": t.parts}) for t in tables]
    log = spark.range(1, numPartitions=1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))
    log.write.mode("append").text(f"{folder}/{POINTERS}")


def published(spark: SparkSession, folder: str) -> dict[str, Table]:
    """What every table of a warehouse is now."""
    log = sorted((e for _, e in entries(spark, folder)), key=lambda e: e["number"])
    return {e["name"]: Table(e["name"], StructType.fromJson(e["schema"]), e["parts"]) for e in log}


def open_table(spark: SparkSession, folder: str, table: Table) -> DataFrame:
    if not table.parts:
        return spark.createDataFrame([], table.schema)
    places = [f"{folder}/{place}" for _, place in sorted(table.parts.items())]
    reader = spark.read.schema(table.schema).option("basePath", f"{folder}/{table.name}")
    return reader.parquet(*places).select(*[f"`{c}`" for c in table.schema.names])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = published(spark, folder).get(name)
    if table is None:
        raise FileNotFoundError(f"no table {name} in {folder}")
    return open_table(spark, folder, table)


def replace(df: DataFrame, folder: str, name: str, partition_by: list[str] | None = None) -> int:
    """Replace one table, with all its partitions; returns the rows written."""
    table = stage(df, folder, name, partition_by)
    publish(df.sparkSession, folder, table)
    vacuum(df.sparkSession, folder, [name])
    return table.rows


def vacuum(spark: SparkSession, folder: str, names: list[str], kept: int = KEPT) -> list[str]:
    """Delete what none of the last ``kept`` publications of a table points to, and pointers that are older in all
    their tables. Returns the tables' folders that went."""
    log, numbers = entries(spark, folder), {}
    for _, e in log:
        numbers.setdefault(e["name"], []).append(e["number"])
    since = {name: sorted(n)[-kept:][0] for name, n in numbers.items()}
    recent = {file for file, e in log if e["number"] >= since[e["name"]]}
    gone = []
    for name in names:
        places = {p for _, e in log if e["name"] == name and e["number"] >= since[name] for p in e["parts"].values()}
        for version in child_folders(spark, f"{folder}/{name}", "_version="):
            place = f"{name}/{version}"
            inside = [p for p in places if p.startswith(f"{place}/")]
            old = [f"{place}/{part}" for part in child_folders(spark, f"{folder}/{place}", "")] if inside else [place]
            gone += [p for p in old if p not in places and not any(q == p or q.startswith(f"{p}/") for q in inside)]
    for place in gone:
        remove_folder(spark, f"{folder}/{place}")
    for file in {file for file, _ in log} - recent:
        remove_folder(spark, f"{folder}/{POINTERS}/{file}")
    return gone
