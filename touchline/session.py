"""Session defaults, and the one place that decides where intermediate data lives."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs an extra exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "touchline", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="touchline-")
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder path in the shared folder that no earlier run used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, folder: str):
    """The store a path names, and the path as that store takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, in whatever store its path names. Nothing is read."""
    store, path = _file_system(spark, folder)
    return bool(store.exists(path))


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder with all that is in it; False if there is none."""
    store, path = _file_system(spark, folder)
    return bool(store.delete(path, True))


def child_folders(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the folders right in a folder that begin with ``prefix``."""
    store, path = _file_system(spark, folder)
    if not store.exists(path):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(path) if f.isDirectory() and f.getPath().getName().startswith(prefix))


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4  # per core


@contextmanager
def listing_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list many folders in a few tasks per core. Spark's own setting makes a task of every folder, up to
    10,000 of them, and starting one takes longer than listing a folder of few files."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


_SIZES: WeakKeyDictionary[DataFrame, tuple[int, int | None]] = WeakKeyDictionary()
FIXED_BYTES = 16  # of a column in a row, besides the text in it


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder, counting its rows and their widest on the way.

    Later steps read that table, so a lost executor costs a re-read, not a re-run; every
    reader reads only its columns, and the planner sees the real size.
    """
    spark, seen = df.sparkSession, Observation()
    folder = new_folder(spark, "step")
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    widest = F.max(sum(texts, F.lit(0)).cast("long")) if texts else F.lit(0).cast("long")
    measures = [F.count(F.lit(1)).alias("rows"), *([widest.alias("widest")] if texts else [])]
    df.observe(seen, *measures).write.parquet(folder)
    rows, out = seen.get["rows"], spark.read.schema(df.schema).parquet(folder)
    nested = any(kind.startswith(("array", "map", "struct")) for _, kind in df.dtypes)
    _SIZES[out] = rows, None if nested else rows * ((seen.get.get("widest") or 0) + FIXED_BYTES * len(df.columns))
    return out


def with_known_rows(df: DataFrame, rows: int | None, like: DataFrame | None = None) -> DataFrame:
    """Note the row count of a frame that was just counted, or derived row by row from ``like``, with a few
    columns of fixed width more."""
    if rows is not None:
        size = known_bytes(like) if like is not None else None
        _SIZES[df] = rows, None if size is None else size + rows * FIXED_BYTES * len(df.columns)
    return df


def known_rows(df: DataFrame) -> int | None:
    return _SIZES.get(df, (None, None))[0]


def known_bytes(df: DataFrame) -> int | None:
    """At most how many bytes the rows of a counted frame hold; None if that was not measured."""
    return _SIZES.get(df, (None, None))[1]
