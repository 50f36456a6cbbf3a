"""Season match files: CSVs whose headers and encodings drift between seasons."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.expressions import season_label
from touchline.params import Params
from touchline.session import materialize

# Header in the match files -> column name.
HEADERS = {
    "Date": "match_date", "Time": "kickoff_time", "HomeTeam": "home_team", "AwayTeam": "away_team",
    "FTHG": "ft_home_goals", "FTAG": "ft_away_goals", "FTR": "ft_result",
    "HTHG": "ht_home_goals", "HTAG": "ht_away_goals", "HTR": "ht_result", "Referee": "referee",
    "HS": "home_shots", "AS": "away_shots", "HST": "home_shots_on_target", "AST": "away_shots_on_target",
    "HF": "home_fouls", "AF": "away_fouls", "HC": "home_corners", "AC": "away_corners",
    "HY": "home_yellows", "AY": "away_yellows", "HR": "home_reds", "AR": "away_reds",
}
SEASON = re.compile(r"_([0-9]{4})\.csv(?:/|$)")  # a file, or a folder of the parts of one
NEXT_FIELD = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma outside quotes
FILE_ORDER = ["_file_no", "_block", "_line"]
MANIFEST_SCHEMA = ("season string, file string, bytes bigint, sha256 string, rows bigint, "
                   "fetched_at string, modified timestamp")


def file_names(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """One row per file: where it is, as readers take it and as rows name it, its size and time. Nothing is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(folder))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file"), "length", F.col("modificationTime").alias("modified"),
                        F.col("_metadata.file_path").alias("_uri"))


def file_lines(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """The files' bytes between line feeds, a row each, in any number of tasks. ``_block`` and ``_line`` order the
    rows of a file. A line is the most of a file that is ever held at once."""
    lines = (spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").text(folder))
    return lines.select(F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_line"), F.col("value").alias("_bytes"))


def season_of(path: Column) -> Column:
    return F.regexp_extract(path, SEASON.pattern, 1)


def file_facts(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """Per file its size, line feeds, whether it begins with a byte-order mark and is valid UTF-8, from one aggregate.

    A line feed is a character of its own in UTF-8, so a file is valid if every line is. The reader drops line feeds and a
    leading mark; what the lines lack of the file's size tells how many there were: the mark's three bytes, and
    a line feed after every line, the last one in doubt.
    """
    lines = file_lines(spark, folder, pattern).groupBy("_uri").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("_bytes")).alias("_held"), F.bool_and(F.is_valid_utf8("_bytes")).alias("_valid"))
    n, held = F.coalesce("_n", F.lit(0)), F.coalesce("_held", F.lit(0))
    missing = F.col("length") - held - F.greatest(n - 1, F.lit(0))
    return file_names(spark, folder, pattern).join(lines, "_uri", "left").select(
        "path", "file", "length", "modified", "_uri", (missing >= 3).alias("marked"), F.coalesce("_valid", F.lit(True)).alias("utf8"),
        (F.greatest(n - 1, F.lit(0)) + F.when(missing >= 3, missing - 3).otherwise(missing)).alias("line_feeds"))


def digests(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """(path, sha256) of whole files. A digest runs over a file from its first byte to its last, so the lines of a file
    go to one task, in order, which holds a batch of them at a time; files are spread."""
    sized = lines.join(facts.select("_uri", "path", "marked", "line_feeds"), "_uri")
    ordered = sized.repartition("path").sortWithinPartitions("path", "_block", "_line")
    columns = ordered.select("path", "marked", "line_feeds", F.col("_bytes").cast("binary").alias("bytes"))
    found = columns.mapInArrow(streamed_digests, "path string, sha256 string")
    # A file without a line is not among them.
    bare = F.when(F.col("marked"), F.sha2(F.unhex(F.lit("EFBBBF")), 256)).otherwise(F.sha2(F.lit(""), 256))
    return facts.select("path", "marked").join(found, "path", "left").select("path", F.coalesce("sha256", bare).alias("sha256"))


def streamed_digests(batches):
    """Batches of lines in order of file and place -> (path, sha256)."""
    import hashlib

    import pyarrow as pa

    path = digest = None
    seen = feeds = 0

    def ended():
        if seen <= feeds:  # as many line feeds as lines: the last line ends in one
            digest.update(b"\n")
        return pa.RecordBatch.from_pydict({"path": [path], "sha256": [digest.hexdigest()]})

    for batch in batches:
        paths, marks = batch.column("path").to_pylist(), batch.column("marked").to_pylist()
        counts, lines = batch.column("line_feeds").to_pylist(), batch.column("bytes").to_pylist()
        start = 0
        while start < len(paths):
            stop = start
            while stop < len(paths) and paths[stop] == paths[start]:
                stop += 1
            if paths[start] != path:
                if path is not None:
                    yield ended()
                path, digest, seen, feeds = paths[start], hashlib.sha256(b"\xef\xbb\xbf" if marks[start] else b""), 0, counts[start]
            elif seen:
                digest.update(b"\n")
            digest.update(b"\n".join(lines[start:stop]))
            seen, start = seen + stop - start, stop
    if path is not None:
        yield ended()


def file_encodings(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """The encoding of each file, from one distributed pass: UTF-8 when the bytes are valid, else Latin-1."""
    kind = F.when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1")
    return file_facts(spark, paths, pattern).select("path", kind.alias("encoding"))


def encodings(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> dict[str, str]:
    """Path -> encoding. Only one short row per file (one file per season) comes back."""
    return {r["path"]: r["encoding"] for r in file_encodings(spark, folder, pattern).collect()}


def read_match_file(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """A file, or files of one header, as text columns named by it. A byte-order mark is skipped."""
    return (spark.read.option("header", True).option("encoding", encoding)
            .option("inferSchema", False).option("enforceSchema", True).csv(path))


def read_by_header(spark: SparkSession, paths: str | list[str], headers: dict[str, str],
                   pattern: str = "*.csv") -> DataFrame:
    """Known columns of many files, read in one scan per distinct header and encoding.

    Files that share both may be read together; files that do not may not, as a scan binds
    columns by position. Only header lines and paths come to the driver.
    """
    kinds = file_encodings(spark, paths, pattern)
    lines = header_lines(spark, paths, pattern).join(kinds, "path").groupBy("header", "encoding").agg(
        F.collect_list("path").alias("paths"))
    parts = []
    for row in lines.orderBy("header", "encoding").collect():
        df = (spark.read.option("header", True).option("inferSchema", False).option("encoding", row["encoding"])
              .csv(row["paths"]))
        parts.append(df.select(*[F.col(f"`{c}`").alias(new) for c, new in headers.items() if c in df.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_matches(spark: SparkSession, folder: str, params: Params = Params(),
                 headers: dict[str, str] = HEADERS, only: list[str] | None = None) -> DataFrame:
    """Known columns of every season file, tagged with season and file order.

    Files of a season that share header and encoding are read in one scan; others are not, as a header names the
    columns of its own file only. The result is written once, which fixes the line numbers for the readers that
    follow. Each season of ``only``, or else of the configured ones, must have its file.
    """
    wanted, groups = only if only is not None else params.seasons, {}
    found = [(SEASON.search(r["path"]), r["path"], r["_uri"]) for r in file_names(spark, folder).orderBy("path").collect()]
    found = [(name[1], path, uri) for name, path, uri in found if name]
    if absent := sorted(set(wanted or ()) - {season for season, _, _ in found}):
        raise FileNotFoundError(f"no file in {folder} for season {', '.join(absent)}")
    own = [path for season, path, _ in found if wanted is None or season in wanted]
    if not own:
        raise FileNotFoundError(f"no season file in {folder}")
    kinds = encodings(spark, own)
    first = {r["path"]: r["header"] for r in header_lines(spark, own).collect()}
    for season, path, _ in found:
        if path in kinds:
            groups.setdefault((season, first[path], kinds[path]), []).append(path)
    parts = []
    for (season, _, encoding), paths in groups.items():
        df = read_match_file(spark, paths, encoding)
        parts.append(df.select(
            *[F.col(f"`{c}`").alias(new) for c, new in headers.items() if c in df.columns],
            F.lit(season).alias("season_code"),
            season_label(F.lit(season), params.century).alias("season_label"),
            F.lit(season == params.current_season).alias("is_current_season"),
            F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    numbers = spark.createDataFrame([(uri, number) for number, (_, _, uri) in enumerate(found)], "_uri string, _file_no int")
    named = [c for c in rows.columns if c not in ("_uri", "_block", "_line")]
    return materialize(rows.join(F.broadcast(numbers), "_uri").select(*named, *FILE_ORDER))


def first_lines(batches):
    """Path batches -> (path, first line), reading no more of a file than that line."""
    import pandas as pd
    from pyarrow import fs

    for batch in batches:
        lines = []
        for path in batch["path"]:
            uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path
            system, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            with system.open_input_stream(name) as stream:
                line = b""
                while b"\n" not in line and (block := stream.read(65536)):
                    line += block
            lines.append(line.split(b"\n", 1)[0].decode("utf-8", "replace"))
        yield pd.DataFrame({"path": batch["path"], "header": lines})


def header_lines(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """First line of every file. The listing carries no content, so nothing else is read."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true").load(paths).select("path"))
    lines = listed.mapInPandas(first_lines, "path string, header string")
    return lines.withColumn("header", F.regexp_replace("header", "[\r\ufeff]", ""))


def file_headers(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """One row per file and column, from the header lines."""
    return header_lines(spark, paths, pattern).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"),
        F.explode(F.split("header", NEXT_FIELD)).alias("column")).select(
        "path", "file", F.regexp_replace("column", '^"|"$', "").alias("column")).filter(F.trim("column") != "")


def manifest(spark: SparkSession, folder: str | list[str], fetched_at: Column,
             previous: DataFrame | None = None, pattern: str = "*.csv") -> DataFrame:
    """Size, digest and line count (without the header) per file, and whether it changed."""
    facts = materialize(file_facts(spark, folder, pattern))
    now = facts.join(digests(file_lines(spark, folder, pattern), facts), "path").select(
        season_of(F.col("path")).alias("season"), "path", "file", F.col("length").alias("bytes"),
        "sha256", (F.col("line_feeds") - 1).cast("bigint").alias("rows"),
        F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("fetched_at"), "modified")
    if previous is None:
        return now.withColumn("changed", F.lit(True))
    before = previous.select(F.col("path").alias("_path"), F.col("sha256").alias("_sha256"))
    return now.join(before, F.col("path") == F.col("_path"), "left").select(
        *now.columns, (~F.col("sha256").eqNullSafe(F.col("_sha256"))).alias("changed"))


def seasons_to_fetch(seasons: DataFrame, stored: DataFrame, current_season: str,
                     force: bool = False) -> DataFrame:
    """Seasons without a stored file, and always the live one."""
    if force:
        return seasons
    have = stored.select(F.col("season").alias("_have")).distinct()
    missing = seasons.join(have, F.col("season") == F.col("_have"), "left_anti")
    return missing.union(seasons.filter(F.col("season") == current_season)).distinct()
