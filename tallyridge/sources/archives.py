"""Trip archives: CSV members inside ZIP files, or inside ZIP files inside ZIP files.

Only Spark decides what is read where: archives are listed with the binaryFile source
(without loading their bytes), one row per archive lists its members, and one row per
member slice is scanned. A task streams its slice in bounded blocks; nothing is
unpacked to disk and no archive is held in memory.
"""

from __future__ import annotations

import csv
import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS

BLOCK = 8 * 1024 * 1024

# Header names of older layouts and their canonical names.
ALIASES = {
    "tripduration": "reported_duration_seconds", "trip_duration": "reported_duration_seconds",
    "starttime": "started_at", "start_time": "started_at",
    "stoptime": "ended_at", "stop_time": "ended_at",
    "start_station_latitude": "start_lat", "start_station_longitude": "start_lng",
    "end_station_latitude": "end_lat", "end_station_longitude": "end_lng",
    "bikeid": "bike_id", "usertype": "member_casual", "user_type": "member_casual",
}
# Texts that stand for null.
NULL_MARKERS = ["", "NULL", "null", "\\N"]
REQUIRED = ("started_at", "ended_at")
# Periods in names, and names of the parts of a whole file.
PERIOD = r"(?<!\d)(20\d{2})(0[1-9]|1[0-2])(?!\d)"
PART_FILE = r"(?i)(?:_\d+|-part\d+)\.csv$"

MEMBER_SCHEMA = "path string, bytes long, sha256 string, nested string, member string, member_bytes long, crc long, header string"


def canonical_name(name: str) -> str:
    """Lower case, whitespace to underscore, then the alias table."""
    tidy = "_".join(name.strip().lower().split())
    return ALIASES.get(tidy, tidy)


def canonical_columns(df: DataFrame) -> DataFrame:
    """Rename to canonical columns, add absent ones as null text, keep the rest out."""
    named = {canonical_name(c): c for c in df.columns}
    if len(named) != len(df.columns) or not set(REQUIRED) <= set(named):
        raise ValueError(f"unknown or duplicate schema: {df.columns}")
    return df.select(*[
        (F.col(f"`{named[c]}`").cast("string") if c in named else F.lit(None).cast("string")).alias(c)
        for c in CANONICAL_TRIP_COLUMNS])


# ---------------------------------------------------------------- names


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent_of(path: Column) -> Column:
    up = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(up == "", ".").otherwise(up)


def useful_member(name: Column) -> Column:
    """No resource-fork folders and no dot files."""
    return ~name.startswith("__MACOSX/") & ~base_name(name).startswith(".")


def source_area(name: Column, patterns) -> Column:
    """Area of an archive name by the first of the (pattern, area) pairs that fits; null when none does."""
    out = None
    for pattern, area in patterns:
        out = F.when(name.rlike(pattern), area) if out is None else out.when(name.rlike(pattern), area)
    return out


def periods_in(name: Column) -> Column:
    """Distinct ``yyyy-MM`` periods written in a name."""
    found = F.regexp_extract_all(name, F.lit(PERIOD), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.concat(F.substring(p, 1, 4), F.lit("-"), F.substring(p, 5, 2))))


def member_period(name: Column, fallback: Column) -> tuple[Column, Column]:
    """Period of a member name, and the problem when there is none or more than one."""
    seen = periods_in(name)
    period = F.when(F.size(seen) == 1, seen[0]).when(F.size(seen) == 0, fallback)
    problem = F.when(F.size(seen) > 1, "conflicting periods").when((F.size(seen) == 0) & fallback.isNull(), "no period")
    return period, problem


def logical_groups(members: DataFrame, keys=("path", "nested", "period")) -> DataFrame:
    """Add ``representation``: whole files and part files of one folder are two versions."""
    marked = members.withColumns({"parent": parent_of(F.col("member")), "__part": F.col("member").rlike(PART_FILE)})
    by = [*keys, "parent"]
    kinds = marked.groupBy(*by).agg(F.bool_or("__part").alias("__p"), F.bool_or(~F.col("__part")).alias("__w"))
    renamed = kinds.select(*[F.col(k).alias(f"__{k}") for k in by], "__p", "__w")
    cond = None
    for k in by:
        piece = F.col(k).eqNullSafe(F.col(f"__{k}"))
        cond = piece if cond is None else cond & piece
    suffix = F.when(F.col("__p") & F.col("__w"), F.when(F.col("__part"), "::parts").otherwise("::whole")).otherwise("")
    return marked.join(renamed, cond).withColumn("representation", F.concat("parent", suffix)).drop(
        *[f"__{k}" for k in by], "__p", "__w", "__part", "parent")


# ---------------------------------------------------------------- inventory


def _open(path: str):
    """A seekable stream on any file system pyarrow knows."""
    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    fs, inner = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(inner)


def _digest(path: str) -> str:
    digest = hashlib.sha256()
    with _open(path) as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def _skip(name: str) -> bool:
    return name.startswith("__MACOSX/") or name.rsplit("/", 1)[-1].startswith(".")


def _csv_members(archive: zipfile.ZipFile, nested: str | None) -> Iterator[tuple]:
    for info in archive.infolist():
        if info.filename.lower().endswith(".csv") and not _skip(info.filename):
            with archive.open(info) as stream:
                header = stream.readline().decode("utf-8-sig").rstrip("\r\n")
            yield nested, info.filename, info.file_size, info.CRC, header


def _members_of(path: str) -> Iterator[tuple]:
    with _open(path) as raw, zipfile.ZipFile(raw) as outer:
        inner = [i.filename for i in outer.infolist() if i.filename.lower().endswith(".zip") and not _skip(i.filename)]
        for nested in sorted(inner) or [None]:
            if nested is None:
                yield from _csv_members(outer, None)
            else:
                with outer.open(nested) as stream, zipfile.ZipFile(stream) as archive:
                    yield from _csv_members(archive, nested)


def _list_members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in MEMBER_SCHEMA.split(", ")]
    for frame in frames:
        for path, size in zip(frame["path"], frame["bytes"]):
            rows = [(path, size, _digest(path), *m) for m in _members_of(path)]
            yield pd.DataFrame(rows or [(path, size, None, None, None, None, None, None)], columns=names)


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """One small row is one large piece of work, so spread rows over many tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def inventory(spark: SparkSession, folder: str, patterns) -> DataFrame:
    """One row per CSV member with area, period, representation, schema and problems."""
    members = _spread(list_archives(spark, folder), "path").mapInPandas(_list_members, MEMBER_SCHEMA)
    archive = base_name(F.col("path"))
    yearly = F.col("nested").isNull() & (F.length(F.split_part(archive, F.lit("-"), F.lit(1))) == 4)
    hint = periods_in(F.coalesce("nested", archive))
    fallback = F.when(~yearly & (F.size(hint) == 1), hint[0])
    period, trouble = member_period(F.col("member"), fallback)
    names = F.transform(F.split("header", ","), lambda h: F.regexp_replace(F.lower(F.btrim(h, F.lit(' "'))), r"\s+", "_"))
    aliases = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    mapped = F.transform(names, lambda n: F.coalesce(F.try_element_at(aliases, n), n))
    schema_fault = (F.size(F.array_distinct("columns")) != F.size("columns")) | ~(
        F.array_contains("columns", "started_at") & F.array_contains("columns", "ended_at"))
    rows = members.withColumns({"area": source_area(archive, patterns), "period": period, "columns": mapped, "__trouble": trouble})
    rows = rows.withColumn("problem", F.when(F.col("member").isNull(), "no csv member").when(F.col("area").isNull(), "unknown area")
                           .when(schema_fault, "unknown or duplicate schema").otherwise(F.col("__trouble"))).drop("__trouble")
    return logical_groups(rows)


def require_sound(rows: DataFrame) -> DataFrame:
    bad = rows.where("problem IS NOT NULL").select("path", "member", "problem").take(1)
    if bad:
        raise ValueError(f"{bad[0].problem}: {bad[0].path}::{bad[0].member}")
    return rows


def work_items(rows: DataFrame) -> DataFrame:
    """(area, period) work items with an order-free signature of their members."""
    mark = F.xxhash64("sha256", "nested", "member", "crc", "representation")
    folded = rows.groupBy("area", "period").agg(
        F.count(F.lit(1)).alias("members"), F.sum("member_bytes").alias("bytes"),
        F.bit_xor(mark).alias("__x"), F.sum(mark.cast("decimal(38,0)")).alias("__s"))
    signature = F.sha2(F.concat_ws("|", "members", F.col("__x").cast("string"), F.col("__s").cast("string")), 256)
    return folded.select("area", "period", "members", "bytes", signature.alias("signature"))


# ---------------------------------------------------------------- scan


def line_blocks(stream, block: int = BLOCK) -> Iterator[bytes]:
    """The text after the header line, in blocks of whole lines."""
    stream.readline()
    while got := stream.read(block):
        if not got.endswith(b"\n"):
            got += stream.readline()
        yield got


def _parse(block: bytes, names: list[str]) -> pa.Table:
    return pacsv.read_csv(
        io.BytesIO(block), pacsv.ReadOptions(column_names=names, block_size=max(len(block), 1)),
        pacsv.ParseOptions(newlines_in_values=False),
        pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=True, null_values=NULL_MARKERS))


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carry = ("area", "period", "path", "nested", "member", "representation")
    for batch in batches:
        for job in batch.to_pylist():
            with _open(job["path"]) as raw, zipfile.ZipFile(raw) as outer:
                if job["nested"] is None:
                    yield from _member_rows(outer, job, carry)
                else:
                    with outer.open(job["nested"]) as inner, zipfile.ZipFile(inner) as archive:
                        yield from _member_rows(archive, job, carry)


def _member_rows(archive: zipfile.ZipFile, job: dict, carry) -> Iterator[pa.RecordBatch]:
    names = [canonical_name(n) for n in next(csv.reader([job["header"]]))]
    with archive.open(job["member"]) as stream:
        for block in line_blocks(stream):
            table = _parse(block, names)
            columns = [table[c] if c in names else pa.nulls(table.num_rows, pa.string()) for c in CANONICAL_TRIP_COLUMNS]
            tags = [pa.array([job[c]] * table.num_rows, pa.string()) for c in carry]
            yield from pa.Table.from_arrays([*columns, *tags], names=[*CANONICAL_TRIP_COLUMNS, *carry]).to_batches()


def scan(rows: DataFrame) -> DataFrame:
    """All rows of the listed members as canonical text columns plus where they came from.

    A deflated member can only be read from its start, so each is inflated once, by one task, in blocks of bounded size.
    """
    need = ["path", "nested", "member", "header", "area", "period", "representation"]
    schema = ", ".join(f"{c} string" for c in (*CANONICAL_TRIP_COLUMNS, "area", "period", "path", "nested", "member", "representation"))
    return _spread(rows.select(*need), "path", "nested", "member").mapInArrow(_read_members, schema)


# ---------------------------------------------------------------- representations


def representation_faults(df: DataFrame, version: str, content, keys=("area", "period")) -> DataFrame:
    """Contents whose multiplicity differs between the versions of one work item."""
    keys = list(keys)
    versions = df.groupBy(*keys).agg(F.count_distinct(version).alias("versions"))
    per = df.groupBy(*keys, version, *content).agg(F.count(F.lit(1)).alias("n"))
    spread = per.groupBy(*keys, *content).agg(F.count(F.lit(1)).alias("seen"), F.min("n").alias("low"), F.max("n").alias("high"))
    return spread.join(versions, keys).where("seen <> versions OR low <> high")


def keep_one_version(df: DataFrame, version: str, keys=("area", "period")) -> DataFrame:
    """Rows of the first version of each work item."""
    first = df.groupBy(*keys).agg(F.min(version).alias(version))
    return df.join(first, [*keys, version], "left_semi")
