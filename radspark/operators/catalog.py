"""File catalogue: discovery, sniffing, deduplication, tallies and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark.functions import metadata as md
from radspark.storage import spool

# File name extensions of medical images, and the preamble's mark.
EXTENSIONS = (".dcm", ".dicom", ".ima", "")
MAGIC = bytearray(b"DICM")
MIN_BYTES, PREAMBLE = 1024, 128


def discover(spark: SparkSession, root: str, extensions: Sequence[str] = EXTENSIONS, exclude: Sequence[str] = (), content: bool = False) -> DataFrame:
    """path, length (and content) of files below ``root``; a missing root raises.

    Names and sizes are filtered in the scan; content is not read unless asked for.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return by_name(files.select("path", "length", *(["content"] if content else [])), extensions, exclude)


def by_name(files: DataFrame, extensions: Sequence[str] = EXTENSIONS, exclude: Sequence[str] = (), path: str = "path") -> DataFrame:
    """Keep wanted extensions (lower case), no DICOMDIR, none of the excluded parts of a path."""
    p = F.col(path)
    out = files.where(md.extension(p).isin([e.lower() for e in extensions]) & (F.regexp_extract(p, r"([^/]*)$", 1) != "DICOMDIR"))
    for part in exclude:
        out = out.where(~p.contains(part))
    return out


def large_enough(files: DataFrame, least: int = MIN_BYTES, length: str = "length") -> DataFrame:
    return files.where(F.col(length) >= least) if least > 0 else files


def is_dicom(content: Column) -> Column:
    """Whether the mark follows the preamble."""
    return F.coalesce(F.substring(content, PREAMBLE + 1, 4) == F.lit(MAGIC), F.lit(False))


def dedup_first(records: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in a fixed order; keys need not be gathered: a minimum does it."""
    cols = [c for c in records.columns if c != key]
    rank = F.struct(*order)
    best = records.groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("r"))
    return best.select(key, "r.*").select(*records.columns)


def dedup_flags(records: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Every row with ``duplicate``: whether an earlier row has its key.

    The first row of each key is a partial minimum; no task gathers a key's
    rows. Rows that are equal in ``order`` too are told apart by their place.
    """
    place = F.monotonically_increasing_id()
    rows = records.select(F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row"), F.col(key).alias("key"), F.struct(*[F.col(c) for c in order], place).alias("rank"))
    rows = spool(rows)  # so that both sides see the same places
    first = rows.groupBy(F.col("key").alias("own")).agg(F.min("rank").alias("first"))
    out = rows.join(first, F.col("key").eqNullSafe(F.col("own")))
    return out.select(*[F.col("row").getField(c).alias(c) for c in records.columns], (F.col("rank") != F.col("first")).alias("duplicate"))


def tally(records: DataFrame, field: str, blank: str = "Unknown") -> DataFrame:
    """value, n; blank and null values count as ``blank``."""
    v = F.coalesce(md.blank_to_null(F.col(field)), F.lit(blank))
    return records.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def counters(records: DataFrame, status: str = "status", key: str = "sop_instance_uid") -> DataFrame:
    """One row: scanned, found, non_dicom, unreadable, duplicates."""
    s = F.col(status)
    return records.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(s == "ok").alias("found"), F.count_if(s == "not_dicom").alias("non_dicom"),
                       F.count_if(s == "parse_error").alias("unreadable"), (F.count_if(s == "ok") - F.count_distinct(F.when(s == "ok", F.col(key)))).alias("duplicates"))


def scan(spark: SparkSession, root: str, modalities: Sequence[str] | None = None, least: int = MIN_BYTES, dedup: bool = True,
         extensions: Sequence[str] = EXTENSIONS, exclude: Sequence[str] = ()) -> DataFrame:
    """Header records of a directory: discovery, size filter, parsing, modality filter, deduplication by SOP UID."""
    from radspark.sources import dicom

    files = large_enough(discover(spark, root, extensions, exclude), least)
    return finish(dicom.header_records(dicom.with_heads(files)), modalities, dedup)


def finish(records: DataFrame, modalities: Sequence[str] | None = None, dedup: bool = True) -> DataFrame:
    ok = records.where("status = 'ok'")
    if modalities:
        ok = ok.where(F.col("modality").isin(list(modalities)))
    return dedup_first(ok, "sop_instance_uid", ["path"]) if dedup else ok


def scan_paths(spark: SparkSession, paths: Sequence[str], dedup: bool = True) -> DataFrame:
    """Header records of listed files; neither names nor sizes are filtered, missing files are passed over (see ``listed``)."""
    from radspark.sources import dicom

    files = listed(spark, paths).where("status is null").select("path", "length")
    return finish(dicom.header_records(dicom.with_heads(files)), None, dedup)


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, length, status of files that a caller lists: ``missing`` where there is none, else null."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        there = fs.exists(at)
        rows.append((fs.makeQualified(at).toString(), int(fs.getFileStatus(at).getLen()) if there else None, None if there else "missing"))
    return spark.createDataFrame(rows, "path string, length long, status string")
