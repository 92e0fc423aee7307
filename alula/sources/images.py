"""Image inventories: recursive scans with content hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators.manifest import flag_duplicate_content, scan_records
from alula.schema import IMAGE_EXTENSIONS
from alula.sources.tables import path_exists


def _glob() -> str:
    """All spellings of the accepted extensions in one pattern."""
    spelled = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in IMAGE_EXTENSIONS]
    return "*.{" + ",".join(spelled) + "}"


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, file_size_bytes, content_hash and ext of every image below a folder.

    Content is dropped right after hashing and never shuffled. Every listed file gives a row: one that vanishes or
    cannot be read before it is hashed has size -1 and no hash."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob())
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .load(folder)
    )
    hashed = files.select("path", F.col("length").alias("n"), S.content_hash(F.col("content")).alias("content_hash"))
    local = F.regexp_replace("path", "^file:/+", "/")
    every = files.select("path").join(hashed, "path", "left")  # listing opens no file
    return every.select(
        local.alias("path"), F.coalesce("n", F.lit(-1)).cast("long").alias("file_size_bytes"), "content_hash"
    ).withColumn("ext", S.path_extension(F.col("path")))


def scan_root(spark: SparkSession, folder: str, source_type: str, photographer_subfolder: bool = False, root_ord: int = 0) -> DataFrame:
    """Scan rows of one root, before duplicate marking."""
    base = folder.rstrip("/") + "/"
    files = scan_files(spark, folder).withColumnRenamed("path", "raw_path")
    inside = F.substring(F.col("raw_path"), F.instr(F.col("raw_path"), base) + len(base), F.length("raw_path"))
    photographer = F.when(inside.contains("/"), F.substring_index(inside, "/", 1)) if photographer_subfolder else F.lit(None).cast("string")
    files = files.withColumn("source_type", F.lit(source_type)).withColumn("photographer", photographer).withColumn(
        "root_ord", F.lit(root_ord)
    )
    return scan_records(files, S.path_stem(F.col("raw_path")), F.col("content_hash").isNotNull())


def scan_roots(spark: SparkSession, roots: Sequence[Mapping]) -> DataFrame:
    """Several roots; the same content seen earlier (root order, then path) makes a row SUSPECT.

    Roots that do not exist are skipped."""
    scans = [
        scan_root(spark, r["path"], r["source_type"], bool(r.get("photographer_subfolder", False)), i)
        for i, r in enumerate(roots)
        if path_exists(spark, r["path"])
    ]
    if not scans:
        raise ValueError("no valid root to scan")
    whole = reduce(DataFrame.unionByName, scans)
    return flag_duplicate_content(whole, ["root_ord", "raw_path"])
