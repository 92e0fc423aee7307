"""Landmark (TPS) files as tables.

Block:  ``LM=n``, n lines "x y", then IMAGE= / ID= / COMMENT= / SCALE= lines in
any order, up to the next ``LM=``. A text scan with the block start as line
separator gives one row per block and lets Spark cut large files into splits."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.functions.shapes import dropped_point
from alula.operators.ordering import evaluated_once, lookup, numbered, running_totals, sequential_ids
from alula.schema import LANDMARKS
from alula.session import broadcast_bytes, pinned


class LandmarkFileError(ValueError):
    """A landmark file is malformed or has an unexpected number of blocks."""


# Fixed values of the format.
BLOCK_SEPARATOR = "\nLM="
DIRECTIVES = r"(?i)^(LM=|IMAGE=|ID=|COMMENT=|SCALE=)"
LINE_BREAK = "\r\n|\n|\r"
STRAY = "expected 'LM=', found: '"
WHOLE_NUMBER = r"^[+-]?\d+$"
NUMBER = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?|nan)$"


def _blocks(scan: DataFrame) -> DataFrame:
    """(source, start, seq, own, pos, text): one row per block, its count line first; ``own``: the scanned
    record names its ``LM=`` itself, which of all records only the first of a file can.

    Blocks whose ``LM=`` is indented or in lower case are cut out here."""
    own = F.regexp_like(F.col("value"), F.lit(r"(?is)^\s*LM="))
    whole = F.when(own, F.col("value")).otherwise(F.concat(F.lit("LM="), F.col("value")))
    cut = F.split(whole, r"(?im)^[ \t]*LM=")
    # like the line separator does, a block cut out here loses the line break before the next one
    pieces = F.transform(cut, lambda t, i: F.when(i < F.size(cut) - 1, F.regexp_replace(t, r"(?:\r\n|\n|\r)\z", "")).otherwise(t))
    return (
        scan.select("source", "start", "seq", own.alias("own"), F.posexplode_outer(pieces).alias("pos", "text"))
        .filter((F.col("pos") > 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    )


def scan_blocks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    reader = spark.read.option("lineSep", BLOCK_SEPARATOR)
    raw = reader.text(paths if isinstance(paths, str) else list(paths))
    return _blocks(raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    ))


def stream_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same scan over files arriving in a folder."""
    raw = spark.readStream.option("lineSep", BLOCK_SEPARATOR).text(folder)
    return _blocks(raw.select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("start"),
        F.lit(0).cast("long").alias("seq"), "value",
    ))


def _after_equals(line: Column) -> Column:
    return S.stripped(F.substring(line, F.instr(line, "=") + 1, F.length(line)))


def _number(c: Column) -> Column:
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """Fields of every block plus ``problems``: array of (line_in_block, message)."""
    numbered_lines = F.filter(
        F.transform(F.split("text", LINE_BREAK), lambda t, i: F.struct(i.alias("n"), S.stripped(t).alias("t"))),
        lambda e: (e["t"] != "") | (e["n"] == 0),
    )
    split = blocks.withColumn("lines", numbered_lines).withColumn("count_text", F.get("lines", 0)["t"])
    split = split.withColumn("body", F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))).withColumn(
        "n_points", F.when(F.col("count_text").rlike(WHOLE_NUMBER), F.col("count_text").try_cast("int"))
    )
    stop = F.array_position(F.transform("body", lambda e: e["t"].rlike(DIRECTIVES)), F.lit(True))
    head_size = F.when(stop > 0, stop - 1).otherwise(F.size("body")).cast("int")
    cut = evaluated_once(split.withColumn("head", F.slice("body", F.lit(1), F.greatest(head_size, F.lit(0)))).drop("lines"))

    def coordinate(e: Column) -> Column:
        parts = F.split(S.stripped(F.translate(e["t"], ",", " ")), r"\s+")
        x, y = _number(F.get(parts, 0)), _number(F.get(parts, 1))
        return F.struct(
            e["n"].alias("n"), e["t"].alias("t"), x.alias("x"), y.alias("y"),
            F.when(F.size(parts) < 2, "malformed landmark: '")
            .when(x.isNull() | y.isNull(), "non-numeric coordinate: '").alias("fault"),
        )

    read = evaluated_once(cut.withColumn("read", F.transform("head", coordinate)).drop("head"))
    # how many lines are consumed until n good pairs are found
    used = F.aggregate(
        "read",
        F.struct(F.lit(0).alias("good"), F.lit(0).alias("used")),
        lambda a, e: F.when(a["good"] >= F.col("n_points"), a).otherwise(
            F.struct(
                (a["good"] + F.when(e["fault"].isNull(), 1).otherwise(0)).alias("good"),
                (a["used"] + 1).alias("used"),
            )
        ),
    )["used"]
    taken = read.withColumn("used", F.coalesce(used, F.lit(0))).withColumn("taken", F.slice("read", F.lit(1), F.col("used")))
    good = taken.withColumn("pts", F.filter("taken", lambda e: e["fault"].isNull())).withColumn(
        "meta", F.slice("body", F.col("used") + 1, F.greatest(F.size("body"), F.lit(1)))
    )

    def directive(name: str) -> Column:
        return F.transform(
            F.filter("meta", lambda e: F.upper(e["t"]).startswith(name)),
            lambda e: F.struct(e["n"].alias("n"), e["t"].alias("t"), _after_equals(e["t"]).alias("v")),
        )

    good = evaluated_once(good.drop("read"))
    ids = good.withColumn("id_lines", directive("ID=")).withColumn(
        "comment", F.array_join(F.transform(directive("COMMENT="), lambda e: e["v"]), ";")
    )
    whole_ids = F.filter("id_lines", lambda e: e["v"].rlike(WHOLE_NUMBER))
    tps_id = F.try_element_at(whole_ids, F.lit(-1))["v"].try_cast("decimal(20,0)")
    image = F.coalesce(F.try_element_at(directive("IMAGE="), F.lit(-1))["v"], F.lit(""))
    fields = ids.withColumn("tps_id", tps_id).withColumn("image_path", image)

    def note(n: Column, message: Column) -> Column:
        return F.struct((n + 1).cast("int").alias("line_in_block"), message.alias("message"))

    quote = F.lit("'")
    uncounted = F.concat(
        F.array(note(F.lit(0), F.concat(F.lit("unreadable point count in 'LM="), F.col("count_text"), quote))),
        F.transform("body", lambda e: note(e["n"], F.concat(F.lit(STRAY), e["t"], quote))),
    )
    faults = F.transform(
        F.filter("taken", lambda e: e["fault"].isNotNull()),
        lambda e: note(e["n"], F.concat(e["fault"], e["t"], quote)),
    )
    wrong_count = F.when(
        F.size("pts") != F.col("n_points"),
        note(F.lit(0), F.format_string("expected %d landmarks, found %d", F.col("n_points"), F.size("pts"))),
    )
    bad_ids = F.transform(
        F.filter("id_lines", lambda e: ~e["v"].rlike(WHOLE_NUMBER)),
        lambda e: note(e["n"], F.concat(F.lit("non-integer ID: '"), e["t"], quote)),
    )
    no_id = F.when(F.col("tps_id").isNull(), note(F.lit(0), F.lit("no ID= found for this specimen")))
    counted = F.concat(faults, F.array_compact(F.array(wrong_count)), bad_ids, F.array_compact(F.array(no_id)))
    known = F.col("n_points").isNotNull()
    usable = (
        known & (F.size(faults) == 0) & (F.size("pts") == F.col("n_points")) & F.col("tps_id").isNotNull()
    )

    return evaluated_once(fields.select(
        "source", "start", "seq", "own", "pos", "n_points", "count_text",
        F.transform("pts", lambda e: e["x"]).alias("x"),
        F.transform("pts", lambda e: e["y"]).alias("y"),
        "image_path", "tps_id",
        S.comment_field(F.col("comment"), "photo_id").alias("photo_id"),
        S.comment_field(F.col("comment"), "inv_id").alias("inv_id"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
        F.when(known, counted).otherwise(uncounted).alias("problems"),
        F.size(F.split(F.regexp_replace("text", r"\r\z", ""), LINE_BREAK)).alias("n_lines"),
    ))


FILE_ORDER = ["source", "start", "seq", "pos"]
#: Bytes that a row of the table of file splits takes at most in a broadcast, its path included.
SPLIT_ROW_BYTES = 1024


def _ranked_by_split(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """Adds ``ord``, the rank in file order from 0, without moving the rows.

    Rows of a file split stand together in one task, in file order. A first pass over ``counted`` (the same rows, as cheap as they
    can be had) gives each split's number of rows and its first place in the task; sums over that small table, one row per
    split, give the ranks at which splits begin. The second pass checks that every row stands where the first pass saw its
    split: should Spark cut or pack the files differently in between, some row does not, and the query fails."""
    spark = rows.sparkSession
    place = F.monotonically_increasing_id()
    splits = pinned(
        counted.select("source", "start", place.alias("place")).groupBy("source", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    )
    ends = running_totals(splits, [], ["source", "start"], {"end": F.col("n")})
    table = ends.select(F.col("source").alias("__source"), F.col("start").alias("__start"), "first", "n", (F.col("end") - F.col("n")).alias("before"))
    if splits.count() * SPLIT_ROW_BYTES <= broadcast_bytes(spark):
        table = F.broadcast(table)
    placed = rows.withColumn("place", place).join(table, (F.col("source") == F.col("__source")) & (F.col("start") == F.col("__start")), "left")
    inside = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("n"))
    moved = F.raise_error(F.lit("file splits changed while they were ranked; set spark.sql.files.minPartitionNum")).cast("long")
    return placed.select(*rows.columns, F.when(inside, F.col("place") - F.col("first") + F.col("before")).otherwise(moved).alias("ord"))


def read_landmarks(spark: SparkSession, paths: str | Sequence[str], strict: bool = True, rank: bool = True) -> DataFrame:
    """Usable blocks with ``ord`` = rank in file order.

    ``strict`` fails the query on the first problem instead of dropping blocks.
    ``rank=False`` skips the ranking: ``ord`` is then unique and increases
    within each file split only."""
    blocks = scan_blocks(spark, paths)
    parsed = parse_blocks(blocks)
    if strict:
        first = F.get("problems", 0)
        message = F.concat(first["message"], F.lit(" (line "), first["line_in_block"].cast("string"), F.lit(" of its block)"))
        parsed = parsed.withColumn(
            "usable", F.when(F.size("problems") > 0, F.raise_error(message).cast("boolean")).otherwise(F.col("usable"))
        )
    kept = parsed.filter("usable")
    if rank:
        # of a strict reading every block stays, so that counting needs no parsing
        kept = _ranked_by_split(kept, blocks if strict else kept)
    else:
        kept = kept.withColumn("ord", F.monotonically_increasing_id())
    return kept.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDMARKS.fields])


def read_landmark_errors(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per problem: source, specimen_index, line_no (in the file), message.

    A block whose count is unreadable takes a number of its own; the lines left over after it belong to the next.
    Text before the first block is no block: its lines carry number 0."""
    blocks = scan_blocks(spark, paths)
    parsed = parse_blocks(blocks).select(*FILE_ORDER, "own", "count_text", "problems", "n_lines")
    placed = running_totals(
        parsed, ["source"], FILE_ORDER[1:], {"specimen": F.lit(1), "last": F.col("n_lines")}, sizes_from=blocks
    )
    headed = blocks.groupBy("source").agg((~F.min_by("own", F.struct(*FILE_ORDER[1:]))).cast("long").alias("headed"))
    first_line = F.col("last") - F.col("n_lines")
    leading = (F.col("headed") == 1) & (F.col("specimen") == 1)
    every = lookup(placed, headed, ["source"]).select(
        "source", "count_text", leading.alias("leading"), (F.col("specimen") - F.col("headed") - 1).alias("k"),
        first_line.alias("first"), F.explode("problems").alias("p"),
    )
    uncounted = F.col("leading") & (F.col("p.line_in_block") == 1)
    stray = F.col("p.message").startswith(STRAY)
    return every.filter(~uncounted | (F.col("count_text") != "")).select(
        "source", F.when(F.col("leading"), 0).otherwise(F.col("k") + stray.cast("long")).cast("long").alias("specimen_index"),
        (F.col("first") + F.col("p.line_in_block")).alias("line_no"),
        F.when(uncounted, F.concat(F.lit(STRAY), F.col("count_text"), F.lit("'"))).otherwise(F.col("p.message")).alias("message"),
    )


def read_reference(spark: SparkSession, path: str) -> np.ndarray:
    """A frozen reference shape: a file with exactly one block."""
    rows = read_landmarks(spark, path, strict=False, rank=False).limit(2).collect()
    if len(rows) != 1:
        raise LandmarkFileError(f"{path} must contain exactly one specimen block, found {'none' if not rows else 'more'}")
    return np.column_stack([rows[0]["x"], rows[0]["y"]])


def read_uploads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several files, or folders of part files, together; each must yield a block, ids are renumbered."""
    rows = read_landmarks(spark, list(paths), strict=False)
    sources = rows.select(F.regexp_replace("source", r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/").alias("file")).distinct()
    wanted = spark.createDataFrame([(p, "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", p).strip("/")) for p in paths], "path string, prefix string")
    inside = (F.col("file") == F.col("prefix")) | F.col("file").startswith(F.concat("prefix", F.lit("/")))
    empty = [r["path"] for r in wanted.join(sources, inside, "left_anti").collect()]
    if empty:
        raise LandmarkFileError(f"no valid specimen found in {empty}")
    return sequential_ids(rows, "tps_id", "photo_id", ("ord",)).select(LANDMARKS.fieldNames())


# --- writing ------------------------------------------------------------------------------------


def block_text(tps_id: Column, decimals: int = 4, comment: bool = True) -> Column:
    """One block as text, without its final line break."""
    pair = F.zip_with("x", "y", lambda a, b: F.format_string(f"%.{decimals}f %.{decimals}f", a, b))
    lines = [
        F.array(F.concat(F.lit("LM="), F.size("x").cast("string"))),
        pair,
        F.array(F.concat(F.lit("IMAGE="), F.coalesce("image_path", F.lit("")))),
        F.array(F.concat(F.lit("ID="), tps_id.cast("string"))),
    ]
    if comment:
        note = S.comment_text(F.col("photo_id"), F.col("inv_id"))
        lines.append(F.array_compact(F.array(F.when(note.isNotNull(), F.concat(F.lit("COMMENT="), note)))))
    return F.concat(*lines)


def write_landmarks(
    df: DataFrame, path: str, order: Sequence[str] = ("ord",), single_file: bool = False,
    decimals: int = 4, comment: bool = True, line_break: str = "\r\n",
) -> None:
    """Landmark files below ``path``, in ``order``.

    Rows are range-partitioned, so the part files read in name order are the
    file; ``single_file`` is for small exports handed to other tools."""
    text = F.array_join(block_text(F.col("tps_id"), decimals, comment), line_break)
    lined = df.select(*order, text.alias("value"))
    if single_file:
        lined = lined.coalesce(1).sortWithinPartitions(*order)
    else:
        lined = lined.repartitionByRange(*order).sortWithinPartitions(*order)
    lined.select("value").write.mode("overwrite").option("lineSep", line_break).text(path)


def write_clean_landmarks(df: DataFrame, path: str, order: Sequence[str] = ("ord",), single_file: bool = False) -> None:
    """Compact rewrite: ids 0..N-1 in order, five decimals, no comment."""
    renumbered = numbered(df.drop("tps_id"), [], list(order), "tps_id", start=0)
    write_landmarks(renumbered, path, order, single_file, decimals=5, comment=False, line_break="\n")


def without_landmark(df: DataFrame, index: int) -> DataFrame:
    """Landmark ``index`` (0-based) removed from every configuration."""
    return (
        df.withColumn("x", dropped_point(F.col("x"), index))
        .withColumn("y", dropped_point(F.col("y"), index))
        .withColumn("n_points", F.size("x"))
    )
