"""Exact deduplication with content-defined chunk recipes, in DataFrame functions only.

A normalised text is cut where its content says so: a chunk ends with the first sentence or line end after
``MIN_CHUNK`` characters, or after ``MAX_CHUNK``. Equal texts are cut alike, and a passage that two texts share
falls back into step. Every chunk gets an identifier: its 64-bit fingerprint, verified by comparing the chunks
themselves (each distinct chunk is moved once, after map-side deduplication). Chunks that differ in spite of equal
fingerprints are told apart by a number. A document then is a *recipe*, the ordered list of its chunk identifiers,
about a hundredth of its text. Equal recipes mean equal texts, so groups are found on recipes and the long texts are
never moved again.

Nulls count as empty texts; all empty texts are equal. Rows repeated under one id are copies like any other: exactly
one row of a group is kept, one with the largest id. A row without an id is kept only if nobody in its group has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from alula.llm.common import ascii_lower, free_name, without_rows, written

MIN_CHUNK, MAX_CHUNK = 256, 4096

Fingerprint = Callable[[Column], Column]


def chunks(text: Column, smallest: int = MIN_CHUNK, largest: int = MAX_CHUNK) -> Column:
    """The content-defined chunks of a text, in order; joined they give the text back."""
    ends = r"[\n.!?…؟।。！？]"
    pattern = rf"(?s).{{{smallest},{largest}}}?(?<={ends})|.{{1,{largest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _fingerprint(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def clashes(texts: DataFrame, fingerprint: Fingerprint = _fingerprint) -> DataFrame:
    """Verification: (fp, chunk, number) of every chunk that shares its fingerprint with a different chunk.

    ``texts`` has one column ``norm``. Numbers start at 1 within a fingerprint; all other chunks have number 0."""
    pieces = texts.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(fingerprint(F.col("chunk")).alias("fp"), "chunk").distinct()
    shared = written(pieces.groupBy("fp").count().where("count > 1").select("fp"), "chunk-clashes")
    if shared.isEmpty():
        return shared.select("fp", F.lit("").alias("chunk"), F.lit(0).alias("number"))
    number = F.row_number().over(Window.partitionBy("fp").orderBy("chunk"))
    return written(pieces.join(shared, "fp", "left_semi").withColumn("number", number), "chunk-numbers")


def recipes(docs: DataFrame, fingerprint: Fingerprint = _fingerprint) -> DataFrame:
    """(row_no, doc_id, text_sha256, recipe) of every row, written to the shared folder.

    A recipe's items are (fp, number), the verified identifiers in text order."""
    texts = docs.select(ascii_lower(F.col("text")).alias("norm"))
    clashing = clashes(texts, fingerprint)
    rows = docs.select(F.col("doc_id"), ascii_lower(F.col("text")).alias("norm"))
    if clashing.isEmpty():
        plain = rows.select(
            F.monotonically_increasing_id().alias("row_no"), "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.transform(chunks(F.col("norm")), fingerprint).alias("recipe"),
        )
        return written(plain, "recipes")
    pinned = written(rows.withColumn("row_no", F.monotonically_increasing_id()), "numbered-texts")
    cut = pinned.select("row_no", F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk")).withColumn("fp", fingerprint(F.col("chunk")))
    named = cut.join(clashing, ["fp", "chunk"], "left").select("row_no", F.struct("pos", "fp", F.coalesce("number", F.lit(0)).alias("number")).alias("item"))
    lists = named.groupBy("row_no").agg(F.array_sort(F.collect_list("item")).alias("items"))
    recipe = F.transform(F.coalesce("items", F.array()), lambda x: F.struct(x["fp"].alias("fp"), x["number"].alias("number")))
    full = pinned.join(lists, "row_no", "left").select(
        "row_no", "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), recipe.alias("recipe")
    )
    return written(full, "recipes")


def exact_duplicates(docs: DataFrame, fingerprint: Fingerprint = _fingerprint) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Groups of several rows are few and narrow; the join with them splits a hot group's rows over several tasks."""
    rows = recipes(docs, fingerprint)
    groups = rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("best"))
    several = written(groups.where("group_size > 1"), "recipe-groups")
    joined = rows.join(several, "recipe", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("best.row_no") == F.col("row_no"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with the columns of ``docs``.

    What goes is a narrow table of (id, text hash). Rows that are repeated under the id that stays are removed by
    comparing just those."""
    marks = written(exact_duplicates(docs), "exact-marks")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = marks.where(~same).select("doc_id", F.unhex("text_sha256").alias("hash")).distinct()
    repeated = written(marks.where(same & ~F.col("kept")).select("doc_id", F.unhex("text_sha256").alias("hash")).distinct(), "exact-repeats")
    digest = F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256))
    keys = [F.col("doc_id"), digest]
    if repeated.isEmpty():
        return without_rows(docs, keys, written(gone, "exact-gone"))
    rest = without_rows(docs, keys, written(gone.union(repeated), "exact-gone"))
    name = free_name(docs.columns, "__hash")
    marked = docs.select("*", digest.alias(name))
    again = marked.join(repeated, marked["doc_id"].eqNullSafe(repeated["doc_id"]) & (marked[name] == repeated["hash"]), "left_semi")
    return rest.unionByName(again.dropDuplicates(["doc_id", name]).select(*docs.columns))
