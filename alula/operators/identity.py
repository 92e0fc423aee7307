"""Specimen identity: conflicts, frozen keys and the tables built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.functions.status import has_full_date
from alula.operators.ordering import Order, first_rows, lookup, numbered, order_key
from alula.schema import COMPARE_COLUMNS, MAPPING_COLUMNS, SchemaError, lead_with, require_columns


class IdentityError(ValueError):
    """Identity rules are violated by the input."""


# --- origins ----------------------------------------------------------------


def origin_table(df: DataFrame, origin_column: str) -> DataFrame:
    """Distinct origins, sorted, with an empty code to fill in."""
    if origin_column not in df.columns:
        return df.limit(0).select(F.lit("").alias("collection_origin"), F.lit("").alias("inv_name"))
    return (
        df.filter(F.col(origin_column).isNotNull())
        .select(F.col(origin_column).alias("collection_origin"))
        .distinct()
        .orderBy("collection_origin")
        .withColumn("inv_name", F.lit(""))
    )


def resolved_origin_codes(table: DataFrame) -> DataFrame:
    """A blank code means the origin's own name."""
    origin = F.col("collection_origin").cast("string")
    return table.select(origin.alias("collection_origin"), S.filled(F.trim(F.col("inv_name")), origin).alias("inv_name"))


def constant_origin(df: DataFrame, inv_name: str) -> tuple[DataFrame, str, DataFrame]:
    """One code for a source without an origin column."""
    column = "_all"
    table = df.sparkSession.createDataFrame([(column, inv_name)], "collection_origin string, inv_name string")
    return df.withColumn(column, F.lit(column)), column, table


def unmapped_origins(df: DataFrame, codes: DataFrame, origin_column: str) -> DataFrame:
    known = codes.select(F.col("collection_origin").alias(origin_column))
    return df.select(origin_column).distinct().join(known, origin_column, "left_anti")


def assign_inv_name(
    df: DataFrame, key: str, codes: DataFrame | None = None, origin_column: str = "collection_origin"
) -> DataFrame:
    """Adds ``inv_name`` from the origin lookup, or from the id itself."""
    if codes is None:
        name = S.embedded_name(F.col(key).cast("string"))
        problem = F.concat(F.lit("id does not match <name>_<digits>: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        return df.withColumn("inv_name", F.when(name.isNull(), F.raise_error(problem)).otherwise(name))
    missing = [r[0] for r in unmapped_origins(df, codes, origin_column).limit(20).collect()]
    if missing:
        raise IdentityError(f"{origin_column} value(s) missing from the origin codes: {sorted(map(str, missing))}")
    table = codes.select(F.col("collection_origin").alias(origin_column), "inv_name")
    return df.drop("inv_name").join(table, origin_column, "left")


# --- disagreement between rows of one key ---------------------------------------


def _variants(df: DataFrame, key: str, compare: Sequence[str], order: Order) -> DataFrame:
    """First row of each distinct (key, compare) combination; NULLs compare equal."""
    rest = [c for c in df.columns if c != key and c not in compare]
    grouped = df.groupBy(key, *compare).agg(
        F.min(order_key(order)).alias("__first"),
        F.min_by(F.struct(*rest), order_key(order)).alias("__row") if rest else F.lit(None).alias("__row"),
    )
    extra = [F.col(f"__row.{c}").alias(c) for c in rest]
    return grouped.select(key, *compare, "__first", *extra)


def _conflicting(variants: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Keys with more than one variant, with the canonical (first) values."""
    return (
        variants.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_variants"),
            F.min_by(F.struct(*compare), F.col("__first")).alias("canonical"),
        )
        .filter(F.col("n_variants") > 1)
    )


def identity_conflicts(
    df: DataFrame, key: str, order: Order, compare: Sequence[str] = tuple(COMPARE_COLUMNS)
) -> DataFrame:
    """One row per distinct variant of every conflicting key."""
    require_columns(df, [key, *compare], "identification table")
    variants = _variants(df, key, compare, order)
    canonical = _conflicting(variants, key, compare)
    joined = variants.join(canonical, key)
    return joined.select(
        *df.columns,
        F.struct(*compare).eqNullSafe(F.col("canonical")).alias("matches_first_occurrence"),
    )


def resolve_identification(
    df: DataFrame,
    key: str,
    order: Order,
    device: str | None = None,
    compare: Sequence[str] = tuple(COMPARE_COLUMNS),
) -> DataFrame:
    """First row per (key, device), identity columns taken from the key's first row."""
    require_columns(df, [key, *compare, *([device] if device else [])], "identification table")
    canonical = _conflicting(_variants(df, key, compare, order), key, compare).drop("n_variants")
    kept = first_rows(df, [key, *([device] if device else [])], order)
    joined = kept.join(canonical, key, "left")
    fixed = [
        F.when(F.col("canonical").isNotNull(), F.col(f"canonical.{c}")).otherwise(F.col(c)).alias(c)
        if c in compare
        else F.col(c)
        for c in df.columns
    ]
    return joined.select(*fixed)


def consistency_report(df: DataFrame, order: Order, bio_columns: Sequence[str], key: str = "inv_id") -> DataFrame:
    """First row of each variant for specimens whose rows disagree."""
    if not bio_columns:
        return df.limit(0)
    variants = _variants(df, key, bio_columns, order)
    return variants.join(_conflicting(variants, key, bio_columns), key).select(df.columns)


def flag_inconsistent(df: DataFrame, order: Order, bio_columns: Sequence[str], key: str = "inv_id") -> DataFrame:
    """SUSPECT for every not-FAILED row of a specimen whose rows disagree."""
    if not bio_columns:
        return df
    bad = _conflicting(_variants(df, key, bio_columns, order), key, bio_columns).select(key, F.lit(True).alias("__bad"))
    joined = df.join(bad, key, "left")
    hit = F.coalesce(F.col("__bad"), F.lit(False)) & (F.col("status") != "FAILED")
    reason = f"biological columns disagree within {key}: {list(bio_columns)}"
    return joined.select(
        *[
            F.when(hit, "SUSPECT").otherwise(F.col(c)).alias(c)
            if c == "status"
            else F.when(hit, reason).otherwise(F.col(c)).alias(c)
            if c == "status_reason"
            else F.col(c)
            for c in df.columns
        ]
    )


# --- frozen surrogate keys ----------------------------------------------------------


def extend_mapping(existing: DataFrame, specimens: DataFrame, frozen_at: str, embedded_numbering: bool) -> DataFrame:
    """Existing rows untouched, unseen specimens appended with fresh ids.

    ``specimens`` has one row per (source_type, original_id). An id another
    source already holds stops the query."""
    keys = ["source_type", "original_id"]
    new = specimens.join(existing.select(*keys), keys, "left_anti")
    if embedded_numbering:
        named = assign_inv_name(new.drop("inv_name"), "original_id")
        added = named.withColumn("inv_num", S.embedded_number(F.col("original_id"))).withColumn(
            "inv_id", F.col("original_id")
        )
    else:
        dated = has_full_date(F.col("yyyy"), F.col("mm"), F.col("dd"))
        order: list[Column] = [F.when(dated, 0).otherwise(1)]
        order += [F.when(dated, F.col(c)) for c in ("yyyy", "mm", "dd")]
        order.append(F.col("original_id"))
        ranked = numbered(new, ["source_type", "inv_name"], order, "__rank")
        tops = existing.groupBy("source_type", "inv_name").agg(F.max("inv_num").alias("__top"))
        added = (
            lookup(ranked, tops, ["source_type", "inv_name"])
            .withColumn("inv_num", F.coalesce(F.col("__top"), F.lit(0)) + F.col("__rank"))
            .withColumn("inv_id", S.numbered_id(F.col("inv_name"), F.col("inv_num")))
        )
    added = added.withColumn("frozen_at", F.lit(frozen_at)).withColumn("inv_num", F.col("inv_num").cast("long"))
    taken = existing.select("inv_id", F.lit(True).alias("__taken")).distinct()
    problem = F.raise_error(F.concat(F.lit("inv_id already taken by another source: "), F.col("inv_id"))).cast("string")
    added = added.join(taken, "inv_id", "left").withColumn(
        "inv_id", F.when(F.col("__taken"), problem).otherwise(F.col("inv_id"))
    )
    return existing.select(MAPPING_COLUMNS).unionByName(added.select(MAPPING_COLUMNS))


def attach_inv_id(
    df: DataFrame, mapping: DataFrame, key: str, source_type: str, keep_original_id: bool = True
) -> DataFrame:
    """Joins the frozen id; legacy id columns are dropped."""
    renaming = keep_original_id and key != "original_id"
    if renaming and "original_id" in df.columns:
        raise SchemaError(f"cannot keep {key!r} as 'original_id': that column already exists")
    keys = mapping.filter(F.col("source_type") == source_type).select(
        F.col("original_id").alias("__key"), F.col("inv_id").alias("__clean")
    )
    joined = df.join(keys, F.col(key) == F.col("__key"), "inner")
    legacy = [c for c in ("inv_id", "inv_num") if c in df.columns and c != key]
    columns = []
    for c in df.columns:
        if c in legacy or (c == key and not keep_original_id):
            continue
        columns.append(F.col(c).alias("original_id") if c == key and renaming else F.col(c))
    return lead_with(joined.select(F.col("__clean").alias("inv_id"), *columns), ["inv_id", "inv_name"])


# --- tables derived from identity -------------------------------------------------------


def with_image(ident: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Identification rows that have at least one image."""
    return ident.join(manifest.select(F.col("original_id").alias(key)).distinct(), key, "left_semi")


def without_image(ident: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    return ident.join(manifest.select(F.col("original_id").alias(key)).distinct(), key, "left_anti")


def orphan_images(manifest: DataFrame, ident: DataFrame, key: str) -> DataFrame:
    """Images whose specimen has no identification row."""
    return manifest.join(ident.select(F.col(key).alias("original_id")).distinct(), "original_id", "left_anti")


def specimen_table(
    mapping: DataFrame,
    ident: DataFrame,
    key: str,
    source_type: str,
    order: Order,
    device: str | None = None,
    keep_original_id: bool = True,
    device_values: Sequence[str] | None = None,
) -> DataFrame:
    """One row per specimen, with supplied photo counts pivoted by device."""
    merged = attach_inv_id(ident, mapping, key, source_type, keep_original_id)
    order_columns = [c for c in order if isinstance(c, str)]
    if not (device and "n_photos" in merged.columns):
        return lead_with(first_rows(merged, ["inv_id"], order).drop(*order_columns), ["inv_id", "inv_name"])
    values = list(device_values) if device_values else None
    counts = merged.groupBy("inv_id").pivot(device, values).agg(F.min_by("n_photos", order_key(order)))
    counts = counts.select("inv_id", *[F.col(f"`{c}`").alias(f"n_photos_{c}") for c in counts.columns if c != "inv_id"])
    bare = first_rows(merged, ["inv_id"], order).drop("device", device, "n_photos", *order_columns)
    return lead_with(bare.join(counts, "inv_id", "left"), ["inv_id", "inv_name"])


def device_types(ident: DataFrame, device: str, device_name: str) -> DataFrame:
    """Distinct (device type, device name) pairs."""
    pairs = ident.select(F.col(device).alias("device_type"), F.col(device_name).alias("device"))
    return pairs.distinct().orderBy("device_type", "device")


def specimen_devices(
    mapping: DataFrame, ident: DataFrame, key: str, source_type: str, device: str, device_name: str, order: Order
) -> DataFrame:
    """Device name per (specimen, device type); the first row decides."""
    merged = attach_inv_id(ident, mapping, key, source_type)
    picked = first_rows(merged, ["inv_id", device], order)
    return picked.select("inv_id", F.col(device).alias("device_type"), F.col(device_name).alias("device"))


def assign_photo_ids(manifest: DataFrame, mapping: DataFrame) -> DataFrame:
    """Photo table: indices 1..n per (specimen, device) by shot order, then content."""
    merged = manifest.join(mapping.select("original_id", "inv_id"), "original_id", "inner")
    order = [F.col("shot_index").asc_nulls_last(), F.col("content_hash")]
    if "raw_path" in merged.columns:
        order.append(F.col("raw_path"))
    indexed = numbered(merged, ["inv_id", "device_type"], order, "photo_index")
    named = indexed.withColumn(
        "photo_id", S.photo_key(F.col("inv_id"), F.col("device_type"), F.col("photo_index"))
    )
    return lead_with(named, ["photo_id", "inv_id"])
