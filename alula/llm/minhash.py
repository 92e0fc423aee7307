"""Near-duplicate documents with b-bit MinHash.

A document's set is its distinct shingles of five words (A-Z lower-cased; words are what ASCII white space
separates). ``HASHES`` minima per set give ``BANDS`` band keys; only the low ``BITS`` bits of each minimum are kept,
packed into longs. Documents that share a band key are candidates. Their similarity is estimated from the packed
signatures by bit counts, corrected for the chance that low bits agree (2^-BITS); pairs whose estimate is more than
five standard errors below the threshold go, the others are confirmed on the full sets. A pair at 0.75 exactly shares
no band with probability 5e-6.

Groups are not compared pair by pair. Equal sets are one class, represented by its smallest id. In a bucket, members are
first compared with its centre, the one that meets most others in all buckets. Then only members of *different* components
found so far meet, with signatures of ``FINE_HASHES`` single bits, and a pair is made only if its estimate passes. Pairs
within a component cannot change the result.

Nulls count as empty. Documents without words are linked with nothing. Rows that share an id count as linked. A row
without an id is linked with nothing, stays, and has no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import Remembered, own_caches, send_small_batches, slices, without_rows, written
from alula.llm.components import connected_components

SHINGLE = 5
HASHES, BANDS, BITS = 128, 32, 4
#: Minima of which one bit each is kept for the documents whose buckets stay mixed.
FINE_HASHES, FINE_BITS = 2048, 1
ROWS = HASHES // BANDS
#: Similarity threshold in hundredths.
THRESHOLD = 75
#: Words a worker remembers are at most twice these.
WORD_CACHE = 250_000

_rng = np.random.default_rng(20250607)
_FACTORS = _rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_FINE_FACTORS = np.random.default_rng(20250608).integers(1, 1 << 32, FINE_HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_PLACES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BAND_SEEDS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


_words = Remembered(xxhash.xxh3_64_intdigest, WORD_CACHE, "minhash")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; empty without words."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=n)
    if n < SHINGLE:
        return _mixed(np.array([(w * _PLACES[:n]).sum() + np.uint64(n)], dtype=np.uint64))
    h = w[: n - SHINGLE + 1] * _PLACES[0]
    for k in range(1, SHINGLE):
        h += w[k : n - SHINGLE + 1 + k] * _PLACES[k]
    return np.unique(_mixed(h))


def minima(shingles: np.ndarray, factors: np.ndarray = _FACTORS, shifts: np.ndarray = _SHIFTS, block: int = 2048) -> np.ndarray:
    """One minimum per factor of a non-empty set, a block of shingles at a time."""
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingles), block):
        part = (shingles[at : at + block] >> np.uint64(17)).astype(np.uint32)
        np.minimum(low, (np.multiply.outer(factors, part) ^ shifts[:, None]).min(axis=1), out=low)
    return low


def packed(low: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The lowest bits of (scrambled) minima, 64 // bits of them in each long."""
    fields = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.uint64).reshape(-1, 64 // bits)
    return (fields << (np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits))).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    key = _BAND_SEEDS.copy()
    for k in range(ROWS):
        key = _mixed(key * np.uint64(31) + rows[:, k])
    return key.view(np.int64)


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own_caches("minhash")
    for batch in slices(batches):
        sizes, digests, signatures, keys = [], [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            shingles = shingle_set(text)
            sizes.append(len(shingles))
            digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
            low = minima(shingles) if len(shingles) else None
            signatures.append(packed(low) if len(shingles) else None)
            keys.append(band_keys(low) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "digest", "signature", "bands"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, packed b-bit signature, band keys) of every row."""
    schema = "doc_id long, n_shingles long, digest binary, signature array<long>, bands array<long>"
    send_small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signature_rows, schema)


def estimated_similarity(a: Column, b: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """Collision-corrected similarity of two packed signatures: differing fields are counted with ``bit_count``."""
    ones = sum(1 << (bits * i) for i in range(64 // bits))
    ones -= (ones >> 63) << 64
    differing = F.lit(0)
    for i in range(hashes * bits // 64):
        folded = x = a[i].bitwiseXOR(b[i])
        for s in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(ones)) if bits > 1 else folded)
    agree = 1 - differing / hashes
    chance = 2.0**-bits
    return (agree - chance) / (1 - chance)


def plausible(a: str, b: str, column: str = "signature", hashes: int = HASHES, bits: int = BITS) -> Column:
    """The pair's sizes allow the threshold and its estimate is at most five standard errors below it."""
    t, chance = THRESHOLD / 100, 2.0**-bits
    agree = chance + (1 - chance) * t
    error = (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)
    small, large = F.least(f"{a}.n_shingles", f"{b}.n_shingles"), F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    near = estimated_similarity(F.col(f"{a}.{column}"), F.col(f"{b}.{column}"), hashes, bits) >= t - 5 * error
    return (small * 100 >= large * THRESHOLD) & near


def _fine_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shifts = np.zeros(1, dtype=np.uint32)
    for batch in slices(batches):
        sets = [shingle_set(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        fine = [packed(minima(s, _FINE_FACTORS, shifts, 256), FINE_BITS) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(fine, pa.list_(pa.int64()))], ["id", "n_shingles", "fine"]
        )


def _confirmed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}

    def full_set(node: int, text: bytes) -> np.ndarray:
        if node not in known:
            if len(known) >= 64:
                known.clear()
            known[node] = shingle_set(text)
        return known[node]

    for batch in slices(batches):
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        texts_a, texts_b = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
        keep = []
        for i, (x, y) in enumerate(zip(a, b)):
            s, t = shingle_set(texts_a[i]), full_set(y, texts_b[i])
            common = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * common >= THRESHOLD * (len(s) + len(t) - common):
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` has (id, text), one row per id."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirmed_rows, "a long, b long")


def near_links(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (a, b) that connect all near-duplicate classes; ``reps`` has one signature row per class."""
    entries = reps.select("id", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(entries.join(shared, "key"), "buckets")
    wanted = members.groupBy("id").agg(F.sum("n").alias("weight"))
    held = docs.join(wanted.select(F.col("id").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi")
    texts = written(held.select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"]), "bucket-texts")
    marks = written(reps.join(wanted.select("id"), "id", "left_semi").select("id", "n_shingles", "signature"), "bucket-marks")

    ranked = members.join(wanted, "id").select("key", "id", "weight")
    centres = ranked.groupBy("key").agg(F.max_by("id", F.struct("weight", "id")).alias("centre"))
    stars = members.join(centres, "key").where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    likely = stars.join(marks.alias("x"), F.col("a") == F.col("x.id")).join(marks.alias("y"), F.col("b") == F.col("y.id")).where(plausible("x", "y"))
    first = written(confirmed(likely.select("a", "b"), texts), "near-links")

    found = connected_components(first)
    placed = members.join(found, members["id"] == found["node"], "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rest = written(placed.join(mixed, "key"), "mixed-buckets")
    fine = texts.join(rest.select("id").distinct(), "id", "left_semi").mapInArrow(_fine_rows, "id long, n_shingles long, fine array<long>")
    rest = written(rest.join(fine, "id").join(reps.select("id", "bands"), "id"), "mixed-marks")
    # The cheaper test comes first; a pair is made in the first bucket that it shares only.
    near = plausible("x", "y", "fine", FINE_HASHES // 4, FINE_BITS) & plausible("x", "y", "fine", FINE_HASHES, FINE_BITS)
    near = near & (F.element_at(F.array_intersect("x.bands", "y.bands"), 1) == F.col("x.key"))
    meet = rest.alias("x").join(rest.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & near)
    crossing = written(meet.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "crossing-pairs")
    if crossing.isEmpty():
        return first
    return first.union(written(confirmed(crossing, texts), "near-links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = written(signatures(docs), "signatures")
    usable = marks.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    reps = usable.join(classes.select("digest", "doc_id"), ["digest", "doc_id"], "left_semi").withColumnRenamed("doc_id", "id").dropDuplicates(["digest"])
    reps = written(reps, "class-marks")
    found = connected_components(near_links(reps, docs))
    special = classes.join(found, classes["doc_id"] == found["node"], "left").where("n > 1 or component is not null")
    special = written(special.select("digest", F.coalesce("component", "doc_id").alias("component_id")), "near-classes")
    result = marks.select("doc_id", "n_shingles", "digest").join(special, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document represents its component, with the columns of ``docs``."""
    gone = written(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "near-gone")
    return without_rows(docs, [F.col("doc_id")], gone)
