"""Shape variance: nested sums of squares and stratified permutation tests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from alula.functions.shapes import interleaved
from alula.operators.arrow import list_column, matrix
from alula.operators.ordering import lookup, numbered
from alula.session import pinned, setting

PERMUTATION_ROWS = 50_000  # rows shuffled together in one task
PARTIAL_BYTES = 64 << 20  # sums of large strata that a task holds before it passes them on


def shape_vector(x: str = "ax", y: str = "ay") -> Column:
    """Aligned shape as x1, y1, x2, y2, ..."""
    return interleaved(F.col(x), F.col(y))


def _long(df: DataFrame, vector: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, F.posexplode_outer(vector).alias("pos", "v"))


def within_group_variance(df: DataFrame, group: str, vector: str = "v") -> DataFrame:
    """Per group: size and mean squared distance to the centroid (n-1); NULL for one row."""
    per_coordinate = _long(df, vector, [group]).groupBy(group, "pos").agg(
        F.var_samp("v").alias("var"), F.count(F.lit(1)).alias("n")
    )
    return per_coordinate.groupBy(group).agg(
        F.max("n").alias("n"), F.sum("var").alias("shape_variance")
    )


def between_within(df: DataFrame, group: str, vector: str = "v") -> DataFrame:
    """One row: between, within and total sum of squares of one factor."""
    cells = _long(df, vector, [group]).groupBy(group, "pos").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")
    )
    per_coordinate = cells.groupBy("pos").agg(
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"),
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("q").alias("q"),
    )
    grand = F.col("s") * F.col("s") / F.col("n")
    return per_coordinate.agg(
        F.sum(F.col("b") - grand).alias("ss_between"),
        F.sum(F.col("q") - F.col("b")).alias("ss_within"),
        F.sum(F.col("q") - grand).alias("ss_total"),
    )


def _level_sums(df: DataFrame, levels: Sequence[str], vector: str) -> DataFrame:
    """Per depth of nesting: cells, sum of |S|^2/n and sum of squares.

    Coordinates are first summed inside the finest cells; only those sums go
    through the rollup."""
    checked = [
        F.coalesce(F.col(c).cast("string"), F.raise_error(F.lit(f"level {c!r}: missing values")).cast("string")).alias(c)
        for c in levels
    ]
    fine = _long(df.select(*checked, vector), vector, levels).groupBy("pos", *levels).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")
    )
    rolled = fine.rollup("pos", *levels).agg(
        F.grouping_id().alias("gid"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
    )
    depth = F.lit(len(levels)) - F.bit_count(F.col("gid"))
    width = F.max("pos") + 1  # coordinates are numbered from 0
    return (
        rolled.filter(F.col("pos").isNotNull())
        .groupBy(depth.alias("depth"))
        .agg(
            (F.count(F.lit(1)) / width).cast("long").alias("cells"),
            F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"),
            F.sum("q").alias("q"),
            (F.sum("n") / width).cast("long").alias("rows"),
        )
    )


def nested_anova(
    df: DataFrame,
    levels: Sequence[str],
    vector: str = "v",
    n_perm: int = 0,
    seed: int | None = None,
    row_id: str = "ord",
) -> DataFrame:
    """SS, df, MS, F per level (broad to fine) and a residual row; p when ``n_perm``.

    Cells are cumulative, so a caste of two species counts as two cells."""
    if n_perm and seed is None:
        raise ValueError("n_perm > 0 needs a seed")
    if n_perm:
        df = pinned(df.select(*levels, vector, row_id))
    k = len(levels)
    # k+1 rows reach this window
    before = Window.partitionBy(F.lit(0)).orderBy("depth")
    sums = _level_sums(df, levels, vector)
    names = F.array(*[F.lit("total"), *[F.lit(name) for name in levels]])
    level_row = F.struct(
        F.col("depth").cast("int").alias("rank"),
        F.get(names, F.col("depth")).alias("source"),
        (F.col("b") - F.col("b0")).alias("ss"),
        (F.col("cells") - F.col("cells0")).alias("df"),
    )
    residual = F.struct(
        F.lit(k + 1).alias("rank"),
        F.lit("Residual").alias("source"),
        (F.col("q") - F.col("b")).alias("ss"),
        (F.col("rows") - F.col("cells")).alias("df"),
    )
    steps = sums.withColumn("b0", F.lag("b").over(before)).withColumn("cells0", F.lag("cells").over(before))
    rows = steps.filter(F.col("depth") > 0).select(
        F.explode(F.when(F.col("depth") == k, F.array(level_row, residual)).otherwise(F.array(level_row))).alias("r")
    ).select("r.*")
    mean = F.when(F.col("df") > 0, F.col("ss") / F.col("df"))
    whole = Window.partitionBy(F.lit(0))
    rated = rows.withColumn("ms", mean).withColumn(
        "ms_residual", F.max(F.when(F.col("source") == "Residual", F.col("ms"))).over(whole)
    )
    table = rated.select(
        "rank", "source", "ss", "df", "ms",
        F.when(F.col("source") != "Residual", F.try_divide("ms", "ms_residual")).alias("f"),
    )
    if not n_perm:
        return table.withColumn("p", F.lit(None).cast("double"))
    values = permutation_p_values(df, levels, vector, n_perm, seed, row_id)
    p = df.sparkSession.createDataFrame([(n, v) for n, v in values.items()], "source string, p double")
    return table.join(F.broadcast(p), "source", "left").select(*table.columns, "p")


# --- permutations ------------------------------------------------------------------------------


def permutation_p_values(
    df: DataFrame, levels: Sequence[str], vector: str, n_perm: int, seed: int, row_id: str = "ord"
) -> dict[str, float]:
    """(1 + #{SS_perm >= SS_obs}) / (n_perm + 1) per level.

    Labels of a level are shuffled inside each cell of the level above (over
    everything for the broadest). Deterministic in (seed, row ids)."""
    sums = {r["depth"]: r for r in _level_sums(df, levels, vector).collect()}  # k+1 rows
    slack = 1e-9 * (sums[0]["q"] - sums[0]["b"])
    out = {}
    for depth, name in enumerate(levels, start=1):
        observed = sums[depth]["b"] - sums[depth - 1]["b"]
        q = _permuted_sums(df, levels[: depth - 1], name, vector, n_perm, seed, row_id)
        hits = int((q - sums[depth - 1]["b"] >= observed - slack).sum())
        out[name] = (1 + hits) / (n_perm + 1)
    return out


#: Rounds and modulus of the draws.
ROUNDS, PRIME = 4, (1 << 31) - 1


def round_keys(seed: int, name: str, perm: int, stratum: str) -> list[int]:
    """The keys of one permutation of one stratum."""
    digest = sha256(f"{seed}|{name}|{perm}|{stratum}".encode()).hexdigest()
    return [int(digest[8 * r : 8 * r + 8], 16) % PRIME for r in range(ROUNDS)]


def half_bits(n: np.ndarray) -> np.ndarray:
    """Bits of half a number, so that two halves hold 0 .. n - 1; three at least, for variety in small strata."""
    bits = np.ceil(np.log2(np.maximum(np.asarray(n, dtype=np.float64), 2.0))).astype(np.int64)
    return np.maximum(3, (bits + 1) // 2)


def drawn_places(places: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each of the places 0 .. n - 1 goes: a keyed bijection, so no row needs to be compared with another.

    A Feistel network permutes the numbers of ``2 * half_bits`` bits; what it sends beyond n goes through it again until it is
    inside. ``n`` and ``keys`` (rows of ``ROUNDS``) belong to the places one by one."""
    bits = half_bits(n)
    mask = (np.int64(1) << bits) - 1
    x = places.astype(np.int64)
    todo = np.arange(len(x))
    while len(todo):
        y, b, m = x[todo], bits[todo], mask[todo]
        for r in range(ROUNDS):
            k, low = keys[todo, r], y & m
            z = (low + k) % PRIME
            z = (z * z + k) % PRIME
            y = (low << b) | ((y >> b) ^ (((z * z) % PRIME >> 8) & m))
        x[todo] = y
        todo = todo[y >= n[todo]]
    return x


def _permuted_sums(
    df: DataFrame, parents: Sequence[str], label: str, vector: str, n_perm: int, seed: int, row_id: str
) -> np.ndarray:
    """Sum over cells of |S|^2/n, for every permutation of one level.

    A stratum's rows are numbered once, by (label, row id). Permutation ``p`` moves the row at a place to the place that a keyed
    bijection gives, and the row takes the label that stands there: a function of its place and of the labels' first
    places, without a sort or a row per permutation. The same rule holds for every stratum. Those that fit in a task are
    numbered whole, many per task; larger ones by one distributed sort, and their batches add up before anything is shuffled."""
    spark = df.sparkSession
    size = setting(spark, "permutationRows", PERMUTATION_ROWS)
    stratum = F.to_json(F.struct(*parents)) if parents else F.lit("all")
    rows = df.select(
        stratum.alias("stratum"),
        F.col(label).cast("string").alias("label"),
        F.col(row_id).cast("string").alias("rid"),
        F.col(vector).alias("v"),
    )
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("top")).first()
    total = np.zeros(n_perm)
    if not totals["rows"]:
        return total
    small, large = rows, None
    if totals["top"] > size:
        placed = lookup(rows, sizes.filter(F.col("n") > size).select("stratum", F.lit(True).alias("large")), ["stratum"])
        small, large = placed.filter(F.col("large").isNull()).drop("large"), placed.filter("large").drop("large")
    buckets = max(1, ceil(totals["rows"] / size))
    per_bucket = small.withColumn("bucket", F.pmod(F.xxhash64("stratum"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        _whole_strata_kernel(label, n_perm, seed), "q array<double>"
    )
    for r in per_bucket.select(F.posexplode_outer("q").alias("pos", "q")).groupBy("pos").agg(F.sum("q").alias("q")).collect():
        if r["pos"] is not None:
            total[r["pos"]] += r["q"]
    if large is not None:
        for r in _large_strata(large, label, n_perm, seed).collect():  # one number per permutation
            total[r["perm"]] += r["q"]
    return total


def _large_strata(rows: DataFrame, name: str, n_perm: int, seed: int) -> DataFrame:
    """(perm, q) of strata that are numbered by a distributed sort of ids and labels. A row comes with its place and its
    stratum's labels and their first places; tasks add up vectors per label and permutation."""
    held = numbered(rows.select("stratum", "label", "rid"), ["stratum"], ["label", "rid"], "place", start=0)
    cells = rows.groupBy("stratum", "label").agg(F.count(F.lit(1)).alias("n"))
    bounds = cells.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("cells"))
    bounds = bounds.select("stratum", F.col("cells.label").alias("names"), F.col("cells.n").alias("sizes"))
    joined = rows.select("stratum", "rid", "v").join(held.select("stratum", "rid", "place"), ["stratum", "rid"]).join(bounds, "stratum")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        names: dict[str, list[str]] = {}
        keys: dict[str, np.ndarray] = {}

        def added() -> Iterator[pa.RecordBatch]:
            for k, s in sums.items():
                for perm in range(n_perm):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(names[k])), pa.array(names[k]), pa.array([perm] * len(names[k]), pa.int32()), list_column(s[perm])],
                        ["stratum", "label", "perm", "s"],
                    )
            sums.clear()

        for batch in batches:
            x = matrix(batch.column("v"))
            strata = np.asarray(batch.column("stratum").to_pylist(), dtype=object)
            places = batch.column("place").to_numpy()
            for k in dict.fromkeys(strata.tolist()):
                inside = np.flatnonzero(strata == k)
                counts = batch.column("sizes")[int(inside[0])].values.to_numpy()
                ends, n = np.cumsum(counts), int(counts.sum())
                if k not in keys:
                    keys[k] = np.array([round_keys(seed, name, perm, k) for perm in range(n_perm)], dtype=np.int64)
                if k not in sums:
                    names[k] = batch.column("names")[int(inside[0])].as_py()
                    sums[k] = np.zeros((n_perm, len(counts), x.shape[1]))
                own, own_n = x[inside], np.full(len(inside), n)
                for perm in range(n_perm):
                    drawn = drawn_places(places[inside], own_n, np.broadcast_to(keys[k][perm], (len(inside), ROUNDS)))
                    np.add.at(sums[k][perm], np.searchsorted(ends, drawn, side="right"), own)
            if sum(s.nbytes for s in sums.values()) > PARTIAL_BYTES:
                yield from added()
        yield from added()

    partial = joined.mapInArrow(run, "stratum string, label string, perm int, s array<double>")
    coordinates = partial.select("stratum", "label", "perm", F.posexplode_outer("s").alias("pos", "s"))
    summed = coordinates.groupBy("stratum", "label", "perm", "pos").agg(F.sum("s").alias("s"))
    return summed.join(cells, ["stratum", "label"]).groupBy("perm").agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"))


def _whole_strata_kernel(name: str, n_perm: int, seed: int):
    def run(key, table):
        rid = np.asarray(table.column("rid").to_pylist(), dtype=str)
        names = np.asarray(table.column("stratum").to_pylist(), dtype=str)
        labels = np.asarray(table.column("label").to_pylist(), dtype=str)
        start = np.lexsort((rid, labels, names))
        names, labels = names[start], labels[start]
        x = matrix(table.column("v").combine_chunks())[start]
        opens = np.r_[True, names[1:] != names[:-1]]
        first = np.flatnonzero(opens | np.r_[True, labels[1:] != labels[:-1]])
        sizes = np.diff(np.r_[first, len(x)])
        stratum = np.cumsum(opens) - 1
        base = np.flatnonzero(opens)
        n = np.diff(np.r_[base, len(x)])[stratum]
        base = base[stratum]
        places = np.arange(len(x)) - base
        at = np.empty(len(x), dtype=np.int64)
        out = np.empty(n_perm)
        for perm in range(n_perm):
            keys = np.array([round_keys(seed, name, perm, k) for k in names[opens]], dtype=np.int64)[stratum]
            at[base + drawn_places(places, n, keys)] = np.arange(len(x))
            s = np.add.reduceat(x[at], first, axis=0)
            out[perm] = ((s * s).sum(axis=1) / sizes).sum()
        return pa.table({"q": pa.array([out.tolist()], type=pa.list_(pa.float64()))})

    return run
