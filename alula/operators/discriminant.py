"""PCA and linear discriminant models of aligned shapes.

Components need one triangular factor of all rows, discriminants only sums (counts, class
sums, one product matrix), so each fit is a distributed aggregation followed by a solve of
model size. Cross-validation takes a specimen's few rows out of the inverse instead of refitting."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.operators.arrow import append_arrow, free_names, list_column, matrix, shape_matrix, summed_vectors
from alula.operators.dataset import EmptyDatasetError
from alula.operators.reports import prediction_columns
from alula.operators.superimposition import rotate_rows, unit_shapes
from alula.schema import DOUBLES
from alula.session import broadcast_bytes, hot_group_rows, setting

RANK_TOLERANCE = 1e-4  # fixed value: relative singular values below this are dropped
FACTOR_ROWS = 4096  # rows reduced at once to a triangular factor
FACTOR_GROUPS = 64  # factors that reach the driver
FOLD_ROWS = 20_000  # rows whose specimens are cross-validated together in one task


class ModelError(ValueError):
    """A model cannot be fitted, stored or applied."""


# --- principal components ------------------------------------------------------------------


@dataclass
class Components:
    mean: np.ndarray  # (2p,)
    loadings: np.ndarray  # (k, 2p)
    explained_ratio: np.ndarray  # (k,)


def stacked_factor(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """Triangular factor of ``rows`` below what an earlier factor stands for."""
    return np.linalg.qr(rows if factor is None else np.vstack([factor, rows]), mode="r")


def triangular_factor(df: DataFrame, n_points: int, shift: np.ndarray, x: str, y: str) -> tuple[int, np.ndarray]:
    """Row count and the triangular factor of (1, shape - shift) over all rows.

    Each task reduces its rows to one factor, ``FACTOR_GROUPS`` groups of tasks to one each, and the driver combines those."""
    width = 2 * n_points + 1
    schema = "task int, n long, factor array<double>"

    def row(task: int, n: int, factor: np.ndarray) -> pa.RecordBatch:
        flat = np.zeros((width, width))
        flat[: len(factor)] = factor
        return pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int32()), pa.array([n], pa.int64()), list_column(flat.reshape(1, -1))], ["task", "n", "factor"]
        )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, n, task = None, 0, 0
        for batch in batches:
            if batch.num_rows:
                v = shape_matrix(batch, x, y) - shift
                task = batch.column("task")[0].as_py()
                n += len(v)
                for at in range(0, len(v), FACTOR_ROWS):
                    part = v[at : at + FACTOR_ROWS]
                    factor = stacked_factor(factor, np.column_stack([np.ones(len(part)), part]))
        if n:
            yield row(task, n, factor)

    def combine(table: pa.Table) -> pa.Table:
        factor = None
        for flat in matrix(table.column("factor").combine_chunks()):
            factor = stacked_factor(factor, flat.reshape(width, width))
        return pa.Table.from_batches([row(0, int(np.sum(table.column("n").to_numpy())), factor)])

    parts = df.select(x, y, F.spark_partition_id().alias("task")).mapInArrow(fold, schema)
    joined = parts.groupBy(F.pmod("task", F.lit(FACTOR_GROUPS)).alias("part")).applyInArrow(combine, schema)
    n, factor = 0, None
    for r in joined.orderBy("n").collect():  # at most FACTOR_GROUPS rows of model size
        n += r["n"]
        factor = stacked_factor(factor, np.reshape(r["factor"], (width, width)))
    return n, np.zeros((width, width)) if factor is None else factor


def fit_components(df: DataFrame, n_points: int, centre: np.ndarray, x: str = "ax", y: str = "ay") -> Components:
    """Keeps 2p - 4 components, the freedom left after planar superimposition.

    Components come from the triangular factor of the centred rows, not from their products, which would square the ratio
    of the largest to the smallest deviation. ``centre`` is any fixed shape near the data."""
    width = 2 * n_points
    shift = np.asarray(centre, dtype=float).reshape(-1)
    n, factor = triangular_factor(df, n_points, shift, x, y)
    keep = width - 4
    if n < keep:
        raise ModelError(f"{keep} components need at least {keep} rows, found {n}")
    mean = factor[0, 1:] / factor[0, 0]
    _, singular, loadings = np.linalg.svd(factor[1:, 1:])
    values = singular**2 / (n - 1)
    largest = np.abs(loadings).argmax(axis=1)
    loadings = loadings * np.sign(loadings[np.arange(width), largest])[:, None]
    return Components(mean + shift, loadings[:keep], values[:keep] / values.sum())


def with_scores(df: DataFrame, pca: Components, x: str = "ax", y: str = "ay", out: str = "scores") -> DataFrame:
    mean, loadings = pca.mean, pca.loadings

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        return [list_column((shape_matrix(batch, x, y) - mean) @ loadings.T)]

    return append_arrow(df, [T.StructField(out, DOUBLES)], kernel)


# --- linear discriminant --------------------------------------------------------------------


@dataclass
class Discriminant:
    classes: list[str]
    priors: np.ndarray
    xbar: np.ndarray
    coef: np.ndarray  # (K, d)
    intercept: np.ndarray  # (K,)
    axes: np.ndarray  # (d, r)


@dataclass
class ClassSums:
    """Sufficient statistics of a labelled score table."""

    classes: list[str]
    counts: np.ndarray  # (K,)
    sums: np.ndarray  # (K, d)
    products: np.ndarray  # (d, d)


def whitening(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Map to scores of unit pooled covariance (N - K), and the relative singular values, ascending, dropped ones included."""
    n, k = counts.sum(), len(counts)
    within = products - (sums.T / counts) @ sums
    sd = np.sqrt(np.maximum(np.diag(within), 0.0) / n)
    sd = np.where(sd == 0, 1.0, sd)
    values, vectors = np.linalg.eigh(within / np.outer(sd, sd) / (n - k))
    singular = np.sqrt(np.maximum(values, 0.0))
    kept = singular > RANK_TOLERANCE
    return vectors[:, kept] / singular[kept] / sd[:, None], singular


def solve(classes: Sequence[str], counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """Linear discriminant from sums: frequency priors, pooled covariance with N - K."""
    n, k = counts.sum(), len(counts)
    if k < 2:
        raise ModelError("at least two classes are needed")
    means = sums / counts[:, None]
    priors = counts / n
    xbar = priors @ means
    whiten, _ = whitening(counts, sums, products)
    spread = (np.sqrt(n * priors / (k - 1))[:, None] * (means - xbar)) @ whiten
    _, s, vt = np.linalg.svd(spread, full_matrices=False)
    axes = whiten @ vt[s > RANK_TOLERANCE * s[0]].T
    projected = (means - xbar) @ axes
    coef = projected @ axes.T
    intercept = -0.5 * (projected**2).sum(axis=1) + np.log(priors) - xbar @ coef.T
    return Discriminant(list(classes), priors, xbar, coef, intercept, axes)


def posteriors(x: np.ndarray, coef: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    logits = x @ coef.T + intercept
    logits -= logits.max(axis=1, keepdims=True)
    e = np.exp(logits)
    return e / e.sum(axis=1, keepdims=True)


def class_sums(df: DataFrame, label: str, scores: str = "scores") -> ClassSums:
    """Counts and sums per class, products over everything (model-sized results)."""
    labelled = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias(label), scores)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Score sums per class, and the product matrix under the NULL class."""
        acc: dict[str, list] = {}
        products, total = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(scores))
            products = products + x.T @ x
            total += len(x)
            names, at = np.unique(np.asarray(batch.column(label).to_pylist(), dtype=str), return_inverse=True)
            part = np.zeros((len(names), x.shape[1]))
            np.add.at(part, at, x)
            for name, s, n in zip(names.tolist(), part, np.bincount(at)):
                slot = acc.setdefault(name, [0, np.zeros(x.shape[1])])
                slot[0] += int(n)
                slot[1] += s
        for name, (n, s) in acc.items():
            yield name, n, s
        if total:
            yield None, total, products.ravel()

    most = broadcast_bytes(df.sparkSession) // 8
    rows = summed_vectors(labelled, [label], fold).limit(most + 1).collect()  # model-sized, and checked
    if len(rows) > most:
        raise ModelError("classes and scores exceed the model size limit")
    if not rows:
        raise EmptyDatasetError("no labelled row")
    d = round(sum(r[label] is None for r in rows) ** 0.5)
    classes = sorted({r[label] for r in rows if r[label] is not None})
    at = {c: i for i, c in enumerate(classes)}
    counts, sums, products = np.zeros(len(classes)), np.zeros((len(classes), d)), np.zeros(d * d)
    for r in rows:
        if r[label] is None:
            products[r["pos"]] = r["total"]
        else:
            counts[at[r[label]]] = r["n"]
            sums[at[r[label]], r["pos"]] = r["total"]
    return ClassSums(classes, counts, sums, products.reshape(d, d))


def fit_discriminant(df: DataFrame, label: str, scores: str = "scores") -> Discriminant:
    s = class_sums(df, label, scores)
    return solve(s.classes, s.counts, s.sums, s.products)


# --- leave one specimen out ------------------------------------------------------------------


def _fold_model(totals: ClassSums, codes: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Present classes, coef and intercept after removing the given rows."""
    k, d = totals.sums.shape
    held = np.bincount(codes, minlength=k)
    out = np.zeros((k, d))
    np.add.at(out, codes, x)
    return _reduced_model(totals, held, out, x.T @ x)


def _reduced_model(totals: ClassSums, held: np.ndarray, sums: np.ndarray, products: np.ndarray):
    counts = totals.counts - held
    present = np.flatnonzero(counts > 0)
    left = (totals.sums - sums)[present]
    model = solve([totals.classes[i] for i in present], counts[present], left, totals.products - products)
    return present, model.coef, model.intercept


class Downdate:
    """Posteriors of rows under a model without them, by a low-rank change of the pooled inverse.

    In scores of unit pooled covariance, a specimen's m rows take Z'CZ out of the identity, where Z are the rows less their
    class means and C adds a class's mean shift; the inverse of what remains needs one m x m solve. A fold whose
    rank could differ from that of all rows, or that has more rows than scores, is solved in full."""

    def __init__(self, totals: ClassSums):
        self.totals = totals
        self.n = totals.counts.sum()
        self.whiten, singular = whitening(totals.counts, totals.sums, totals.products)
        kept = singular > RANK_TOLERANCE
        self.least_kept = singular[kept].min() if kept.any() else 0.0
        self.most_dropped = singular[~kept].max() if not kept.all() else 0.0
        self.centre = totals.sums.sum(axis=0) / self.n
        self.means = (totals.sums / totals.counts[:, None] - self.centre) @ self.whiten

    def posteriors(self, codes: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.totals.counts)))
        fast = self._reduced(codes, (x - self.centre) @ self.whiten) if len(x) < self.whiten.shape[1] else None
        if fast is None:
            present, coef, intercept = _fold_model(self.totals, codes, x)
            fast = present, x @ coef.T + intercept
        present, logits = fast
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        out[:, present] = e / e.sum(axis=1, keepdims=True)
        return out

    def _reduced(self, codes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Present classes and logits, or None if the fold's rank is in doubt."""
        k = len(self.totals.counts)
        held = np.bincount(codes, minlength=k)
        counts = self.totals.counts - held
        present = np.flatnonzero(counts > 0)
        n, classes = counts.sum(), len(present)
        if classes < 2 or n <= classes:
            return None
        sums = self.means * self.totals.counts[:, None]
        np.subtract.at(sums, codes, y)
        means = sums[present] / counts[present, None]
        z = y - self.means[codes]
        same = codes[:, None] == codes[None, :]
        # Z is of unit covariance with N - K; the sums of squares below are those of the scatter.
        gram = z @ z.T / (self.n - k)
        share = np.where(counts[codes] > 0, 1.0 / np.maximum(counts[codes], 1), 0.0)
        change = np.eye(len(y)) + same * share[:, None]
        root = np.linalg.cholesky(change)
        left = 1.0 - np.linalg.eigvalsh(root.T @ gram @ root).max()
        if left <= 0 or self.least_kept * left**0.5 <= 2 * RANK_TOLERANCE or self.most_dropped >= RANK_TOLERANCE / 2 * left**0.5:
            return None
        inner = np.linalg.inv(np.linalg.inv(change) - gram) / (self.n - k)
        scale = (n - classes) / (self.n - k)
        turned = means + (means @ z.T) @ inner @ z  # means times the inverse without the fold
        priors = counts[present] / n
        offset = priors @ means
        spread = np.sqrt(priors)[:, None] * (means - offset)
        strength = np.linalg.eigvalsh(spread @ spread.T + (spread @ z.T) @ inner @ (z @ spread.T))
        if strength[1] <= (2 * RANK_TOLERANCE) ** 2 * strength[-1]:
            return None
        return present, scale * (y @ turned.T - 0.5 * (means * turned).sum(axis=1)) + np.log(priors)


def leave_group_out(
    df: DataFrame, label: str, group: str = "inv_id", scores: str = "scores"
) -> tuple[DataFrame, list[str]]:
    """The labelled rows with their class probabilities, ``proba``, from a model that never saw their specimen.

    Specimens are handled many per task, and rows travel once, with all their columns. A specimen too large for one task
    is reduced to its sums first and its rows are then scored wherever they are. A class absent from a fold has
    probability 0 there."""
    spark = df.sparkSession
    totals = class_sums(df, label, scores)
    names = np.array(totals.classes, dtype=str)
    grp, lab, bucket_of = free_names(df, "grp", "lab", "bucket")
    rows = df.filter(F.col(label).isNotNull()).select(
        "*", F.col(group).cast("string").alias(grp), F.col(label).cast("string").alias(lab)
    )
    sizes = rows.groupBy(grp).agg(F.count(F.lit(1)).alias("n"))
    limit = min(hot_group_rows(spark), setting(spark, "foldGroupRows", 200_000))
    large = sizes.filter(F.col("n") > limit).select(grp)
    has_large = not large.isEmpty()
    n_rows = int(totals.counts.sum())
    buckets = max(1, ceil(n_rows / setting(spark, "foldRows", FOLD_ROWS)))
    small = rows.join(large, grp, "left_anti") if has_large else rows
    columns = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("proba", DOUBLES)])
    model = Downdate(totals)

    def fold(table):
        groups = np.asarray(table.column(grp).to_pylist(), dtype=object)
        codes = np.searchsorted(names, np.asarray(table.column(lab).to_pylist(), dtype=str))
        x = matrix(table.column(scores).combine_chunks())
        out = np.zeros((len(x), len(names)))
        _, at = np.unique(groups.astype(str), return_inverse=True)
        order = np.argsort(at, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            out[members] = model.posteriors(codes[members], x[members])
        return table.select(columns).append_column("proba", list_column(out))

    scored = small.groupBy(F.pmod(F.xxhash64(grp), F.lit(buckets)).alias(bucket_of)).applyInArrow(fold, schema)
    if has_large:
        held = rows.join(large, grp, "left_semi")
        scored = scored.unionByName(_score_large(held, totals, scores, grp, lab, columns, schema))
    return scored, totals.classes


def _score_large(
    rows: DataFrame, totals: ClassSums, scores: str, grp: str, lab: str, columns: list[str], schema: T.StructType
) -> DataFrame:
    k, d = totals.sums.shape
    (weight,) = free_names(rows, "w")
    names = np.array(totals.classes, dtype=str)

    def per_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        acc: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(scores))
            codes = np.searchsorted(names, np.asarray(batch.column(lab).to_pylist(), dtype=str))
            groups, at = np.unique(np.asarray(batch.column(grp).to_pylist(), dtype=str), return_inverse=True)
            for g, name in enumerate(groups.tolist()):
                mine = at == g
                s = np.zeros((k, d))
                np.add.at(s, codes[mine], x[mine])
                flat = np.concatenate([np.bincount(codes[mine], minlength=k), s.ravel(), (x[mine].T @ x[mine]).ravel()])
                acc[name] = acc.get(name, 0) + flat
                seen[name] = seen.get(name, 0) + int(mine.sum())
        for name, flat in acc.items():
            yield name, seen[name], flat

    sums = summed_vectors(rows.select(grp, lab, scores), [grp], per_group)

    def models(key, table):
        flat = np.zeros(k + k * d + d * d)
        flat[np.asarray(table.column("pos"))] = np.asarray(table.column("total"))
        present, coef, intercept = _reduced_model(
            totals, flat[:k], flat[k : k + k * d].reshape(k, d), flat[k + k * d :].reshape(d, d)
        )
        weights = np.full((k, d + 1), np.nan)
        weights[present] = np.column_stack([coef, intercept])
        return pa.table({grp: [key[0].as_py()], weight: pa.array([weights.ravel().tolist()], type=pa.list_(pa.float64()))})

    # one weight row per large specimen; each large specimen brings at least the limit's rows
    weights = sums.groupBy(grp).applyInArrow(models, T.StructType([T.StructField(grp, T.StringType()), T.StructField(weight, DOUBLES)]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(scores))
            w = matrix(batch.column(weight)).reshape(len(x), k, d + 1)
            logits = np.einsum("nd,nkd->nk", x, w[:, :, :d]) + w[:, :, d]
            logits = np.where(np.isnan(logits), -np.inf, logits)
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), list_column(e / e.sum(axis=1, keepdims=True))], names=[*columns, "proba"]
            )

    return rows.join(weights, grp).select(*columns, weight).mapInArrow(score, schema)


# --- trained model ---------------------------------------------------------------------------------


@dataclass
class TrainedModel:
    mean_shape: np.ndarray  # (p, 2)
    pca: Components
    lda: Discriminant
    level: str
    n_axes: int = 2
    meta: dict = field(default_factory=dict)

    @property
    def n_points(self) -> int:
        return len(self.mean_shape)

    @property
    def classes(self) -> list[str]:
        return self.lda.classes

    def label(self, fallback: str = "") -> str:
        return self.meta.get("model_name") or fallback


def projection_axes(n_classes: int, wanted: int = 2) -> int:
    axes = min(wanted, n_classes - 1)
    if axes < 1:
        raise ModelError("a projection needs at least two classes")
    return axes


def save_model(spark: SparkSession, model: TrainedModel, path: str) -> None:
    """Four Parquet tables; every row carries its position."""
    p, pca, lda = model.mean_shape, model.pca, model.lda

    def write(rows: list[tuple], schema: str, name: str) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    write([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "i int, x double, y double", "model_shape")
    write(
        [(-1, 0.0, pca.mean.tolist())]
        + [(i, float(r), v.tolist()) for i, (r, v) in enumerate(zip(pca.explained_ratio, pca.loadings))],
        "component int, explained_ratio double, loadings array<double>", "model_pca",
    )
    write(
        [
            (i, c, float(lda.priors[i]), float(lda.intercept[i]), lda.coef[i].tolist())
            for i, c in enumerate(lda.classes)
        ],
        "i int, class string, prior double, intercept double, coef array<double>", "model_lda_class",
    )
    meta = {
        "level": model.level, "n_points": model.n_points, "n_components": len(pca.loadings),
        "n_classes": len(lda.classes), "n_axes": model.n_axes, "xbar": lda.xbar.tolist(),
        "axes": lda.axes.tolist(), **model.meta,
    }
    write([(k, json.dumps(v)) for k, v in meta.items()], "key string, value string", "model_meta")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Reads the tables back and checks that they belong together."""
    try:
        meta = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/model_meta").collect()}
        shape = spark.read.parquet(f"{path}/model_shape").orderBy("i").collect()
        parts = spark.read.parquet(f"{path}/model_pca").orderBy("component").collect()
        classes = spark.read.parquet(f"{path}/model_lda_class").orderBy("i").collect()
    except Exception as problem:  # a missing or foreign folder
        raise ModelError(f"{path} does not hold a trained model: {problem}") from problem
    counts = (len(shape), len(parts) - 1, len(classes))
    expected = (meta.get("n_points"), meta.get("n_components"), meta.get("n_classes"))
    if counts != expected:
        raise ModelError(f"{path}: incomplete model, found {counts}, expected {expected}")
    pca = Components(
        np.array(parts[0]["loadings"]),
        np.array([r["loadings"] for r in parts[1:]]),
        np.array([r["explained_ratio"] for r in parts[1:]]),
    )
    lda = Discriminant(
        [r["class"] for r in classes], np.array([r["prior"] for r in classes]), np.array(meta.pop("xbar")),
        np.array([r["coef"] for r in classes]), np.array([r["intercept"] for r in classes]), np.array(meta.pop("axes")),
    )
    for key in ("n_points", "n_components", "n_classes"):
        meta.pop(key)
    return TrainedModel(
        np.array([[r["x"], r["y"]] for r in shape]), pca, lda, meta.pop("level"), meta.pop("n_axes"), meta
    )


def score_shapes(model: TrainedModel, df: DataFrame, projection: bool = False) -> DataFrame:
    """Replaces ``x``/``y`` by the distance to the model's mean shape and class probabilities.

    Rows with another landmark count are skipped. Works on batch and streaming
    frames alike: align, project and score happen inside one Arrow pass."""
    ref = model.mean_shape[:, 0] + 1j * model.mean_shape[:, 1]
    pca, lda = model.pca, model.lda
    axes = lda.axes[:, : model.n_axes]
    p = model.n_points

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        a = rotate_rows(unit_shapes(batch)[0], ref)
        distance = np.sqrt((np.abs(a - ref) ** 2).sum(axis=1))
        vectors = np.stack([a.real, a.imag], axis=2).reshape(len(a), 2 * p)
        x = (vectors - pca.mean) @ pca.loadings.T
        added = [pa.array(distance), list_column(posteriors(x, lda.coef, lda.intercept))]
        if projection:
            added.append(list_column((x - lda.xbar) @ axes))
        return added

    fields = [T.StructField("procrustes_distance", T.DoubleType()), T.StructField("proba", DOUBLES)]
    if projection:
        fields.append(T.StructField("lda", DOUBLES))
    return append_arrow(df.filter(F.size("x") == p), fields, kernel, drop=("x", "y"))


def predict(model: TrainedModel, df: DataFrame, require_rows: bool = True) -> DataFrame:
    """Top-three predictions and the typicality distance."""
    if require_rows and df.filter(F.size("x") == model.n_points).isEmpty():
        raise EmptyDatasetError(f"no specimen has the model's {model.n_points} landmarks")
    return prediction_columns(score_shapes(model, df), model.level, model.classes)

