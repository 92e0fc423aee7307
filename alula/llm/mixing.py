"""Mixing documents to target domain weights with soft memberships.

A classifier learnt from a table of labels gives every document a posterior over domains. Document rates r >= 0 then
minimise

    1/2 sum_k (sum_d r_d t_d p_dk / W - B w_k)^2 / s_k  +  ridge/2 sum_d (t_d / W) (r_d - 1)^2

(t tokens, p posteriors, W all tokens, w target weights, s the domains' shares before, B the budget as a share of W): expected
domain totals meet the targets, and among rates that do, those nearest to 1 win. The solver is accelerated projected
gradient descent. A step's gradient needs the K domain totals only, so each step is one aggregation over a narrow table; a
document's rate after n steps follows from its posterior and the n residual vectors, and is never stored or shuffled.

A rate of 2.3 means two copies, and a third with probability 0.3, drawn by a hash of the id. Null and empty texts have no
tokens and the posterior of the intercepts. Without any labelled row every rate is 1. Labels that are null, or that belong
to no document, are ignored; a document with several labels counts once for each.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import TEXT_BATCH_ROWS, Remembered, extended, free_name, own_caches, send_small_batches, slices, unit_hash, written

#: Labelled documents that the classifier learns from at most, and the longest of them in characters.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 100_000
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 14, 1 << 8
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS
WORD_CACHE = 200_000
FEWEST_STEPS, TOLERANCE, RIDGE = 60, 1e-6, 1e-3


def _word_buckets(word: str) -> int:
    """Bucket of the word in lower case and of its shape, as one number.

    A shape is the case of the word, whether it has digits, and the last characters that are neither letters nor digits."""
    lower = word.lower()
    case = 0 if word == lower else 1 if word[1:] == lower[1:] else 2 if word == word.upper() else 3
    end = len(word)
    while end and not word[end - 1].isalnum() and len(word) - end < 3:
        end -= 1
    shape = f"{case}{'0' if word.isalpha() else '1' if any(map(str.isdigit, word)) else '2'}{word[end:]}"
    value = zlib.crc32(lower.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
    return value * SHAPE_BUCKETS + zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPE_BUCKETS


_buckets = Remembered(_word_buckets, WORD_CACHE, "mixing")


def features(text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, feature numbers and values: words by presence, shapes by their share of the words."""
    words = (text or "").split()
    if not words:
        return 0, np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    codes = np.fromiter(map(_buckets.__getitem__, words), dtype=np.int64, count=len(words))
    present = np.unique(codes // SHAPE_BUCKETS)
    shapes = np.bincount(codes % SHAPE_BUCKETS, minlength=SHAPE_BUCKETS)
    used = np.flatnonzero(shapes)
    values = np.concatenate([np.full(len(present), 0.3), 5.0 * shapes[used] / len(words)]).astype(np.float32)
    return len(words), np.concatenate([present, WORD_BUCKETS + used]).astype(np.int32), values


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # (FEATURES + 1) x domains, the last row holds intercepts

    def posterior(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not self.domains:
            return np.zeros(0)
        z = values @ self.weights[at] + self.weights[-1]
        e = np.exp(z - z.max())
        return e / e.sum()


def fit_domains(rows: list[tuple[str, np.ndarray, np.ndarray]], steps: int = 60) -> DomainModel:
    """Multinomial logistic regression by Adam on rows (domain, feature numbers, values)."""
    domains = sorted({r[0] for r in rows})
    w = np.zeros((FEATURES + 1, len(domains)))
    if len(domains) < 2:
        return DomainModel(domains, w)
    at = np.concatenate([np.append(r[1], FEATURES) for r in rows])
    values = np.concatenate([np.append(r[2], 1.0) for r in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) + 1 for r in rows])
    truth = np.zeros((len(rows), len(domains)))
    truth[np.arange(len(rows)), [domains.index(r[0]) for r in rows]] = 1.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.stack([np.bincount(row, values * w[at, k], len(rows)) for k in range(len(domains))], axis=1)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - truth) / len(rows)
        g = np.stack([np.bincount(at, values * error[row, k], FEATURES + 1) for k in range(len(domains))], axis=1) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return DomainModel(domains, w.astype(np.float32))


def train_domains(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DomainModel:
    """Learns from at most ``rows`` rows of ``labels`` (doc_id, domain), taken by a hash of the id from all of them."""
    known = labels.where("doc_id is not null and domain is not null").select("doc_id", F.col("domain").cast("string").alias("domain"))
    chosen = known.distinct().orderBy(unit_hash("doc_id", seed=2), "doc_id", "domain").limit(rows)
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", F.col("text").alias("__text"))
    # one text for each label, the least, so that an id with many rows takes one place
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "domain").agg(F.min("__text").alias("__text"))
    send_small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("domain"), pa.array([f[1] for f in found], pa.list_(pa.int32())), pa.array([f[2] for f in found], pa.list_(pa.float32()))],
                ["doc_id", "domain", "at", "values"],
            )

    schema = extended(sample.select("doc_id", "domain").schema, "at array<int>, values array<float>")
    got = sorted(sample.mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], r["domain"], r["at"]))
    return fit_domains([(r["domain"], np.array(r["at"], dtype=np.int32), np.array(r["values"], dtype=np.float32)) for r in got])


def memberships(docs: DataFrame, model: DomainModel, keep: list[str]) -> DataFrame:
    """``keep`` columns with __n_tokens (words) and __posterior, in the order of the model's domains (the last two columns, with
    underscores in front where ``keep`` has these names). Only texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    send_small_batches(docs.sparkSession)

    @F.arrow_udf("struct<n:bigint,p:array<double>>")
    def membership(texts: pa.Array) -> pa.Array:
        own_caches("mixing")
        fitted, counts, found = shared.value, [], []
        for at in range(0, len(texts), TEXT_BATCH_ROWS):
            for text in texts.slice(at, TEXT_BATCH_ROWS).to_pylist():
                n, where, values = features(text)
                counts.append(n)
                found.append(fitted.posterior(where, values).astype(np.float64))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["n", "p"])

    held = free_name(keep, "__membership")
    scored = docs.select(*keep, membership(F.col("text").cast("string")).alias(held))
    return scored.select(*keep, F.col(f"{held}.n").alias(free_name(keep, "__n_tokens")), F.col(f"{held}.p").alias(free_name(keep, "__posterior")))


@dataclass
class RateFit:
    """The solver's state: everything a rate depends on besides the document's posterior."""

    domains: list[str]
    targets: np.ndarray
    shares: np.ndarray
    step: float
    ridge: float
    residuals: list[np.ndarray] = field(default_factory=list)
    settled: bool = True  # whether the last two residuals agree within the tolerance

    def points(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates, and the extrapolated points at which the next residual is taken, of posteriors (rows x domains)."""
        rate = point = np.ones(len(p))
        t = 1.0
        for residual in self.residuals:
            new = np.maximum(0.0, point - self.step * (p @ (residual / self.shares) + self.ridge * (point - 1)))
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            point, rate, t = new + (t - 1) / after * (new - rate), new, after
        return rate, point


def _totals(rows: DataFrame, fit: RateFit) -> np.ndarray:
    """Sums of point x tokens x posterior by domain: partial sums per task, added up by Spark."""
    k = len(fit.domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            p = np.column_stack([batch.column(f"p{i}").to_numpy(zero_copy_only=False) for i in range(k)])
            total += (fit.points(p)[1] * batch.column("__n_tokens").to_numpy(zero_copy_only=False)) @ p
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"s{i}" for i in range(k)])

    partial = rows.mapInArrow(run, ", ".join(f"s{i} double" for i in range(k)))
    return np.array([x or 0.0 for x in partial.agg(*[F.sum(f"s{i}") for i in range(k)]).first()])


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], budget: float = 1.0, ridge: float = RIDGE) -> RateFit:
    """Fits rates to ``targets`` (weights by domain, scaled to sum 1; absent domains 0) times ``budget``.

    The last two columns of ``members`` are tokens and posteriors. All its rows count. Steps go on until residuals settle, up to a
    number that the problem's condition gives; ``settled`` of the result says whether they did."""
    members = members.select(*[F.col(c) for c in members.columns[-2:]]).toDF("__n_tokens", "__posterior")
    k = len(domains)
    weights = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    narrow = members.select("__n_tokens", *[F.col("__posterior")[i].alias(f"p{i}") for i in range(k)])
    moments = [F.sum(F.col("__n_tokens") * F.col(f"p{i}")) for i in range(k)]
    moments += [F.sum(F.col("__n_tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in range(k) for j in range(k)]
    sums = np.array([x or 0.0 for x in narrow.agg(*moments).first()]) if k else np.zeros(0)
    everything = sums[:k].sum()
    if k < 2 or not everything or not weights.sum():
        return RateFit(domains, weights, np.ones(k), 0.0, ridge)
    shares = np.maximum(sums[:k] / everything, 1e-9)
    gram = sums[k:].reshape(k, k) / everything
    scaled = gram / np.sqrt(np.outer(shares, shares))
    fit = RateFit(domains, budget * weights / weights.sum(), shares, 1.0 / (ridge + np.linalg.eigvalsh(scaled)[-1]), ridge)
    last, fit.settled = None, False
    for _ in range(steps_bound(fit)):
        residual = _totals(narrow, fit) / everything - fit.targets
        fit.residuals.append(residual)
        if last is not None and np.abs(residual - last).max() < TOLERANCE:
            fit.settled = True
            break
        last = residual
    if not fit.settled:
        warnings.warn(f"rates had not settled after {len(fit.residuals)} steps (last change {np.abs(residual - last).max():.1e})", RuntimeWarning, stacklevel=2)
    return fit


def steps_bound(fit: RateFit) -> int:
    """Steps after which accelerated descent is surely within the tolerance: its error falls as 2 L / n^2 for curvature L = 1 / step."""
    return max(FEWEST_STEPS, int(np.ceil((2 / (fit.step * TOLERANCE)) ** 0.5)))


def rate_of(fit: RateFit, posterior: Column) -> Column:
    """The rate of a document with this posterior."""

    @F.arrow_udf("double")
    def rate(posteriors: pa.Array) -> pa.Array:
        p = posteriors.flatten().to_numpy(zero_copy_only=False).reshape(len(posteriors), len(fit.domains))
        return pa.array(fit.points(p)[0], pa.float64())

    return rate(posterior)


def copies_of(rate: Column, doc_id: Column) -> Column:
    """Copies of a document: the whole part of its rate, and one more with the rest as probability."""
    return F.floor(rate).cast("int") + (unit_hash(doc_id, seed=22) < rate - F.floor(rate)).cast("int")


def with_copies(members: DataFrame, fit: RateFit, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``members``, whose last two columns are tokens and posteriors, with __domain (the likeliest), __rate and
    __copies instead of the posterior."""
    posterior = F.col(members.columns[-1])
    names = members.columns[:-1]
    domains = F.array(*[F.lit(d) for d in fit.domains]).cast("array<string>")
    domain = F.get(domains, F.array_position(posterior, F.array_max(posterior)).cast("int") - 1)
    rated = members.select(*names, domain.alias("__domain"), rate_of(fit, posterior).alias("__rate"))
    return rated.withColumn("__copies", copies_of(F.col("__rate"), F.col(id_column)))


#: Domains of the labelled table and the mixture that is aimed at.
TARGETS = {"high": 0.95, "low": 0.03, "toxic": 0.02}


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else high or low quality; none where a label is missing."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def fit_mixture(docs: DataFrame, labels: DataFrame, keep: list[str], targets: dict[str, float] | None = None) -> tuple[DataFrame, RateFit]:
    """The written memberships of all documents with ``keep`` columns, so that texts are scored once, and the rates."""
    model = train_domains(docs, labels)
    members = written(memberships(docs, model, keep), "memberships")
    return members, fit_rates(members, model.domains, targets or TARGETS)


def mixed_rows(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its copies, with the columns of ``docs``."""
    members, fit = fit_mixture(docs, labels, docs.columns, targets)
    held = free_name(docs.columns, "__rate")
    rated = members.select(*docs.columns, rate_of(fit, F.col(members.columns[-1])).alias(held))
    copies = F.array_repeat(F.lit(0), copies_of(F.col(held), F.col("doc_id")))
    return rated.select(*docs.columns, F.explode(copies).alias(free_name(docs.columns, "__copy"))).select(*docs.columns)
