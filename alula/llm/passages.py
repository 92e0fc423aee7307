"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages: about ``PASSAGE`` characters each, cut at white space, the whole text. Every passage is
encoded as the rates of its character-class bigrams and a few word statistics, passed through one learnt layer. Gated attention
(tanh times sigmoid) weighs the passages, and a logistic unit scores the weighted mean of their representations. All weights are
learnt from document labels alone.

The training sample is bounded (``SAMPLE_ROWS`` labelled documents, ``SAMPLE_CHARS`` characters each); a document with no
text is one empty passage and gets a score like any other. A passage longer than ``PASSAGE`` without white space is cut
there. With labels of one kind only, or none, every score is the share of label 1 in the sample (0.5 without any). Null
labels and ids teach nothing; a document with several labels counts once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.llm.common import extended, free_name, slices, unit_hash, with_text

PASSAGE = 500
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 60_000
HIDDEN, ATTENTION, ROUNDS, RATE, DECAY = 24, 16, 40, 0.01, 1e-4
#: Characters of a text whose passages are encoded together.
SPAN = 1 << 18

# Fixed classes: control, blank, line break, lower, upper, digit, other letter, sentence end, other common mark, bracket or quote,
# exclamation, bar, rare mark, other.
CLASSES = 14
_COMMON = {" ": 1, "\t": 1, "\n": 2, "\r": 2, ".": 7, "?": 7, ",": 8, ";": 8, ":": 8, "-": 8, "'": 8, "!": 10, "|": 11}
_COMMON |= dict.fromkeys("()[]{}\"«»„“”’‘", 9) | dict.fromkeys("#$%&*@+=<>~^_/\\`", 12)
EXTRAS = 6
FEATURES = CLASSES * CLASSES + EXTRAS


def _class_table() -> np.ndarray:
    table = np.full(0x110000, 13, dtype=np.uint8)
    for code in range(0x3000):
        c = chr(code)
        if c in _COMMON:
            table[code] = _COMMON[c]
        elif c.isspace():
            table[code] = 1
        elif c.isalpha():
            table[code] = 5 if c.isdigit() else 4 if c.isupper() else 3 if c.islower() else 6
        elif c.isdigit():
            table[code] = 5
        elif code < 32:
            table[code] = 0
    table[0x3000:0xD800] = 6
    table[0x3000] = 1
    table[0x20000:0x30000] = 6
    return table


_tables: list[np.ndarray] = []


def encode(text: str | None) -> np.ndarray:
    """Features of every passage of a text, passages x FEATURES."""
    if not _tables:
        _tables.append(_class_table())
    out, at, text = [], 0, text or ""
    while at < len(text) or not out:
        part = text[at : at + SPAN]
        if at + SPAN < len(text):  # end with a passage, not within a word if there is a blank
            cut = part.rfind(" ", SPAN // 2)
            part = part[: cut + 1] if cut >= 0 else part
        at += max(len(part), 1)
        out.append(_encode_span(part))
    return np.concatenate(out)


def _encode_span(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(points)
    if not n:
        return np.zeros((1, FEATURES), dtype=np.float32)
    classes = _tables[0][points].astype(np.int64)
    blank = np.flatnonzero((classes == 1) | (classes == 2))
    marks = np.arange(PASSAGE, n, PASSAGE)
    near = np.searchsorted(blank, marks)
    cuts = np.where(near < len(blank), blank[np.minimum(near, len(blank) - 1)] if len(blank) else marks, marks)
    cuts = np.unique(np.where(cuts < marks + PASSAGE, cuts, marks))
    passage = np.zeros(n, dtype=np.int64)
    passage[cuts[cuts < n]] = 1
    passage = np.cumsum(passage)
    count = int(passage[-1]) + 1
    sizes = np.bincount(passage, minlength=count)
    grid = np.bincount(passage[:-1] * CLASSES**2 + classes[:-1] * CLASSES + classes[1:], minlength=count * CLASSES**2)
    rates = grid.reshape(count, CLASSES**2) / np.maximum(sizes, 1)[:, None]
    starts = np.flatnonzero((classes > 2) & np.concatenate(([True], classes[:-1] <= 2)))
    words = np.bincount(passage[starts], minlength=count)
    ends = np.flatnonzero((classes > 2) & np.concatenate((classes[1:] <= 2, [True])))
    lengths = ends - starts + 1
    mean = np.bincount(passage[starts], lengths, count) / np.maximum(words, 1)
    first = (points[starts].astype(np.int64) * 31 + points[ends]) * 31 + lengths
    keys = np.unique(passage[starts] * (1 << 40) + first % (1 << 40))
    distinct = np.bincount(keys >> 40, minlength=count) / np.maximum(words, 1)
    extras = np.column_stack([
        mean / 10, distinct, np.bincount(passage[starts], lengths <= 3, count) / np.maximum(words, 1),
        np.bincount(passage[starts], lengths > 15, count) / np.maximum(words, 1), np.log1p(sizes) / 7, np.full(count, np.log1p(n) / 12),
    ])
    return np.hstack([np.sqrt(rates), extras]).astype(np.float32)


@dataclass
class AttentionModel:
    weights: dict[str, np.ndarray]
    prior: float = 0.5

    def forward(self, bags: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """All activations for passages ``bags`` that belong to documents ``owner`` (ascending)."""
        w = self.weights
        h = np.tanh(((bags - w["mean"]) / w["scale"]) @ w["encode"] + w["bias"])
        t, s = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (t * s) @ w["w"]
        starts = np.searchsorted(owner, np.arange(n))
        top = np.maximum.reduceat(e, starts)
        a = np.exp(e - top[owner])
        a /= np.add.reduceat(a, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out_bias"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": y}

    def gradients(self, bags: np.ndarray, owner: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Derivatives of the mean log loss by every learnt weight."""
        w, n = self.weights, len(truth)
        f = self.forward(bags, owner, n)
        dy = (f["y"] - truth) / n
        dz = dy[:, None] * w["out"]
        da = (dz[owner] * f["h"]).sum(axis=1)
        starts = np.searchsorted(owner, np.arange(n))
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[owner])
        dt = de[:, None] * w["w"] * f["s"] * (1 - f["t"] ** 2)
        ds = de[:, None] * w["w"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz[owner] + dt @ w["v"].T + ds @ w["u"].T) * (1 - f["h"] ** 2)
        return {
            "encode": ((bags - w["mean"]) / w["scale"]).T @ dh, "bias": dh.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ ds,
            "w": (f["t"] * f["s"]).T @ de, "out": f["z"].T @ dy, "out_bias": dy.sum(),
        }

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        bags = [encode(t) for t in texts]
        owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        return self.forward(np.concatenate(bags), owner, len(bags))["y"] if bags else np.zeros(0)


def fit_attention(bags: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> AttentionModel:
    """Adam on the log loss, by backpropagation; the same sample gives the same model."""
    truth = np.array(labels, dtype=np.float64)
    prior = float(truth.mean()) if len(truth) else 0.5
    if not len(truth) or prior in (0.0, 1.0):
        return AttentionModel({}, prior)
    rng = np.random.default_rng(10)
    everything = np.concatenate(bags).astype(np.float64)
    w = {
        "mean": everything.mean(axis=0), "scale": everything.std(axis=0) + 0.02,
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "bias": np.zeros(HIDDEN),
        "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "w": rng.normal(0, ATTENTION**-0.5, ATTENTION), "out": rng.normal(0, HIDDEN**-0.5, HIDDEN), "out_bias": np.array(np.log(prior / (1 - prior))),
    }
    model = AttentionModel(w, prior)
    learnt = [k for k in w if k not in ("mean", "scale")]
    first, second, step = {k: np.zeros_like(w[k]) for k in learnt}, {k: np.zeros_like(w[k]) for k in learnt}, 0
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 128):
            part = order[at : at + 128]
            x = np.concatenate([bags[i] for i in part]).astype(np.float64)
            owner = np.repeat(np.arange(len(part)), [len(bags[i]) for i in part])
            g = model.gradients(x, owner, truth[part])
            step += 1
            for k in learnt:
                grad = g[k] + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> AttentionModel:
    """Learns from at most ``rows`` rows of ``labels`` (doc_id, label 0 or 1), taken by a hash of the id from all of them."""
    known = labels.where("doc_id is not null and label is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = known.distinct().orderBy(unit_hash("doc_id", seed=10), "doc_id", "label").limit(rows)
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", F.col("text").alias("__text"))
    # one text for each label, the least, so that an id with many rows takes one place
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("__text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [encode(t).astype(np.float16).tobytes() for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(raw, pa.binary())], ["doc_id", "label", "bag"])

    got = sorted((r["doc_id"], r["label"], bytes(r["bag"])) for r in sample.mapInArrow(run, extended(sample.select("doc_id", "label").schema, "bag binary")).collect())
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, FEATURES).astype(np.float32) for _, _, b in got]
    return fit_attention(bags, [x for _, x, _ in got])


def score_quality(docs: DataFrame, model: AttentionModel, keep: list[str]) -> DataFrame:
    """``keep`` columns with __score (underscores in front where ``keep`` has that name), in [0, 1], of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(keep)
    rows, text = with_text(docs, names)
    score = free_name(names, "__score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            scores = shared.value.score(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(scores, pa.float64())], [*names, score])

    return rows.mapInArrow(run, extended(docs.select(*names).schema, f"`{score}` double"))
