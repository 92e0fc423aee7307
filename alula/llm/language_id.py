"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the character n-grams (n = 1 to 3) present in both, over the n-grams that some
landmark has, and is normalised to 1 for equal sets. Landmarks are texts of the labelled sample. The Nyström map
sends a text to ``k(text, landmarks) K^-1/2``; one ridge regression per language (that language +1, the others -1)
is solved on it. A batch is scored by one product of its presence matrix with the landmarks' n-gram weights.

The regressions add up to the same number for every text, so they compare languages but cannot tell that none fits. That is
told by a text's n-gram log-likelihood, per letter, in windows, each under the language that explains it best. Every
language is measured from the median of its own sample texts, each taken without its own n-grams. A text that lies beyond
``TO_SHUFFLED`` of the way to the sample with its letters shuffled, and too far below for its length (``FAR_BELOW``), is
claimed by no language and has score 0; this leaves room for names, code and foreign lines in a text. Where fewer than ``LEAST_MEASURED`` texts can be measured, any shared n-gram is a claim.

Every letter and combining mark is a symbol of its own. n-grams are 64-bit codes, found in a hash table of the landmarks' n-grams.

Texts are lower-cased, whatever is neither letter nor mark becomes a blank, and blanks in a row count as one. Null texts and texts
without a letter get ``und`` with score 0; a text that shares no n-gram of letters with a landmark gets the commonest language
with score 0. Very long texts are read piece by piece, whole. Labels are learnt from a bounded sample only
(``SAMPLE_ROWS`` and ``SAMPLE_CHARS``); null labels and null ids teach nothing.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import TEXT_BATCH_ROWS, extended, free_name, own_caches, send_small_batches, slices, unit_hash, with_text

UNDETERMINED = "und"
#: Most labelled texts learnt from, the longest text among them, and the landmarks chosen from them.
SAMPLE_ROWS, SAMPLE_CHARS, LANDMARKS = 2000, 100_000, 160
#: Bits of a symbol, and what stands in place of the missing symbols of 1- and 2-grams: more than any code point. 0 is the blank.
BITS = 21
ONE, TWO = (0x1FFFFF << 2 * BITS) | (0x1FFFFF << BITS), 0x1FFFFE << 2 * BITS
RIDGE = 1e-2
PIECE = 1 << 18
#: Letters that one language has to explain; robust deviations of as many letters that a text may stay below; its share of the way to
#: shuffled letters; texts to measure by.
WINDOW, FAR_BELOW, TO_SHUFFLED, LEAST_MEASURED = 128, 10.0, 0.75, 8


@dataclass
class SpectrumModel:
    languages: list[str]
    slots: np.ndarray  # n-gram codes, sorted; their places are columns of the presence matrix
    weights: np.ndarray  # slots x languages
    ridge: float = RIDGE
    familiar: np.ndarray | None = field(default=None, repr=False)  # languages x (slots and unknown): log-likelihoods
    centres: np.ndarray | None = None  # log-likelihood of a letter in the median text of each language
    slack: float = np.inf  # how far below a text may stay
    by_letter: float = 0.0  # robust deviation of a letter
    slot_of: SlotTable | None = field(default=None, repr=False)

    def ready(self) -> SpectrumModel:
        if self.slot_of is None:
            self.slot_of = SlotTable(self.slots)
        return self


class SlotTable:
    """Places of codes in ``slots``, -1 for others: open addressing, at most an eighth full."""

    def __init__(self, slots: np.ndarray):
        self.bits = max(4, int(8 * len(slots)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.places = np.full(self.mask + 1, -1, dtype=np.int32)
        left = np.arange(len(slots))
        at = self.first(slots)
        while len(left):
            open_at, who = np.unique(np.where(self.keys[at] == -1, at, -1), return_index=True)
            who = who[open_at >= 0]
            self.keys[at[who]], self.places[at[who]] = slots[left[who]], left[who]
            stay = np.ones(len(left), dtype=bool)
            stay[who] = False
            left, at = left[stay], (at[stay] + 1) & self.mask

    def first(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        at = self.first(codes)
        keys = self.keys[at]
        out = np.where(keys == codes, self.places[at], -1)
        left = np.flatnonzero((keys != codes) & (keys != -1))
        while len(left):
            at = (at if len(at) == len(left) else at[left]) + 1 & self.mask
            keys, wanted = self.keys[at], codes[left]
            same = keys == wanted
            out[left[same]] = self.places[at[same]]
            more = ~same & (keys != -1)
            left, at = left[more], at[more]
        return out


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Code point -> itself for letters and combining marks, else the blank."""
    table = np.zeros(0x110000, dtype=np.int64)
    for code in range(sys.maxunicode + 1):
        if chr(code).isalpha() or unicodedata.category(chr(code))[0] == "M":
            table[code] = code
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def symbols(text: str) -> Iterator[np.ndarray]:
    """Symbols of a text between blanks, piece by piece."""
    for at in range(0, max(len(text), 1), PIECE):
        s = symbol_table()[code_points(text[max(0, at - 2) : at + PIECE])]
        s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))] if len(s) else s
        yield np.concatenate(([0], s, [0]))


def grams(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the 1-, 2- and 3-grams of a piece."""
    two = (s[:-1] << BITS) | s[1:]
    return s | ONE, two | TWO, (two[:-1] << BITS) | s[2:]


def gram_codes(text: str) -> Iterator[np.ndarray]:
    """Codes of all 1-, 2- and 3-grams of a text, piece by piece."""
    for s in symbols(text):
        yield from grams(s)


def read_text(text: str, model: SpectrumModel, row: np.ndarray) -> Iterator[np.ndarray]:
    """Marks a text's slots in ``row``; yields the slots of each letter (alone, after its neighbour, between both), -1 if unknown."""
    for s in symbols(text):
        one, two, three = (model.slot_of[codes] for codes in grams(s))
        for at in (one, two, three):
            row[at[at >= 0]] = 1.0
        letters = np.flatnonzero(s[1:-1])
        yield np.stack([one[1:-1][letters], two[:-1][letters], three[letters]])


def presence(texts: list[str], model: SpectrumModel) -> np.ndarray:
    """One row per text: 1 where it has the n-gram, scaled to unit length."""
    out = np.zeros((len(texts), len(model.slots)), dtype=np.float32)
    for row, text in zip(out, texts):
        for _ in read_text(text, model, row):
            pass
    return unit_length(out)


def unit_length(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt(rows.sum(axis=1, keepdims=True)), 1.0)


def windows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over windows of letters, and the letters in each."""
    starts = np.arange(0, len(values), WINDOW)
    return np.add.reduceat(values, starts), np.diff(np.append(starts, len(values)))


def fit_claims(model: SpectrumModel, texts: list[str], labels: list[str]) -> None:
    """Log-likelihoods of the n-grams in each language, and how far the sample's texts stay from their language's median."""
    place = {c: i for i, c in enumerate(model.languages)}
    scratch = np.zeros(len(model.slots), dtype=np.float32)
    counts = np.zeros((len(place), len(model.slots) + 1), dtype=np.float64)
    sizes = np.zeros(len(place), dtype=np.int64)
    for text, label in zip(texts, labels):
        for at in read_text(text, model, scratch):
            counts[place[label]] += np.bincount(at.ravel() + 1, minlength=counts.shape[1])[np.r_[1 : counts.shape[1], 0]]
            sizes[place[label]] += at.shape[1]
    counts[:, -1] = 0
    model.familiar = np.log((counts + 0.5) / (sizes + 1)[:, None]).astype(np.float32)
    means: list[list[float]] = [[] for _ in place]
    parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in place]
    for text, label in zip(texts, labels):
        k, found = place[label], list(read_text(text, model, scratch))
        at = np.hstack(found)
        n = at.shape[1]
        if not n or n == sizes[k]:
            continue
        slots, back, own = np.unique(at.ravel(), return_inverse=True, return_counts=True)
        left = np.where(slots >= 0, counts[k, slots] - own, 0)
        values = np.log((left + 0.5) / (sizes[k] - n + 1))[back].reshape(3, -1).sum(axis=0)
        means[k].append(values.mean())
        parts[k].append(windows(values))
    measured = [k for k, m in enumerate(means) if m]
    centres = {k: float(np.median(means[k])) for k in measured}
    rest = np.median(list(centres.values())) if centres else 0.0
    model.centres = np.array([centres.get(k, rest) for k in range(len(place))], dtype=np.float64)
    if sum(map(len, means)) < LEAST_MEASURED:
        return
    rng = np.random.default_rng(9)
    shuffled = [explained(list(read_text(shuffle_letters(x[: 16 * WINDOW], rng), model, scratch)), model)[0] for x in texts if has_letter(x[: 16 * WINDOW])]
    letters_off = np.concatenate([(s / n - centres[k]) * np.sqrt(n) for k in measured for s, n in parts[k]])
    model.slack = max(0.0, -float(np.median(shuffled)) * TO_SHUFFLED)
    model.by_letter = 1.4826 * float(np.median(np.abs(letters_off)))


def shuffle_letters(text: str, rng: np.random.Generator) -> str:
    """The text with its letters in random order, blanks and signs in place."""
    at = [i for i, c in enumerate(text) if c.isalpha()]
    out = list(text)
    for i, j in zip(at, rng.permutation(at).tolist()):
        out[i] = text[j]
    return "".join(out)


def explained(parts: list[np.ndarray], model: SpectrumModel) -> tuple[float, int]:
    """Log-likelihood of a letter, from the centre of the language that explains its window best, and the number of letters."""
    total, letters = 0.0, 0
    for at in parts:
        if at.shape[1]:
            sums, n = zip(*(windows(f[at].sum(axis=0, dtype=np.float64)) for f in model.familiar))
            total += float((np.array(sums) - model.centres[:, None] * n[0]).max(axis=0).sum())
            letters += at.shape[1]
    return total / max(letters, 1), letters


def claimed(parts: list[np.ndarray], model: SpectrumModel) -> bool:
    """Whether learnt languages explain a text's letters nearly as well as their own sample texts."""
    value, letters = explained(parts, model)
    return letters > 0 and value >= -max(model.slack, FAR_BELOW * model.by_letter / letters**0.5)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_spectrum(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> SpectrumModel:
    """Fits on a sample in the order given; landmarks are dealt to the languages in turn."""
    languages = sorted(set(labels), key=lambda x: (-labels.count(x), x))
    model = SpectrumModel(languages, np.zeros(0, dtype=np.int64), np.zeros((0, 0)), ridge)
    if not languages:
        return model
    each = max(1, landmarks // len(languages))
    chosen = [i for c in languages for i in [k for k, x in enumerate(labels) if x == c][:each]]
    model.slots = np.unique(np.concatenate([np.unique(c) for i in chosen for c in gram_codes(texts[i])]))
    model.ready()
    base = presence([texts[i] for i in chosen], model).astype(np.float64)
    values, vectors = np.linalg.eigh(base @ base.T)
    strong = values > 1e-8 * values[-1]
    root = vectors[:, strong] / np.sqrt(values[strong])
    gram, moment = np.zeros((strong.sum() + 1,) * 2), np.zeros((strong.sum() + 1, len(languages)))
    place = {c: i for i, c in enumerate(languages)}
    for at in range(0, len(texts), 64):
        phi = presence(texts[at : at + 64], model).astype(np.float64) @ base.T @ root
        phi = np.hstack([phi, np.ones((len(phi), 1))])
        sign = np.full((len(phi), len(languages)), -1.0)
        sign[np.arange(len(phi)), [place[x] for x in labels[at : at + 64]]] = 1.0
        gram += phi.T @ phi
        moment += phi.T @ sign
    penalty = ridge * len(texts) * np.eye(len(gram)) / len(gram)
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(gram + penalty, moment)
    model.weights = np.vstack([base.T @ root @ solved[:-1], solved[-1:]]).astype(np.float32)
    fit_claims(model, texts, labels)
    return model


def train_language_id(docs: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> SpectrumModel:
    """Fits on at most ``rows`` labelled texts, as many of each language as there are up to an equal share.

    Languages are counted over all usable rows; which of their rows are taken depends on a hash of the id."""
    labelled = docs.where(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()}
    if not counts:
        return fit_spectrum([], [])
    share = max(1, rows // len(counts))
    part = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(1.0, 1.5 * share / n))])
    marked = labelled.select("doc_id", "lang", "text", unit_hash("doc_id", seed=9).alias("u")).where(F.col("u") < part[F.col("lang")])
    # One text per id and language (the least), so that a repeated id takes one place; the limit stands before the collect.
    single = marked.groupBy("u", "doc_id", "lang").agg(F.min("text").alias("text"))
    found = single.orderBy("u", "doc_id", "lang").limit(4 * rows).collect()
    taken: dict[str, int] = {}
    chosen = []
    for r in found:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= share and has_letter(r["text"]):
            chosen.append(r)
    found = chosen
    return fit_spectrum([r["text"] for r in found], [r["lang"] for r in found])


def predict_language(texts: list[str | None], model: SpectrumModel) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    model.ready()
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    at = [i for i, t in enumerate(texts) if has_letter(t)]
    if not model.languages or not at:
        return langs, scores
    for k in range(0, len(at), 64):
        part = at[k : k + 64]
        rows = np.zeros((len(part), len(model.slots)), dtype=np.float32)
        known, fits = [], []
        for row, i in zip(rows, part):
            read = list(read_text(texts[i], model, row))
            known.append(any((x >= 0).any() for x in read))
            fits.append(known[-1] and claimed(read, model))
        f = unit_length(rows) @ model.weights[:-1] + model.weights[-1]
        for i, v, some, fit in zip(part, f, known, fits):
            langs[i] = model.languages[v.argmax() if some else 0]
            scores[i] = min(1.0, max(0.0, (float(v.max()) + 1) / 2)) if fit else 0.0
    return langs, scores


def identify_languages(docs: DataFrame, model: SpectrumModel, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row and two more: __lang_pred and __score (with underscores in front where ``keep`` has these names)."""
    model.slot_of = None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, text = with_text(docs, keep)
    names = list(keep)
    added = [free_name(names, "__lang_pred"), free_name(names, "__score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_caches("language")
        fitted = shared.value.ready()
        for batch in slices(batches):
            langs, scores = predict_language(batch.column(text).to_pylist(), fitted)
            columns = [batch.column(c) for c in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    return rows.mapInArrow(run, extended(docs.select(*names).schema, f"`{added[0]}` string, `{added[1]}` double"))


def claimed_rows(docs: DataFrame, model: SpectrumModel) -> DataFrame:
    """The rows whose text a learnt language claims. Only texts go to Python, and only the answer comes back."""
    model.slot_of = None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    send_small_batches(docs.sparkSession)

    @F.arrow_udf("boolean")
    def claimed_text(texts: pa.Array) -> pa.Array:
        own_caches("language")
        fitted, out = shared.value.ready(), []
        for at in range(0, len(texts), TEXT_BATCH_ROWS):
            langs, scores = predict_language(texts.slice(at, TEXT_BATCH_ROWS).to_pylist(), fitted)
            out += [lang != UNDETERMINED and score > 0 for lang, score in zip(langs, scores)]
        return pa.array([bool(x) for x in out], pa.bool_())

    return docs.where(claimed_text(F.col("text").cast("string")))
