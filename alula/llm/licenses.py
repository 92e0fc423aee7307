"""Licence notices in documents, found by a trained paragraph classifier, in DataFrame functions only.

Paragraphs are lines, cut further at sentence ends. Their features are words and word pairs, as far as they hold an *anchor*: any word
of a licence template but ``SMALL_WORDS``, however often the corpus has it. A multinomial logistic regression over the licence families and the class
``unknown`` is fitted on the templates, on variants of them with words missing or around them, on look-alikes, and on a
bounded sample of corpus paragraphs, without those that agree with a template themselves. Notices of further licences make a class of their own,
``Other``, so that a relative of a listed licence has somewhere to go. The unknown class is calibrated: a logistic curve of
the margin between the likeliest family and ``unknown`` is fitted on whole templates and notices that the trial fit never saw in
any variant, against other text held back, both sides with equal weight. Only texts
with a template's word pair that holds an anchor are cut up at all: agreement takes two pairs. The likeliest family counts when
the probability of not being unknown is at least ``CERTAIN`` and when a template of the family agrees: at least ``AGREEMENT`` of the
template's word pairs, or of the paragraph's, are shared. The name and version of a family must stand in the paragraph, and those of
its relatives must not (``EVIDENCE``); else the notice is reported as ``Other``: some licence, none of those listed.

Everything about a document is decided in its row: no shuffle, no Python. Null and empty texts have no notices. Without sample
paragraphs (an empty corpus) templates and look-alikes alone are learnt.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import unit_hash

UNKNOWN = "unknown"
OTHER = "Other"
#: Documents whose paragraphs stand for the unknown class, the longest of them, and the paragraphs taken at most.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_PARAGRAPHS = 200, 20_000, 3000
CERTAIN, AGREEMENT = 0.5, 0.6
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
CUT = r"\n+|(?<=[.!?])\s+"

# Sentences by which licence families are recognised, and sentences that only look like it.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal "
        "in the Software without restriction.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["Copyright, all rights reserved.", "No part of this publication may be reproduced without prior written permission of the publisher."],
}
OTHER_NOTICES = [
    "Licensed under the Apache License, Version 1.1.", "Licensed under the Apache Software License, Version 1.0.",
    "Released under the BSD 2-Clause License.", "Released under the original BSD 4-Clause License.", "Released under the Zero-Clause BSD License.",
    "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY 3.0.", "Licensed under CC BY-SA 3.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "Dedicated to the public domain under CC0 1.0 Universal.",
    "This work is licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU Affero General Public License, version 3.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation; either version 2 of the License, or any later version.",
    "Licensed under the GNU Lesser General Public License, version 3.", "Licensed under the GNU Library General Public License, version 2.",
    "Released under the ISC License.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", "Licensed under the Eclipse Public License, version 2.0.",
    "Licensed under the European Union Public Licence, version 1.2.", "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the Artistic License, Version 2.0.", "Licensed under the SIL Open Font License, Version 1.1.", "Released under the zlib License.",
    "This is free and unencumbered software released into the public domain.", "Licensed under the Common Development and Distribution License, Version 1.0.",
]
#: Words of the families' names and versions, compared whole: of each group one must stand in a notice, and none of the last list.
EVIDENCE = {
    "Apache-2.0": ([["apache", "apache-2.0"], ["2", "2.0", "v2", "v2.0", "apache-2.0"]], ["1", "1.0", "1.1"]),
    "BSD-3-Clause": ([["3-clause", "bsd-3-clause", "three-clause", "3", "three", "neither"]], ["2-clause", "bsd-2-clause", "4-clause", "zero-clause", "0-clause", "2", "4"]),
    "CC-BY-4.0": ([["by", "attribution", "cc-by", "cc-by-4.0"], ["4.0", "4", "cc-by-4.0"]],
                  ["nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike", "share", "by-nc", "by-nd", "by-sa", "3.0", "2.5", "2.0", "1.0"]),
    "CC-BY-NC-4.0": ([["nc", "noncommercial", "by-nc", "cc-by-nc", "attribution-noncommercial", "cc-by-nc-4.0"], ["4.0", "4", "cc-by-nc-4.0"]],
                     ["nd", "sa", "noderivatives", "noderivs", "sharealike", "share", "3.0", "2.5", "2.0", "1.0"]),
    "CC-BY-SA-4.0": ([["sa", "sharealike", "by-sa", "cc-by-sa", "attribution-sharealike", "cc-by-sa-4.0"], ["4.0", "4", "cc-by-sa-4.0"]],
                     ["nc", "nd", "noncommercial", "by-nc", "3.0", "2.5", "2.0", "1.0"]),
    "GPL-3.0": ([["general", "gpl", "gplv3", "gpl-3.0"], ["3", "3.0", "v3", "v3.0", "gplv3", "gpl-3.0"]], ["lesser", "library", "affero", "1", "2", "2.0", "v2", "lgpl", "agpl"]),
    "LGPL-2.1": ([["lesser", "lgpl", "lgpl-2.1"], ["2.1", "v2.1", "lgpl-2.1"]], ["affero", "3", "3.0", "v3"]),
    "MIT": ([["mit", "charge"]], ["organization", "font"]),
    "MPL-2.0": ([["mozilla", "mpl", "mpl-2.0"], ["2", "2.0", "v2.0", "mpl-2.0"]], ["1.0", "1.1"]),
}
LOOK_ALIKES = [
    "He lost his driving license on the way to the public house.", "The license plate of the car was new.", "The general public was not admitted.",
    "A version of the story was released under another name.", "The Apache people lived in the south.", "She studied at MIT in the nineties.",
    "The software was free of charge for any person.", "The terms of the contract are subject to change.", "Creative work is common in the commons.",
    "The copy of the file was published by the foundation.", "All rights of the publisher were reserved for later.", "The source of the river is in another form.",
]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


ALL_NOTICES = TEMPLATES | {OTHER: OTHER_NOTICES}
TEMPLATE_PAIRS = [set(pairs_of(words_of(t))) for ts in ALL_NOTICES.values() for t in ts]


@dataclass
class LicenseModel:
    families: list[str]  # the last is UNKNOWN
    anchors: list[str]
    weights: dict[str, list[float]]
    intercepts: list[float]
    slope: float  # probability of not being unknown: logistic of slope * margin + offset
    offset: float


def agreement(words: list[str]) -> float:
    """Largest share of word pairs that the words have in common with a template."""
    pairs = set(pairs_of(words))
    return max(len(pairs & own) / max(min(len(own), len(pairs)), 3) for own in TEMPLATE_PAIRS)


def _variants(words: list[str], noise: list[list[str]]) -> list[list[str]]:
    """The words, with each word missing, each end missing, and other text before or after."""
    out = [words, *[words[:i] + words[i + 1 :] for i in range(len(words)) if len(words) > 4]]
    out += [words[: len(words) * 3 // 4], words[len(words) // 4 :]] if len(words) > 8 else []
    return out + [n[:6] + words for n in noise[:3]] + [words + n[:6] for n in noise[3:6]]


def fit_licenses(sample: list[str], steps: int = 200) -> LicenseModel:
    """Fits on the templates and sampled corpus paragraphs (those that agree with a template are left out)."""
    corpus = [w for w in map(words_of, sample) if w and agreement(w) < AGREEMENT]
    anchors = sorted({w for ts in ALL_NOTICES.values() for t in ts for w in words_of(t) if len(w) > 1 and w not in SMALL_WORDS})
    families = [*sorted(ALL_NOTICES), UNKNOWN]
    # (family, words, held back for the temperature); of a family with one template alone nothing is held back
    rows: list[tuple[int, list[str], bool]] = []
    for k, family in enumerate(families[:-1]):
        for n, t in enumerate(ALL_NOTICES[family]):
            rows += [(k, v, n % 3 == 1) for v in _variants(words_of(t), corpus)]
    unknown = [words_of(t) for t in LOOK_ALIKES] + corpus + [[a, *n[:5]] for a, n in zip(anchors, corpus * (1 + len(anchors) // max(1, len(corpus))))]
    rows += [(len(families) - 1, w, n % 3 == 1) for n, w in enumerate(unknown)]
    held = set(anchors)

    def grams(words: list[str]) -> set[str]:
        return {w for w in words if w in held} | {f"{a} {b}" for a, b in zip(words, words[1:]) if a in held or b in held}

    counted: dict[tuple[int, tuple[str, ...]], int] = {}
    aside: set[tuple[int, tuple[str, ...]]] = set()
    for k, w, apart in rows:
        key = (k, tuple(sorted(grams(w))))
        counted[key] = counted.get(key, 0) + 1
        if apart:
            aside.add(key)
    found, times = list(counted), np.array(list(counted.values()), dtype=float)
    vocabulary = {g: i for i, g in enumerate(sorted({g for k, gs in found if k < len(families) - 1 for g in gs}))}
    x = np.zeros((len(found), len(vocabulary) + 1))
    truth = np.zeros((len(found), len(families)))
    for i, (k, gs) in enumerate(found):
        x[i, [vocabulary[g] for g in gs if g in vocabulary]] = 1.0
        x[i, -1] = 1.0
        truth[i, k] = 1.0
    back = np.array([key in aside for key in found])
    share = times @ truth
    importance = times * (truth / np.maximum(share, 1)).sum(axis=1) * len(found) / len(families)

    def fitted(keep: np.ndarray) -> np.ndarray:
        w, m, v = (np.zeros((x.shape[1], len(families))) for _ in range(3))
        for step in range(1, steps + 1):
            g = x[keep].T @ ((_softmax(x[keep] @ w) - truth[keep]) * importance[keep][:, None]) / keep.sum() + 1e-4 * np.sign(w)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return np.where(np.abs(w) < 0.02, 0.0, w)

    trial = x[back] @ fitted(~back)
    slope, offset = _calibrated(trial[:, :-1].max(axis=1) - trial[:, -1], truth[back][:, -1] == 0)
    w = fitted(np.ones(len(found), dtype=bool))
    weights = {g: [round(float(z), 6) for z in w[i]] for g, i in vocabulary.items() if w[i].any()}
    return LicenseModel(families, anchors, weights, [round(float(z), 6) for z in w[-1]], round(slope, 6), round(offset, 6))


def _calibrated(margin: np.ndarray, notice: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the margins, both kinds weighing the same; Newton steps with a small ridge."""
    weight = np.where(notice, 0.5 / max(1, notice.sum()), 0.5 / max(1, (~notice).sum()))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    theta = np.array([0.5, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slack = 1e-3 * (theta - np.array([0.5, 0.0]))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (p - notice)) + slack)
        theta = theta - np.clip(step, -1, 1)
    return float(theta[0]), float(theta[1])


#: Words too short of meaning to be anchors.
SMALL_WORDS = frozenset("a an and any are as at be by can either following in is it may met no not of on or part that the this to use under with without you work".split())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_licenses(docs: DataFrame) -> LicenseModel:
    """Samples corpus paragraphs of at most SAMPLE_DOCS documents, chosen by a hash of the id, and fits."""
    usable = docs.where(F.col("doc_id").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text")
    ids = [r["doc_id"] for r in usable.select("doc_id").orderBy(unit_hash("doc_id", seed=7), "doc_id").limit(SAMPLE_DOCS).collect()]
    texts = usable.where(F.col("doc_id").isin(ids)).select("doc_id", F.explode(F.split("text", CUT)).alias("paragraph"))
    rows = texts.orderBy(unit_hash("doc_id", "paragraph", seed=7), "doc_id", "paragraph").limit(SAMPLE_PARAGRAPHS).collect()
    return fit_licenses([r["paragraph"] for r in rows])


def _words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0))


def _pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def license_notices(text: Column, model: LicenseModel) -> Column:
    """Array of (family, probability, agreement, paragraph) of a text's confirmed notices, in text order; null without a
    template's word pair."""
    t = F.coalesce(text, F.lit(""))
    followers: dict[str, set[str]] = {}
    for a, b in (p.split() for own in TEMPLATE_PAIRS for p in own):
        if a in model.anchors or b in model.anchors:
            followers.setdefault(a, set()).add(b)
    pairs = "|".join(f"{re.escape(a)}[^a-z0-9]+(?:{'|'.join(map(re.escape, sorted(bs)))})" for a, bs in sorted(followers.items()))
    pattern = f"(?<![a-z0-9])(?:{pairs})"
    table = F.create_map(*[c for g, w in model.weights.items() for c in (F.lit(g), _array(w))])
    families = _array(model.families)

    def judged(paragraph: Column) -> Column:
        words = _words(paragraph)
        return F.struct(paragraph.alias("paragraph"), words.alias("words"), F.array_distinct(_pairs(words)).alias("pairs"))

    def scored(row: Column) -> Column:
        grams = F.concat(F.array_distinct(row["words"]), row["pairs"])
        start = _array(model.intercepts)
        logits = F.aggregate(grams, start, lambda acc, g: F.when(table[g].isNull(), acc).otherwise(F.zip_with(acc, table[g], lambda a, b: a + b)))
        return F.struct(row["paragraph"].alias("paragraph"), row["words"].alias("words"), row["pairs"].alias("pairs"), logits.alias("logits"))

    def decided(row: Column) -> Column:
        likeliest = F.array_max(F.slice(row["logits"], 1, len(model.families) - 1))
        family = F.element_at(families, F.array_position(row["logits"], likeliest).cast("int"))
        margin = likeliest - F.element_at(row["logits"], -1)
        probability = 1 / (1 + F.exp(-(margin * model.slope + model.offset)))
        return F.struct(family.alias("family"), probability.alias("probability"), row["words"].alias("words"), row["pairs"].alias("pairs"), row["paragraph"].alias("paragraph"))

    def confirmed(row: Column) -> Column:
        shares = [F.lit(0.0)]
        for name, sentences in ALL_NOTICES.items():
            for s in sentences:
                own = _array(sorted(set(pairs_of(words_of(s)))))
                shared = F.size(F.array_intersect(row["pairs"], own))
                part = shared / F.greatest(F.least(F.size(own), F.size(row["pairs"])), F.lit(3))
                shares.append(F.when(row["family"] == name, part).otherwise(0.0))
        agreement = F.greatest(*shares)
        shown = F.lit(True)
        for name, (groups, others) in EVIDENCE.items():
            stands = ~F.arrays_overlap(row["words"], _array(others))
            for group in groups:
                stands = stands & F.arrays_overlap(row["words"], _array(group))
            shown = F.when(row["family"] == name, stands).otherwise(shown)
        return F.struct(F.when(shown, row["family"]).otherwise(OTHER).alias("family"), row["probability"].alias("probability"), agreement.alias("agreement"), row["paragraph"].alias("paragraph"))

    paragraphs = F.filter(F.split(t, CUT), lambda p: F.lower(p).rlike(pattern))
    rows = F.transform(F.transform(F.transform(paragraphs, judged), scored), decided)
    rows = F.filter(rows, lambda r: r["probability"] >= CERTAIN)
    rows = F.filter(F.transform(rows, confirmed), lambda r: r["agreement"] >= AGREEMENT)
    return F.when(F.lower(t).rlike(pattern), rows)


def scan_licenses(docs: DataFrame, model: LicenseModel, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``__notices`` (an empty array where there are none) of every row."""
    notices = license_notices(F.col("text"), model)
    empty = F.array().cast("array<struct<family:string,probability:double,agreement:double,paragraph:string>>")
    return docs.select(*keep, F.coalesce(notices, empty).alias("__notices"))
