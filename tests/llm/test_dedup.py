"""Exact and near duplicates of documents and vectors, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from alula.llm import exact_dedup, minhash, multi_index
from alula.llm.components import connected_components


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(25)]
    rows = []
    for i, t in enumerate(base):
        rows.append((3 * i, t))
        parts = t.split()
        for k in range(3):
            edited = list(parts)
            for _ in range(rng.choice([0, 1, 1, 3, 8])):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((1000 + 10 * i + k, "  ".join(edited).upper() if k == 1 else " ".join(edited)))
    long_text = " ".join(rng.choice(words) for _ in range(60_000))
    return rows + [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "one two"), (5004, "ONE two"), (5005, "É one two"), (5006, "é one two"),
                   (5007, long_text), (5008, long_text + " end"), (5009, long_text), (5010, "a b c d"), (5011, "a b c d"), (5012, "a b c d e")]


def _groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_lower(t), []).append(i)
    return groups


def _expected_exact(rows):
    groups = _groups(rows)
    return sorted((i, max(groups[_lower(t)]), len(groups[_lower(t)]), i == max(groups[_lower(t)]), hashlib.sha256(_lower(t).encode()).hexdigest()) for i, t in rows)


def test_exact_duplicates_match_brute_force(documents):
    rows = _texts()
    found = exact_dedup.exact_duplicates(documents(rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, found.collect())) == _expected_exact(rows)


def test_chunks_that_share_a_fingerprint_are_told_apart(documents):
    rows = [(i, t) for i, t in _texts() if len(t or "") < 5000] + [(7000, "abc. " * 200), (7001, "abd. " * 200), (7002, "abc. " * 200)]
    found = exact_dedup.exact_duplicates(documents(rows), lambda c: (F.length(c) % 3).cast("long"))
    assert sorted(map(tuple, found.collect())) == _expected_exact(rows)


def test_chunks_join_to_the_text(spark):
    text = "No end " * 2000 + "A line.\n" * 300 + "😀。" * 500
    df = spark.createDataFrame([(text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c"))
    parts = df.first()["c"]
    assert "".join(parts) == text and max(map(len, parts)) <= exact_dedup.MAX_CHUNK + 1


def test_exact_stage_keeps_one_row_of_each_text(documents, spark):
    rows = [*_texts(), (5007, _texts()[-6][1]), (1, "same"), (1, "same"), (1, "other"), (2, "other"), (None, "nobody"), (None, "nobody"), (None, "same")]
    docs = documents(rows)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((_lower(r["text"]), r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    groups = {}
    for i, t in rows:
        groups.setdefault(_lower(t), []).append(-1 if i is None else i)
    assert got == sorted((t, max(ids)) for t, ids in groups.items())


def test_empty_tables(documents):
    docs = documents([])
    for df in (exact_dedup.exact_duplicates(docs), exact_dedup.drop_exact_duplicates(docs), minhash.near_duplicates(docs), minhash.drop_near_duplicates(docs)):
        assert df.count() == 0


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def _expected_near(rows):
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def test_near_duplicates_match_brute_force(documents):
    rows = _texts()
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == _expected_near(rows)


def test_links_within_mixed_buckets_are_found(documents):
    """Copies edited at different places: many are similar to a few others only, not to the bucket's centre."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(900)]
    text = [rng.choice(words) for _ in range(200)]
    rows = []
    for i in range(60):
        other = list(rows[i // 2][1].split()) if i else list(text)
        for _ in range(rng.randint(1, 7)):
            other[rng.randrange(len(other))] = rng.choice(words)
        rows.append((i, " ".join(other)))
    assert sorted(map(tuple, minhash.near_duplicates(documents(rows)).collect())) == _expected_near(rows)


def test_near_duplicates_without_ids_or_words(documents):
    docs = documents([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (3, "a b c d e f"), (2, None), (1, ""), (9, None)])
    found = sorted(((r[0] is None, r[0] or 0, r[1], r[2], r[3]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(True, 0, 2, None, True)] * 2 + [(False, 4, 2, 3, False), (False, 3, 2, 3, True)] + [(False, i, 0, i, True) for i in (1, 2, 9)], key=str)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 9]


def test_signature_estimates_similarity(spark):
    a, b = np.arange(4000, dtype=np.uint64), np.arange(800, 4800, dtype=np.uint64)
    sets = [minhash._mixed(a + np.uint64(1)), minhash._mixed(b + np.uint64(1))]
    low = [minhash.minima(s, minhash._FINE_FACTORS, np.zeros(1, np.uint32), 256) for s in sets]
    for bits in (1, 2, 4):
        x, y = (minhash.packed(v, bits).tolist() for v in low)
        df = spark.createDataFrame([(x, y)], "x array<long>, y array<long>")
        got = df.select(minhash.estimated_similarity(F.col("x"), F.col("y"), minhash.FINE_HASHES, bits)).first()[0]
        assert abs(got - 3200 / 4800) < 0.1


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300), (None, 5)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 140)}, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(600, 16))
    near = base[:120] + 0.15 * rng.normal(size=(120, 16))
    x = np.concatenate([base, near, base[:40], 3 * base[:10]]).astype(np.float32)
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)]
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0, None] * 8), (9005, [float("inf")] + [1.0] * 15), (9006, [1.0, 2.0])]
    df = spark.createDataFrame([*rows, *[(i, v, "c") for i, v in odd]], "vec_id long, embedding array<float>, copies string")
    found = {r["vec_id"]: tuple(r)[1:] for r in multi_index.near_duplicate_vectors(df).collect()}
    unit = multi_index.unit_rows(x)
    hits = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    links = hits.sum()
    assert sum(found[i][0] for i in range(len(x))) >= 0.99 * links
    assert all(found[i][0] <= hits[i].sum() for i in range(len(x)))
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(label, np.where(hits, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            break
        label = new
    same = np.mean([found[i][1] == label[i] for i in range(len(x))])
    assert same >= 0.99
    assert all(found[i] == (0, i, True) for i, _ in odd)


def test_vectors_of_every_length_are_compared(spark):
    rng = np.random.default_rng(5)
    rows = []
    for d, n in ((8, 120), (12, 80), (1, 3), (2, 3)):
        x = rng.normal(size=(n, d))
        x[n // 2 :] = x[: n - n // 2] * 2 + 0.01 * rng.normal(size=(n - n // 2, d))
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate([*x, x[0]])]
    rows += [(900, [1.0] * 5), (901, [1.0] * 5), (902, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in multi_index.near_duplicate_vectors(df).collect()}
    for d in (1, 2, 5, 6, 8, 12):
        ids = [i for i, v in rows if len(v) == d]
        unit = multi_index.unit_rows(np.array([v for _, v in rows if len(v) == d]))
        hits = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
        label = np.array(ids)
        for _ in ids:
            label = np.minimum(label, np.where(hits, label[None, :], 10**6).min(axis=1))
        assert [found[i] for i in ids] == [(int(h), int(c), i == c) for i, h, c in zip(ids, hits.sum(axis=1), label)]


def test_cells_come_in_multi_sequence_order():
    rng = np.random.default_rng(6)
    index = multi_index.MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    q = rng.normal(size=(20, 6))
    a, b = index.distances(q)
    for n in (1, 4, 12, 35, 99):
        sums = (a[:, :, None] + b[:, None, :]).reshape(len(q), -1)
        expected = np.sort(sums, axis=1)[:, :n]
        assert np.allclose(np.take_along_axis(sums, index.nearest_cells(q, n), 1), expected)


def test_no_usable_vector(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, multi_index.near_duplicate_vectors(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert multi_index.near_duplicate_vectors(df.limit(0)).count() == 0


def test_links_count_for_both_ends_over_many_cells(spark, monkeypatch):
    """Pairs near the threshold in hundreds of cells: often only one end visits the other's cell."""
    monkeypatch.setattr(multi_index, "CELL_ROWS", 8)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=x.shape)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.905, 0.92, size=(len(x), 1))
    rows = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * other])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in multi_index.near_duplicate_vectors(df).collect()}
    unit = multi_index.unit_rows(rows)
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = np.array([found[i]["n_links"] for i in range(len(rows))])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    # a pair counts for both ends or for neither
    pairs = [(got[i], got[i + len(x)]) for i in range(len(x)) if links[i] == 1 == links[i + len(x)]]
    assert len(pairs) > 1000 and all(a == b for a, b in pairs)
    assert all(found[i]["component_id"] == i for i in range(len(x)) if got[i] == 0)
