"""Vector codes, repeated passages and conversation repair, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alula.llm import conversations, suffix_merge, vector_codes

# --- vector codes ------------------------------------------------------------------------------


def _expected_codes(rows):
    """Plain k-means over all entries, in Python integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(4, -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4)
    q = [[max(min(int(np.floor(x * 1024)), 1 << 26), -(1 << 26)) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    size = width // 4
    parts = [np.array([x[p * size : (p + 1) * size] for x in q], dtype=object).reshape(len(q), size) for p in range(4)]
    books = [part[order[:256]] for part in parts]

    def assign():
        found = []
        for part, book in zip(parts, books):
            d = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2).astype(np.int64)
            found.append((d.argmin(axis=1), d.min(axis=1)))
        return found

    for _ in range(4):
        for p, (best, _) in enumerate(assign()):
            for e in set(best.tolist()):
                own = parts[p][best == e]
                books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [int(sum(f[1][r] for f in found)) for r in range(len(kept))]
    totals = {}
    for (_, _, label), e in zip(kept, errors):
        totals[label] = totals.get(label, 0) + e
    return sorted(((i, "".join(f"{f[0][r]:02x}" for f in found), errors[r], totals[label], digest) for r, (i, _, label) in enumerate(kept)), key=str)


def _coded(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, part int")
    return sorted(map(tuple, vector_codes.encode_vectors(df).collect()), key=str)


@pytest.mark.parametrize("n, width", [(700, 16), (300, 6), (20, 4)])
def test_codes_match_full_search(spark, n, width):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, width)) * 0.1
    x[n // 2 :: 3] = np.round(x[n // 2 :: 3], 1)  # equal parts and ties
    rows = [(i, v.tolist(), i % 5 if i % 7 else None) for i, v in enumerate(x)]
    odd = [(None, [0.5] * width, 1), (3, [0.25] * width, 2), (3, [0.25] * width, 2), (-4, None, 1), (-3, [float("nan")] * width, 1), (-2, [None] * width, 1), (-1, [float("inf")] + [0.0] * (width - 1), 1)]
    odd += [(5000, [1e30] + [-1e30] * (width - 1), None), (5001, [], 3), (5002, [0.1, 0.2], 3)]
    random.Random(n).shuffle(rows)
    assert _coded(spark, rows + odd) == _expected_codes(rows + odd)


def test_codes_of_empty_tables(spark):
    assert _coded(spark, []) == [] and _coded(spark, [(1, None, 1)]) == []
    assert [r[:4] for r in _coded(spark, [(1, [], None)])] == [(1, "00000000", 0, 0)]


def test_orchard_search_keeps_the_lowest_of_ties():
    entries = np.array([[2, 0], [-2, 0], [0, 2], [2, 0], [5, 5]])
    book = vector_codes.Codebook(entries)
    points = np.array([[0, 0], [2, 0], [1, 1], [9, 9]])
    for start in range(len(entries)):
        best, distance = book.nearest(points, np.full(len(points), start))
        assert best.tolist() == [0, 0, 0, 4] and distance.tolist() == [4, 0, 2, 32]


# --- repeated passages -------------------------------------------------------------------------


def _expected_removed(rows, width=suffix_merge.WINDOW):
    seen, out = set(), []
    for i in sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r)):
        raw = (rows[i][1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            window = raw[p : p + width]
            if window in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(window)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((rows[i][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _passages():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(0, 400))) for _ in range(30)]
    rows = [(i, rng.choice(base)[rng.randint(0, 50) :] + rng.choice(base)) for i in range(60)]
    common = "".join(rng.choice("xyz") for _ in range(150))
    rows += [(200 + i, "".join(rng.choice("pqrst") for _ in range(rng.randint(30, 90))) + common + "".join(rng.choice("pqrst") for _ in range(60))) for i in range(40)]
    return rows + [(100, "a" * 1000), (101, "ab" * 300), (102, "a" * 99), (103, "a" * 100), (104, None), (105, ""), (None, "ab" * 200), (None, "ab" * 200), (3, "zz" + base[0] * 2), (3, "zz" + base[0] * 2),
                   (106, "x" * 5000), (107, "abc" * 70), (108, "é😀" * 80), (109, "".join(map(chr, range(1, 800)))), (110, "".join(map(chr, range(400, 900))))]


def _removed(documents, rows):
    return sorted(map(tuple, suffix_merge.remove_repeats(documents(rows).coalesce(1)).collect()), key=str)


def test_removed_bytes_match_brute_force(documents):
    assert _removed(documents, _passages()) == _expected_removed(_passages())


@pytest.mark.parametrize("strips", [1, 3, 12])
def test_frequent_anchors_and_small_blocks_give_the_same(documents, monkeypatch, strips):
    """Limits are read where tasks are built, so they reach the workers in the functions' own values."""
    monkeypatch.setattr(suffix_merge, "HOT_STRIPS", strips)
    assert _removed(documents, _passages()) == _expected_removed(_passages())


def test_second_anchors_depend_on_the_window_only():
    rng = random.Random(6)
    for alphabet in ("ab", "abcdefgh"):
        strip = "".join(rng.choice(alphabet) for _ in range(160)).encode()
        at = int(suffix_merge.gram_hashes(np.frombuffer(strip, np.uint8))[60:69].argmin()) + 60
        pair, lo, hi = suffix_merge.second_anchors(strip, at)
        assert lo[0] == 0 and hi[-1] == len(strip) - suffix_merge.WINDOW + 1 and (lo[1:] == hi[:-1]).all()
        for p, a, b in zip(pair.tolist(), lo.tolist(), hi.tolist()):
            for k in range(a, b):
                alone = suffix_merge.second_anchors(strip[k : k + suffix_merge.WINDOW], at - k)
                assert [x.tolist() for x in alone] == [[p], [0], [1]]


def _strip_batch(strips, at):
    n = len(strips)
    columns = [pa.array([5] * n), pa.array([at] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64())]
    columns += [pa.array(range(n), pa.int32()), pa.array([7] * n, pa.int32()), pa.array(strips, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "at", "doc", "block", "row", "pos", "strip"])


def test_passages_that_are_equal_once_cut_are_not_merged(monkeypatch):
    rng = random.Random(8)
    passage = bytes(rng.choices(b"abcdefgh", k=120))
    strips = [b"-%03d" % k + passage + b"%03d-" % k for k in (112, 223, 334)]
    asked = []
    monkeypatch.setattr(suffix_merge, "repeated_windows", lambda strips: asked.append(strips))
    found = [tuple(r.values()) for b in suffix_merge._merged_spans(iter([_strip_batch(strips, 50)])) for r in b.to_pylist()]
    assert sorted(found) == [(0, 1, 11, 131), (0, 2, 11, 131)] and not asked


def test_windows_of_frequent_pairs_are_shuffled_once_a_batch():
    rng = random.Random(9)
    passage = bytes(rng.choices(b"abcdefgh", k=110))
    batch = _strip_batch([passage + b"%03d" % k for k in range(300)], 50)
    rows = [r for b in suffix_merge._windows(iter([batch])) for r in b.to_pylist()]
    windows = [r for r in rows if r["window"] is not None]
    assert len(windows) == len({r["window"] for r in windows}) == 11 + 3 + 30 + 300
    spans = {(r["row"], r["pos"], r["end"]) for r in rows if r["window"] is None}
    assert len(spans) == 299 == len(rows) - len(windows) and (299, 7, 119) in spans


def test_kept_bytes_and_empty_tables(documents):
    text = "".join(random.Random(2).choices("abcdefgh", k=250))
    found = {r["doc_id"]: r for r in suffix_merge.remove_repeats(documents([(1, text), (2, "new " + text + " end")]), with_bytes=True).collect()}
    assert found[1]["kept"].decode() == text and found[2]["n_removed"] >= 250 and len(found[2]["kept"]) == found[2]["n_bytes"] - found[2]["n_removed"]
    assert suffix_merge.remove_repeats(documents([])).count() == 0


def test_merged_order_equals_a_sort_of_all_suffixes():
    rng = random.Random(4)
    strips = [bytes(rng.choice(b"ab") for _ in range(rng.randint(100, 160))) for _ in range(30)]
    strips += [s[:120] + b"c" * 20 for s in strips[:10]] + [bytes(range(256))[:150]] * 2
    for shard_bytes in (200, 1000, 1 << 20):
        old, suffix_merge.SHARD_BYTES = suffix_merge.SHARD_BYTES, shard_bytes
        try:
            strip, offset, run = suffix_merge.repeated_windows(strips)
        finally:
            suffix_merge.SHARD_BYTES = old
        found = {}
        for s, o, r in zip(strip.tolist(), offset.tolist(), run.tolist()):
            found.setdefault(r, set()).add((s, o))
        expected = {}
        for s, raw in enumerate(strips):
            for o in range(len(raw) - 99):
                expected.setdefault(raw[o : o + 100], set()).add((s, o))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


def test_suffixes_of_a_shard_are_sorted():
    s, starts, size = suffix_merge.symbols([b"banana", b"ananas", b"banana", b""])
    order = suffix_merge.sorted_suffixes(s, starts)
    ends = np.append(starts[1:], len(s))

    def suffix(at):
        string = int(np.searchsorted(starts, at, side="right")) - 1
        return s[at : ends[string]].tolist(), string

    assert [suffix(a) for a in order] == sorted(map(suffix, range(len(s)))) and size == 2


# --- conversations -----------------------------------------------------------------------------


def _faults(rows):
    out, seen = [], set()
    for role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(rows):
    """All edit sequences up to the cheapest cost: (cost, audit, repaired) by trying everything."""
    faults = _faults(rows)
    best = None

    def legal(initials):
        return re.fullmatch(r"(s?(ua)+)?", initials)

    def go(at, cost, audit, done, inserts):
        nonlocal best
        if cost > (3 * len(rows) if best is None else best[0]) or not re.fullmatch(r"s?(ua)*u?", "".join(d[:1] for d in done)):
            return
        if at == len(rows) and legal("".join(d[:1] for d in done)):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, "\n".join(done))
        if inserts < 2:
            for role in ("user", "assistant"):
                go(at, cost + 2, audit + "I", [*done, f"{role}:"], inserts + 1)
        if at == len(rows):
            return
        role, text = rows[at]
        go(at + 1, cost + 3, audit + "D", done, 0)
        if faults[at] in ("", "truncated"):
            more = faults[at] == "truncated"
            go(at + 1, cost + more, audit + "K", [*done, f"{role}:{text}"], 0)
            for other in ("user", "assistant"):
                go(at + 1, cost + 2 + more, audit + "R", [*done, f"{other}:{text}"], 0)

    go(0, 0, "", [], 0)
    return best


def test_repairs_are_the_cheapest_with_the_least_audit():
    rng = random.Random(13)
    roles, texts = ["user", "assistant", "system", "tool", ""], ["Yes.", "no", "", " ", "Why?", "Yes."]
    for _ in range(150):
        rows = [(rng.choice(roles[: rng.choice([2, 3, 5])]), rng.choice(texts)) for _ in range(rng.randint(0, 5))]
        got = conversations.repair([(k, *r) for k, r in enumerate(rows)])
        assert got[5:] == _cheapest(rows), rows


def _damaged(rows):
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return found


def _expected_repairs(rows):
    out = []
    for conv, own in _damaged(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        *numbers, audit, text = conversations.repair(own)
        out.append((conv, *numbers, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def _conversation_rows():
    rng = random.Random(31)
    rows = []
    for conv in [*range(60), None]:
        turns = sorted(rng.sample(range(12), rng.randint(1, 9)))
        rows += [(conv, t, ["user", "assistant"][k % 2] if rng.random() < 0.9 else "system", rng.choice(["Sure.", "what", "No!", f"Text {k}.", "Ünï."])) for k, t in enumerate(turns)]
    rows += [(70, None, "user", "a."), (70, None, None, None), (70, 5, None, "x."), (71, None, "assistant", "Hm."), (72, -(2**63), "user", "low."), (72, 2**63 - 1, "assistant", "high.")]
    rows += rows[:20]
    rows += [(90, k, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"Line {k}.", f"Line {k}", "", f"{k}?"])) for k in range(400)]
    rows += [(91, 1, "user", "same.")] * 120
    return rows


def _repaired(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, gone int")
    return sorted(map(tuple, conversations.repair_conversations(conversations.damage(df)).collect()), key=str)


def test_tables_of_conversations_match_row_by_row_repair(spark):
    assert _repaired(spark, _conversation_rows()) == _expected_repairs(_conversation_rows())
    assert _repaired(spark, []) == []


def test_long_conversations_in_blocks_give_the_same(spark, monkeypatch, limits):
    monkeypatch.setattr(conversations, "WHOLE_ROWS", 5)
    expected = _expected_repairs(_conversation_rows())
    for block in (7, 64):
        monkeypatch.setattr(conversations, "BLOCK_ROWS", block)
        assert _repaired(spark, _conversation_rows()) == expected
    with limits(hotGroupRows=50):
        assert _repaired(spark, _conversation_rows()) == expected


def test_blocks_of_every_cut_agree_with_the_whole():
    rng = random.Random(8)
    for _ in range(300):
        rows = [(rng.choice("usat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 9))]
        unit, found = conversations.solve(rows, conversations.ENDS, True)
        whole = unit.read(found[conversations.START])
        for cut in range(1, len(rows)):
            tail_unit, tail = conversations.solve(rows[cut:], conversations.ENDS, True)
            ends = [None if w is None else w >> tail_unit.top for w in tail]
            head_unit, head = conversations.solve(rows[:cut], ends, False)
            cost, audit = head_unit.read(head[conversations.START])
            state = conversations.apply_audit(audit, [(i, "") for i, _ in rows[:cut]], conversations.START)[1]
            assert (cost, audit + tail_unit.read(tail[state])[1]) == whole
            table = conversations.border_costs(rows[:cut])[conversations.START]
            assert min(a + b for a, b in zip(table, ends) if a is not None and b is not None) == whole[0]


def test_hand_made_audits():
    def audit(*rows):
        return conversations.repair([(k, *r) for k, r in enumerate(rows)])[5:]

    assert audit(("user", "Hi."), ("assistant", "Yes.")) == (0, "KK", "user:Hi.\nassistant:Yes.")
    assert audit(("user", "Hi."), ("user", "Well?")) == (2, "KR", "user:Hi.\nassistant:Well?")
    assert audit(("system", "Rules.")) == (3, "D", "")
    assert audit(("assistant", "Yes.")) == (2, "IK", "user:\nassistant:Yes.")
    assert audit() == (0, "", "")


def test_damage_follows_the_ids(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    df = conversations.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = sorted(map(tuple, df.where(~F.col("gone")).select("conv_id", "turn", "role", "text").collect()), key=str)
    expected = sorted(((c, *r) for c, own in _damaged(rows).items() for r in own), key=str)
    assert got == expected and len({len(list(g)) for _, g in itertools.groupby(got)}) > 1
