"""Repeated 100-byte passages, found by merging Burrows-Wheeler transforms of shards.

Texts are read as UTF-8 bytes. A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier: in a document with
a smaller id, or further left in the same one. Strings never cross documents.

1. Every window of ``WINDOW`` bytes has an *anchor*, its ``GRAM``-byte string with the smallest hash (the leftmost of equal
   ones). Equal windows have equal anchors. Anchors that occur once in all documents cannot lie in a repeat; texts
   are read again only where an anchor occurs twice.
2. The windows of one anchor occurrence overlap: they are one *strip* of at most 2 * WINDOW - GRAM bytes. Equal strips are one class;
   all but the first strip of a class are repeats throughout, so one strip of a class goes on.
3. Strips with the same anchor go to the same task. They are cut to what they share with others around the anchor, and of equal cut strips one goes on. The task sorts the suffixes of small *shards* of its strips, keeps each shard's
   transform, and merges the transforms by refining their interleaving: a stable partition by the transform's symbols makes an
   interleaving that is right for n symbols right for n + 1, and no suffix is compared again. Borders between
   runs of equal prefixes are refined along (they are the common prefixes). After ``WINDOW`` bytes, the runs between borders
   are the repeated intervals.
4. Spans of repeats are put together per document.

An anchor in more than ``HOT_STRIPS`` different strips (a frequent passage with many surroundings) is not gathered in one task. Its
strips are cut again by a *second anchor*, the string with the next smallest hash in a window, and the pair of anchors and their distance
stands for the anchor: equal windows have equal pairs, and most pairs are not frequent. The windows of pairs that still have too many
strips are compared within batches of strips first; those that are first there are grouped by a 128-bit digest, with partial minima before the shuffle. Nothing is dropped, capped or sampled.

Null and empty texts have no bytes. Rows without an id come after all others. Rows that share an id count in the order in which the
table is read. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.llm.common import bucketed, slices, written

WINDOW, GRAM = 100, 32
#: Text bytes kept and read together; bytes of strips merged together, and in one shard; strips of an anchor that one task takes.
BLOCK_BYTES, COLLECTION_BYTES, SHARD_BYTES, HOT_STRIPS = 4 << 20, 1 << 20, 1 << 17, 256
#: Text bytes in a bucket of the tables that are joined by block without being shuffled.
BUCKET_BYTES = 64 << 20
#: Hashes computed together, so that they stay in the processor's cache; strips whose windows are compared before they are shuffled.
HASHED, WINDOW_STRIPS = 1 << 14, 2048
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_PLACE_BITS = np.uint64(31)
LAST = (1 << 63) - 1


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes."""
    n = len(raw) - GRAM + 1
    out = np.empty(max(n, 0), dtype=np.uint64)
    for at in range(0, n, HASHED):
        out[at : at + HASHED] = _some_hashes(raw[at : at + HASHED + GRAM - 1])
    return out


def _some_hashes(raw: np.ndarray) -> np.ndarray:
    n = len(raw) - GRAM + 1
    x = raw.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    h = np.zeros(n, dtype=np.uint64)
    for factor, at in zip(_FACTORS, range(0, GRAM, 8)):
        h = (h ^ x[at : at + n]) * factor
        h ^= h >> np.uint64(32)
    h *= _FACTORS[1]
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, end of windows) of every anchor occurrence in texts put one after another."""
    width = WINDOW - GRAM + 1
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < WINDOW:
        return empty, empty, empty, empty
    h = gram_hashes(raw)
    key = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    n = len(key) - width + 1
    filled = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(filled, axis=1).ravel()
    back = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    place = np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))
    inside = np.repeat(np.cumsum(lengths), lengths)[:n] - np.arange(n) >= WINDOW
    change = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])]))
    ends = np.append(change[1:], n)
    use = inside[change]
    place = place[change[use]].astype(np.int64)
    return h[place].view(np.int64), place, change[use], ends[use]


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)), offsets


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by the block, with the block's anchors: each once, or twice if it occurs more often."""
    number = TaskContext.get().partitionId() << 32
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = _binary(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
            raw, lengths = data[offsets[at] : offsets[stop]], np.diff(offsets[at : stop + 1])
            found, n = np.unique(anchors(raw, lengths)[0], return_counts=True)
            row = [[number], [packer.compress(raw.tobytes())], [lengths.astype(np.int32)], [batch.column("doc").slice(at, stop - at)], [np.repeat(found, np.minimum(n, 2))]]
            types = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            row[3] = [row[3][0].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["block", "data", "lengths", "docs", "anchors"])
            number, at = number + 1, stop


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by anchor, whose anchor another row has too."""
    held: tuple[int, int, bool] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, block = batch.column("anchor").to_numpy(), batch.column("block").to_numpy()
        before = False
        if held is not None:
            g, block, before = np.append(held[0], g), np.append(held[1], block), held[2]
        same = g[1:] == g[:-1]
        shared = np.append(same, False) | np.append(before, same)
        use = shared[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(block[:-1][use]), pa.array(g[:-1][use])], ["block", "anchor"])
        held = int(g[-1]), int(block[-1]), bool(shared[-1])
    if held is not None and held[2]:
        yield pa.RecordBatch.from_arrays([pa.array([held[1]]), pa.array([held[0]])], ["block", "anchor"])


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = batch.column("lengths")[i].values.to_numpy().astype(np.int64)
    raw = zstandard.ZstdDecompressor().decompress(batch.column("data")[i].as_py(), max_output_size=int(lengths.sum()) + 1)
    return np.frombuffer(raw, dtype=np.uint8), lengths


#: A block's strips: digests as two numbers, anchors and their places in the strips, where strips start, their sizes and bytes.
STRIPS = "block long, d1 array<long>, d2 array<long>, anchor array<long>, doc array<long>, row array<int>, pos array<int>, size array<int>, at array<int>, strips binary"
_STRIP_NAMES = [f.split()[0] for f in STRIPS.split(", ")]
_STRIP_TYPES = [pa.int64(), *[pa.list_(pa.int64())] * 4, *[pa.list_(pa.int32())] * 4, pa.binary()]


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _cut_strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strips of a block's shared anchors."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for i in range(batch.num_rows):
            raw, lengths = _unpacked(batch, i)
            g, place, lo, hi = anchors(raw, lengths)
            use = np.flatnonzero(np.isin(g, batch.column("shared")[i].values.to_numpy()))
            lo, hi = lo[use], hi[use]
            starts = np.cumsum(lengths) - lengths
            row = np.searchsorted(starts, lo, side="right") - 1
            docs = batch.column("docs")[i].values.to_numpy()[row]
            text = raw.tobytes()
            strips = [text[a : b + WINDOW - 1] for a, b in zip(lo.tolist(), hi.tolist())]
            digests = np.frombuffer(b"".join(map(_digest, strips)), dtype=np.int64).reshape(-1, 2)
            values = [batch.column("block")[i].as_py(), digests[:, 0], digests[:, 1], g[use], docs, row, lo - starts[row], hi - lo + WINDOW - 1, place[use] - lo, packer.compress(b"".join(strips))]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _STRIP_TYPES)], _STRIP_NAMES)


CHOSEN = "anchor long, at int, doc long, block long, row int, pos int, strip binary, frequent boolean"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strips that a block is asked for."""
    for batch in batches:
        for i in range(batch.num_rows):
            size = batch.column("size")[i].values.to_numpy().astype(np.int64)
            starts = np.cumsum(size) - size
            text = zstandard.ZstdDecompressor().decompress(batch.column("strips")[i].as_py(), max_output_size=int(size.sum()) + 1)
            asked = batch.column("asked")[i].values
            k, frequent = asked.field("k").to_numpy(), asked.field("frequent")
            columns = [pa.array(batch.column(c)[i].values.to_numpy()[k]) for c in ("anchor", "at", "doc", "row", "pos")]
            strips = pa.array([text[a : a + n] for a, n in zip(starts[k].tolist(), size[k].tolist())], pa.binary())
            block = pa.array(np.full(len(k), batch.column("block")[i].as_py()))
            yield pa.RecordBatch.from_arrays([*columns[:3], block, *columns[3:], strips, frequent], [f.split()[0] for f in CHOSEN.split(", ")])


# --- transforms --------------------------------------------------------------------------------


def symbols(strips: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, start of every string, bytes of a symbol) of strips, each ended by symbol 0.

    A symbol is two bytes where the strips have few enough different pairs; a strip then is two strings, one for even and one for
    odd places."""
    raw = [np.frombuffer(s, dtype=np.uint8).astype(np.int32) for s in strips]
    for size in (2, 1):
        strings = [r[k : len(r) - 1 : 2] * 256 + r[k + 1 :: 2] for r in raw for k in (0, 1)] if size == 2 else raw
        flat = np.concatenate(strings) if strings else np.zeros(0, dtype=np.int32)
        seen = np.zeros(1 << 16, dtype=bool)
        seen[flat] = True
        if seen.sum() < (1 << 16) - 1:
            break
    rank = np.cumsum(seen).astype(np.uint16)
    lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(int(lengths.sum()), dtype=np.uint16)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(strings)), lengths - 1)] = rank[flat]
    return out, starts, size


def sorted_suffixes(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of all suffixes of strings that end with symbol 0, in order; equal suffixes by string.

    Ranks of the first four symbols, then doubling among the suffixes that are still tied."""
    n = len(s)
    ends = np.repeat(np.append(starts[1:], n) - 1, np.diff(np.append(starts, n)))
    wide = np.concatenate([s, np.zeros(4, dtype=np.uint16)]).astype(np.uint64)
    at = np.arange(n)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(4):
        key = (key << np.uint64(16)) | np.where(at + k < ends, wide[k : k + n], 0)
    order = np.argsort(key, kind="stable")
    first = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 4
    while True:
        tied = ~first | ~np.append(first[1:], True)
        where = np.flatnonzero(tied)
        if not len(where):
            break
        who = order[where]
        beyond = who + step >= ends[who]
        if beyond.all():
            break
        follow = np.where(beyond, -1, rank[np.minimum(who + step, n - 1)])
        again = np.lexsort((who, follow, rank[who]))
        who, follow = who[again], follow[again]
        order[where] = who
        group = rank[who]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        first[where] = new
        rank[who] = np.maximum.accumulate(np.where(new, where, 0))
        step *= 2
    return order


def transform(s: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol before every suffix in order; 0 before a string's first."""
    before = s[order - 1]
    opening = np.zeros(len(s), dtype=bool)
    opening[starts] = True
    before[opening[order]] = 0
    return before


def merge_transforms(transforms: list[np.ndarray], strings: list[int], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges the transforms of shards until suffixes are in order by their first ``steps`` symbols.

    Returns the merged place of every suffix (shards one after another, each in its own order) and, for every merged place, the
    number of its run of equal prefixes. ``strings`` counts each shard's strings; their empty suffixes come first, as one run."""
    symbols_all = np.concatenate(transforms)
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    empty = int(sum(strings))
    front = np.repeat(np.arange(len(transforms), dtype=np.uint16), strings)
    inner = shard.copy()
    run = np.zeros(len(shard), dtype=np.int32)
    merged = np.empty_like(symbols_all)
    for _ in range(steps):
        slot = np.argsort(inner, kind="stable")
        merged[slot] = symbols_all
        order = np.argsort(merged, kind="stable")
        symbol, before = merged[order], run[order]
        border = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (before[1:] != before[:-1])])
        border[1:empty], border[empty : empty + 1] = False, True
        inner = inner[order]
        inner[:empty] = front
        run = np.cumsum(border, dtype=np.int32)
    return np.argsort(inner, kind="stable"), run


def repeated_windows(strips: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strip, offset, number of the repeated interval) of every window of ``WINDOW`` bytes that occurs twice in the strips."""
    shards: list[list[int]] = []
    held = SHARD_BYTES
    for i, s in enumerate(strips):
        if held >= SHARD_BYTES:
            shards.append([])
            held = 0
        shards[-1].append(i)
        held += len(s)
    s, starts, size = symbols(strips)
    each = 2 if size == 2 else 1
    lengths = np.diff(np.append(starts, len(s)))
    transforms, places, strings = [], [], []
    for members in shards:
        a, b = members[0] * each, (members[-1] + 1) * each
        low, high = starts[a], starts[b - 1] + lengths[b - 1]
        own, own_starts = s[low:high], starts[a:b] - starts[a]
        order = sorted_suffixes(own, own_starts)
        transforms.append(transform(own, order, own_starts))
        places.append(order + low)
        strings.append(b - a)
    slot, run = merge_transforms(transforms, strings, WINDOW // size)
    place = np.concatenate(places)
    at = np.empty_like(place)
    at[slot] = place
    string = np.searchsorted(starts, at, side="right") - 1
    offset = (at - starts[string]) * size + string % each
    strip = string // each
    fits = offset + WINDOW <= np.array([len(x) for x in strips])[strip]
    strip, offset, run = strip[fits], offset[fits], run[fits]
    same = run[1:] == run[:-1]
    twice = np.append(same, False) | np.append(False, same) if len(run) else np.zeros(0, dtype=bool)
    return strip[twice], offset[twice], run[twice]


SPANS = "block long, row int, start int, end int"


def _span_batch(block: np.ndarray, row: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows that go, as spans: windows at neighbouring starts are one span."""
    order = np.lexsort((start, row, block))
    block, row, start = block[order], row[order], start[order]
    new = np.concatenate([[True], (block[1:] != block[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(block) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(block)) - 1 if len(first) else first
    columns = [pa.array(block[first], pa.int64()), pa.array(row[first], pa.int32()), pa.array(start[first], pa.int32()), pa.array(start[last] + WINDOW, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["block", "row", "start", "end"])


def _shared_ends(contexts: list[bytes], group: np.ndarray) -> np.ndarray:
    """How many first bytes of each context another one of its group has too, at least; contexts are shorter than ``WINDOW``."""
    width = max(map(len, contexts), default=0)
    if not width:
        return np.zeros(len(contexts), dtype=np.int64)
    padded = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in contexts), dtype=np.uint8).reshape(-1, width)
    keys = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), padded], axis=1)
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{width + 4}").ravel(), kind="stable")
    differ = padded[order[1:]] != padded[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[group[order[1:]] != group[order[:-1]]] = 0
    out = np.zeros(len(contexts), dtype=np.int64)
    out[order] = np.maximum(np.append(common, 0), np.append(0, common))
    return np.minimum(out, [len(c) for c in contexts])


def trimmed(held: list[tuple]) -> list[tuple]:
    """Strips (group, place of the anchor, bytes, doc, block, row, pos) cut to what they may share with others of their group.

    A window holds the anchor, so it repeats only within the longest extensions of the anchor to the left and to the right that
    another strip has too. Most strips are left with less than a window and go."""
    group = np.array([h[0] for h in held], dtype=np.int64)
    left = _shared_ends([h[2][: h[1]][::-1] for h in held], group)
    right = _shared_ends([h[2][h[1] + GRAM :] for h in held], group)
    return [
        (group, a, strip[at - a : at + GRAM + b], doc, block, row, pos + at - a)
        for (group, at, strip, doc, block, row, pos), a, b in zip(held, left.tolist(), right.tolist())
        if a + GRAM + b >= WINDOW
    ]


def _without_copies(held: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The first of equal strips (group, place, bytes, doc, block, row, pos) of a group, and the others."""
    firsts: dict[tuple, tuple] = {}
    copies = []
    for h in held:
        first = firsts.setdefault((h[0], h[2]), h)
        if first is not h:
            if h[3:] < first[3:]:
                firsts[h[0], h[2]], h = h, first
            copies.append(h)
    return list(firsts.values()), copies


def _span_of(held: list[tuple]) -> pa.RecordBatch:
    """Whole strips that go, as spans."""
    block, row, start = (np.array([h[k] for h in held], dtype=np.int64) for k in (4, 5, 6))
    end = start + np.array([len(h[2]) for h in held], dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), *[pa.array(x, pa.int32()) for x in (row, start, end)]], ["block", "row", "start", "end"])


def _merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that go in the first strips of their classes; strips come sorted by anchor."""

    def found(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, _, strips, doc, block, row, pos = zip(*held)
        which, offset, run = repeated_windows(list(strips))
        if not len(which):
            return
        doc, block, row, pos = (np.array(x, dtype=np.int64)[which] for x in (doc, block, row, pos))
        start = pos + offset
        order = np.lexsort((start, row, block, doc, run))
        later = np.append(False, run[order][1:] == run[order][:-1])
        gone = order[later]
        yield _span_batch(block[gone], row[gone], start[gone])

    def settled(raw: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """Strips to merge, and strips that go whole: those that equal another one once both are cut to what they share."""
        own, copies = _without_copies(trimmed(raw))
        return (trimmed(own) if copies else own), copies

    raw: list[tuple] = []
    held: list[tuple] = []
    raw_size = size = number = 0
    current = None
    for batch in slices(batches, 4096):
        columns = [batch.column(c).to_pylist() for c in ("anchor", "at", "strip", "doc", "block", "row", "pos")]
        for anchor, *rest in zip(*columns):
            if anchor != current:
                if raw_size >= COLLECTION_BYTES:
                    own, copies = settled(raw)
                    if copies:
                        yield _span_of(copies)
                    held += own
                    size += sum(len(x[2]) for x in own)
                    raw, raw_size = [], 0
                    if size >= COLLECTION_BYTES:
                        yield from found(held)
                        held, size = [], 0
                number, current = number + 1, anchor
            raw.append((number, *rest))
            raw_size += len(rest[1])
    own, copies = settled(raw)
    if copies:
        yield _span_of(copies)
    held += own
    if held:
        yield from found(held)


WINDOWS = "window binary, doc long, block long, row int, pos int, end int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every different window of the strips of frequent anchors, by its first occurrence; later ones in the same batch go as spans without a window."""
    for batch in slices(batches, WINDOW_STRIPS):
        strips = batch.column("strip").to_pylist()
        counts = np.array([max(len(s) - WINDOW + 1, 0) for s in strips], dtype=np.int64)
        digests = np.frombuffer(b"".join(_digest(s[k : k + WINDOW]) for s in strips for k in range(len(s) - WINDOW + 1)), dtype=np.int64).reshape(-1, 2)
        doc, block, row, pos = (np.repeat(batch.column(c).to_numpy().astype(np.int64), counts) for c in ("doc", "block", "row", "pos"))
        pos = pos + np.arange(len(pos)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.lexsort((pos, row, block, doc, digests[:, 1], digests[:, 0]))
        later = np.append(False, (digests[order[1:]] == digests[order[:-1]]).all(axis=1))[: len(order)]
        first, gone = order[~later], order[later]
        spans = _span_batch(block[gone], row[gone], pos[gone])
        windows = [pa.array([digests[i].tobytes() for i in first], pa.binary()), *[pa.array(x[first], t) for x, t in ((doc, pa.int64()), (block, pa.int64()), (row, pa.int32()), (pos, pa.int32()), (pos + WINDOW, pa.int32()))]]
        names = [f.split()[0] for f in WINDOWS.split(", ")]
        yield pa.RecordBatch.from_arrays(windows, names)
        if len(gone):
            none = [pa.nulls(spans.num_rows, pa.binary()), pa.nulls(spans.num_rows, pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, *spans.columns], names)


SECOND = "digest binary, anchor long, at int, doc long, block long, row int, pos int, size int, strip binary"


def second_anchors(strip: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair of anchors, first window, end of windows) of a strip whose anchor stands at ``at``."""
    h = gram_hashes(np.frombuffer(strip, dtype=np.uint8))
    own, h[at] = h[at : at + 1].copy(), np.iinfo(np.uint64).max
    width = WINDOW - GRAM + 1
    place = np.lib.stride_tricks.sliding_window_view(h, width).argmin(axis=1) + np.arange(len(h) - width + 1)
    lo = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    second = place[lo]
    pair = (own * _FACTORS[0] ^ h[second]) * _FACTORS[2] + (second - at).astype(np.uint64) * _FACTORS[3]
    return (pair ^ (pair >> np.uint64(31))).view(np.int64), lo, np.append(lo[1:], len(place))


def _cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strips of frequent anchors, cut where the second anchor of their windows changes."""
    types = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    for batch in slices(batches, 1024):
        columns: list[list] = [[] for _ in types]
        for strip, at, doc, block, row, pos in zip(*(batch.column(c).to_pylist() for c in ("strip", "at", "doc", "block", "row", "pos"))):
            for pair, a, b in zip(*(x.tolist() for x in second_anchors(strip, at))):
                part = strip[a : b + WINDOW - 1]
                for c, v in zip(columns, (_digest(part), pair, at - a, doc, block, row, pos + a, len(part), part)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in SECOND.split(", ")])


def _frequent_spans(strips: DataFrame) -> DataFrame:
    """Spans that go in strips whose anchor has too many strips for one task."""
    rows = written(strips.mapInArrow(_cut_again, SECOND), "second-strips", compression="zstd")
    key = F.struct("doc", "block", "row", "pos")
    classes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.first("anchor").alias("anchor"))
    classes = written(classes, "second-classes")
    copies = rows.drop("strip", "anchor").join(classes.where("n > 1").select("digest", "first"), "digest").where(key != F.col("first"))
    spans = copies.select("block", "row", F.col("pos").alias("start"), (F.col("pos") + F.col("size")).alias("end"))
    sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("strips")).where("strips > 1")
    asked = classes.join(sizes, "anchor").select("digest", "first", (F.col("strips") > HOT_STRIPS).alias("frequent"))
    chosen = rows.join(asked, "digest").where(key == F.col("first")).select(*[f.split()[0] for f in CHOSEN.split(", ")])
    chosen = written(chosen, "second-chosen", compression="zstd")
    few = chosen.where(~F.col("frequent")).repartition("anchor").sortWithinPartitions("anchor")
    return spans.unionByName(few.mapInArrow(_merged_spans, SPANS)).unionByName(_window_spans(chosen.where("frequent")))


def _window_spans(strips: DataFrame) -> DataFrame:
    """Spans that go in strips whose pair of anchors is frequent too, window by window."""
    found = written(strips.mapInArrow(_windows, WINDOWS), "frequent-windows")
    rows = found.where("window is not null")
    key = F.struct("doc", "block", "row", "pos")
    firsts = rows.groupBy("window").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("window", "first")
    later = rows.join(firsts, "window").where(key != F.col("first"))
    return found.where("window is null").unionByName(later.select(*rows.columns)).select("block", "row", F.col("pos").alias("start"), "end")


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, lengths = _unpacked(batch, i)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                depth = np.zeros(len(raw) + 1, dtype=np.int32)
                spans = batch.column("spans")[i].values
                if spans is not None and len(spans):
                    row = starts[spans.field("row").to_numpy()]
                    np.add.at(depth, row + spans.field("start").to_numpy(), 1)
                    np.add.at(depth, row + spans.field("end").to_numpy(), -1)
                gone = np.cumsum(depth[:-1]) > 0
                total = np.append(0, np.cumsum(gone))
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                opens[starts[lengths > 0]] = gone[starts[lengths > 0]]
                opened = np.append(0, np.cumsum(opens))
                kept = raw[~gone].tobytes()
                low, high = starts - total[starts], ends - total[ends]
                parts = [kept[a:b] for a, b in zip(low.tolist(), high.tolist())]
                docs = batch.column("docs")[i].values
                ids = pc.if_else(pc.equal(docs, LAST), pa.scalar(None, pa.int64()), docs)
                hashes = pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
                columns = [ids, pa.array(lengths), pa.array(total[ends] - total[starts]), pa.array(opened[ends] - opened[starts]), hashes]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_bytes:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on request the ``kept`` bytes."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)
    blocks = bucketed(rows.mapInArrow(_pack, "block long, data binary, lengths array<int>, docs array<long>, anchors array<long>"), "text_blocks", "block", buckets)
    texts = blocks.select("block", "data", "lengths", "docs")
    anchor_rows = blocks.select(F.explode("anchors").alias("anchor"), "block").repartition("anchor").sortWithinPartitions("anchor")
    shared = anchor_rows.mapInArrow(_in_runs, "block long, anchor long").groupBy("block").agg(F.collect_set("anchor").alias("shared"))
    strips = bucketed(texts.join(shared, "block").mapInArrow(_cut_strips, STRIPS), "strips", "block", buckets)

    fields = ["d1", "d2", "anchor", "doc", "row", "pos", "size"]
    each = strips.select("block", F.posexplode(F.arrays_zip(*fields)).alias("k", "s")).select("block", "k", "s.*")
    key = F.struct("doc", "block", "row", "pos")
    classes = each.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "block", "row", "pos", "k")).alias("first"), F.first("anchor").alias("anchor"))
    classes = written(classes, "strip-classes")
    firsts = classes.where("n > 1").select("d1", "d2", F.struct("first.doc", "first.block", "first.row", "first.pos").alias("first"))
    copies = each.join(firsts, ["d1", "d2"]).where(key != F.col("first"))
    spans = copies.select("block", "row", F.col("pos").alias("start"), (F.col("pos") + F.col("size")).alias("end"))

    sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("strips")).where("strips > 1")
    asked = classes.join(sizes, "anchor").select("first.block", F.struct("first.k", (F.col("strips") > HOT_STRIPS).alias("frequent")).alias("ask"))
    asked = asked.groupBy("block").agg(F.collect_list("ask").alias("asked"))
    chosen = written(strips.select("block", "anchor", "at", "doc", "row", "pos", "size", "strips").join(asked, "block").mapInArrow(_fetched, CHOSEN), "chosen-strips", compression="zstd")
    few = chosen.where(~F.col("frequent")).repartition("anchor").sortWithinPartitions("anchor")
    spans = spans.unionByName(few.mapInArrow(_merged_spans, SPANS)).unionByName(_frequent_spans(chosen.where("frequent")))
    by_block = spans.groupBy("block").agg(F.collect_list(F.struct("row", "start", "end")).alias("spans"))
    return texts.join(by_block, "block", "left").mapInArrow(_removed(with_bytes), REMOVED + (", kept binary" if with_bytes else ""))
