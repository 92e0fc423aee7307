"""Token ids in directly addressable binary files.

A segment holds the ids of consecutive documents as directly addressable codes: an id is split into chunks of 8, 8 and
16 bits. Level 1 has the low chunk of every id, level 2 the next chunk of those ids that go on, level 3 likewise; a
continuation bitmap per level says which ids go on, and a rank directory (set bits before every 512th position)
finds their places one level down. Any id is read with two bit counts and without decoding what lies around it.

Segment bytes (little endian): magic ``DAC1``, three 64-bit level lengths, then for each level its chunks, and, for the first
two, its bitmap (padded to 8 bytes) and its directory of 64-bit counts. Segments are rows of a Parquet table in
the shared folder: written by Spark's own committers, so that retried tasks leave one copy, and found by their first
document, first id or first position with ordinary filters.

Documents are put in ascending id order by a range exchange; each task encodes its range in order and writes a segment
as soon as its documents have SEGMENT_IDS ids together. Rows without an id come first. Rows that share an
id keep the order of their texts. Null texts count as empty and consist of the end id alone.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.llm.common import Remembered, own_caches, send_small_batches, slices
from alula.session import scratch_path

MAGIC = b"DAC1"
CHUNKS = ((np.uint8, 8), (np.uint8, 8), (np.uint16, 16))
BLOCK = 512
#: Ids in a segment; a task holds one segment at a time.
SEGMENT_IDS = 1 << 19
#: Text bytes that one task encodes, about.
TASK_BYTES = 24 << 20
#: Words a worker remembers are at most twice these.
WORD_CACHE = 500_000
END_ID = 1


def dac_encode(ids: np.ndarray) -> bytes:
    """A segment's bytes for an array of unsigned 32-bit ids."""
    rest = ids.astype(np.uint32)
    lengths, body = [], []
    for level, (kind, width) in enumerate(CHUNKS):
        lengths.append(len(rest))
        body.append(_padded((rest & np.uint32((1 << width) - 1)).astype(kind).tobytes()))
        if level == len(CHUNKS) - 1:
            break
        more = rest >> np.uint32(width)
        goes_on = more != 0
        body.append(_padded(np.packbits(goes_on, bitorder="little").tobytes()))
        blocks = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK)) if len(rest) else np.zeros(0, dtype=np.int64)
        body.append(np.concatenate([[0], np.cumsum(blocks)]).astype("<u8").tobytes())
        rest = more[goes_on]
    return MAGIC + b"\0" * 4 + np.array(lengths, dtype="<u8").tobytes() + b"".join(body)


def _padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


class DacReader:
    """Random access to a segment's ids."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.lengths = np.frombuffer(raw, "<u8", len(CHUNKS), 8).astype(np.int64)
        at = 8 + 8 * len(CHUNKS)
        self.levels, self.bitmaps, self.ranks = [], [], []
        for level, (kind, _) in enumerate(CHUNKS):
            n = int(self.lengths[level])
            size = n * np.dtype(kind).itemsize
            self.levels.append(np.frombuffer(raw, np.dtype(kind).newbyteorder("<"), n, at))
            at += size + -size % 8
            if level < len(CHUNKS) - 1:
                size = (n + 7) // 8
                self.bitmaps.append(np.frombuffer(raw, np.uint8, size, at))
                at += size + -size % 8
                self.ranks.append(np.frombuffer(raw, "<u8", (n + BLOCK - 1) // BLOCK + 1, at))
                at += 8 * len(self.ranks[-1])

    def __len__(self) -> int:
        return int(self.lengths[0])

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level's bitmap before a position."""
        start = at // BLOCK * BLOCK
        bits = np.unpackbits(self.bitmaps[level][start // 8 : (at + 7) // 8], bitorder="little")[: at - start]
        return int(self.ranks[level][at // BLOCK]) + int(bits.sum())

    def __getitem__(self, at: int) -> int:
        value, shift = 0, 0
        for level, (_, width) in enumerate(CHUNKS):
            value |= int(self.levels[level][at]) << shift
            shift += width
            if level == len(CHUNKS) - 1 or not self.bitmaps[level][at >> 3] >> (at & 7) & 1:
                break
            at = self._rank(level, at)
        return value

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range of positions; touches nothing outside it but a directory block."""
        out = np.zeros(stop - start, dtype=np.uint32)
        where, shift = np.arange(stop - start), 0
        for level, (_, width) in enumerate(CHUNKS):
            out[where] |= self.levels[level][start:stop].astype(np.uint32) << np.uint32(shift)
            shift += width
            if level == len(CHUNKS) - 1 or stop == start:
                break
            first = start // 8 * 8
            bits = np.unpackbits(self.bitmaps[level][first // 8 : (stop + 7) // 8], bitorder="little")[start - first : stop - first]
            where = where[bits.astype(bool)]
            start = self._rank(level, start)
            stop = start + len(where)
        return out


#: New words that are encoded together.
JOINED = 32
#: Signs that the tokenizer's splitter takes off the end of a word that ends with a letter or digit.
TAIL = ".,;:!?"


class WordEncoder:
    """A tokenizer whose normaliser and splitter treat words apart, with the ids of a bounded number of words remembered.

    Arrow splits the texts of a batch and lists its different words; each of them is looked up once, without the signs at
    its end, which are words of their own to the tokenizer. Ids are then put in place for all words at once. Texts with
    separators that Arrow and the tokenizer see differently are encoded whole by the library."""

    odd = "[\x1c-\x1f]"

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)  # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = Remembered(self._ids, WORD_CACHE, "tokens")
        self.tails = Remembered(self._ids, 4096, "tokens")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Words of letters alone are encoded together, as texts: each has one id that ends a word, its last."""
        known, older = self.known, self.known.older
        new = [w for w in words if w not in known and w not in older]
        letters, alone = [w for w in new if w.isalpha()], [w for w in new if not w.isalpha()]
        groups = [letters[a : a + JOINED] for a in range(0, len(letters), JOINED)]
        for at in range(0, len(groups), 64):
            part = groups[at : at + 64]
            for group, e in zip(part, self.tokenizer.encode_batch_fast([" ".join(g) for g in part], add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                ends = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
                if len(ends) != len(group) or ends[-1] != 4 * len(ids):
                    alone += group
                    continue
                raw = ids.tobytes()
                for w, a, b in zip(group, [0, *ends], ends):
                    known.keep(w, raw[a:b])
        for at in range(0, len(alone), 4096):
            part = alone[at : at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known.keep(w, np.array(e.ids, dtype="<u4").tobytes())

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        split = []
        for w in words:
            core = w.rstrip(TAIL)
            tail = w[len(core) :]
            if tail and not (core and core[-1].isalnum()):
                core, tail = w, ""
            if core and (core.isascii() or max(core) < "\u0180"):
                core = core.lower()  # the tokenizer does so too
            split.append((core, tail))
        self._learn({core for core, _ in split})
        known, tails = self.known, self.tails
        found = [known[core] + tails[tail] if tail else known[core] for core, tail in split]
        return np.frombuffer(b"".join(found), dtype="<u4"), np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4

    def encode_batch(self, texts: pa.Array) -> list[np.ndarray]:
        whole = {i: texts[i].as_py() for i in np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))}
        lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        flat, sizes = self._word_ids(words.dictionary.to_pylist())
        starts = np.cumsum(sizes) - sizes
        word = words.indices.to_numpy()
        n = sizes[word]
        ends = np.append(0, np.cumsum(n))
        ids = flat[np.arange(ends[-1]) + np.repeat(starts[word] - ends[:-1], n)]
        offsets = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        cuts = ends[offsets]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for i, text in whole.items():
            out[i] = np.frombuffer(self._ids(text), dtype="<u4")
        return out


@lru_cache(maxsize=2)
def load_encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


SEGMENT_NAMES = ["part", "segment", "start", "n_ids", "doc_ids", "counts", "codes"]
SEGMENT_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
SEGMENTS = "part int, segment int, start long, n_ids long, doc_ids array<long>, counts array<long>, codes binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, path: str | None = None) -> str:
    """Writes the ids of all documents, each followed by the end id, and returns the table's path.

    A row is a segment of whole documents: ``part`` and ``segment`` order the segments, ``start`` counts the ids before it
    in its part, ``doc_ids`` and ``counts`` list its documents in order."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    send_small_batches(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own_caches("tokens")
        encoder, part = load_encoder(shared.value), TaskContext.get().partitionId()
        segment = start = 0
        held: list[np.ndarray] = []
        names: list[int | None] = []

        def row() -> pa.RecordBatch:
            ids = np.concatenate(held)
            values = [part, segment, start, len(ids), names, [len(x) for x in held], dac_encode(ids)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, SEGMENT_TYPES)], SEGMENT_NAMES)

        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_batch(batch.column("text"))):
                names.append(doc_id)
                held.append(np.append(ids, np.uint32(end_id)))
                n += len(held[-1])
                if n >= SEGMENT_IDS:
                    yield row()
                    segment, start, n = segment + 1, start + n, 0
                    held, names = [], []
        if held:
            yield row()

    path = path or scratch_path(spark, "token-files")
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``first``, the ids before each of them in all parts.

    Ids are counted per part first, so only the parts' totals (as many as encoding tasks) are summed up in one place."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, starts = 0, []
    for part, n in totals:
        starts.append((part, before))
        before += n
    bases = spark.createDataFrame(starts, "part int, base long")
    return segments.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("start"))


def stored_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the segments by direct access; on request with
    ``ids``, the document's ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            reader, at = DacReader(batch.column("codes")[0].as_py()), 0
            first, names, counts = (batch.column(c)[0].as_py() for c in ("first", "doc_ids", "counts"))
            for k in range(0, len(names), 256):
                columns: list[list] = [[], [], [], [], []]
                for doc_id, n in zip(names[k : k + 256], counts[k : k + 256]):
                    raw = reader.read(at, at + n).astype("<u4").tobytes()
                    for column, value in zip(columns, (doc_id, first + at, n, zlib.crc32(raw) & 0xFFFFFFFF, raw)):
                        column.append(value)
                    at += n
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays[: 4 + with_ids], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return segments.select("first", "doc_ids", "counts", "codes").mapInArrow(run, schema)
