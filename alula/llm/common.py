"""What the operators of this subpackage share."""

from __future__ import annotations

import string
import weakref
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alula.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of long text that are worked on together in a batch, and the rows and bytes of text batches that Spark sends to Python.
TEXT_BATCH_ROWS = 256
SENT_ROWS, SENT_BYTES = 2048, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back: fixes its rows and cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like ``written``, as a bucketed table: joins by ``column`` need no exchange of its rows."""
    path = scratch_path(df.sparkSession, name)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.option("path", path).bucketBy(buckets, column).saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null counts as empty.

    ``lower`` does exactly that for texts that are all ASCII (as many bytes as characters)."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, string.ascii_uppercase, string.ascii_lowercase)
    )


_CACHES: list[weakref.ref] = []


def own_caches(owner: str) -> None:
    """Called where a task of an operator starts: empties the caches of all other operators in this worker."""
    for ref in _CACHES:
        cache = ref()
        if cache is not None and cache.owner != owner:
            cache.forget()


class Remembered(dict):
    """Key -> ``compute(key)``, remembered for the keys used last: between ``size`` and twice as many.

    When a generation of keys is full it becomes the older one, and the one before that is forgotten. Python workers outlive an
    operator; ``own_caches`` empties what the others have left."""

    def __init__(self, compute: Callable[[Any], Any], size: int, owner: str = ""):
        self.compute, self.size, self.older, self.owner = compute, size, {}, owner
        _CACHES.append(weakref.ref(self))

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def __missing__(self, key: Any) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def keep(self, key: Any, value: Any) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn labels from: crc32 of the id's decimal text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns' values only."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))).cast("double")


def slices(batches: Iterable[pa.RecordBatch], rows: int = TEXT_BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, so that what is derived from them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def send_small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker is sent at once, unless the session has bounds of its own."""
    for key, default, value in (("maxRecordsPerBatch", "10000", SENT_ROWS), ("maxBytesPerBatch", str(64 << 20), SENT_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", default) in (default, "64MB", f"{default}b", "67108864B"):
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column in ``taken`` has it (Spark ignores case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def with_text(docs: DataFrame, keep: list[str], column: str = "text") -> tuple[DataFrame, str]:
    """The ``keep`` columns and the text, which is sent once: under its own name if it is kept, else under a free one."""
    send_small_batches(docs.sparkSession)
    if column in keep and docs.schema[column].dataType.simpleString() == "string":
        return docs.select(*keep), column
    name = free_name(keep, "__text")
    return docs.select(*keep, F.col(column).cast("string").alias(name)), name


def extended(schema: StructType, ddl: str) -> StructType:
    """The schema with further columns."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def without_rows(docs: DataFrame, keys: list[Column], dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose keys (null equals null) are not in ``dropped``, a table of the same number of columns."""
    names = []
    for i in range(len(keys)):
        names.append(free_name([*docs.columns, *names], f"__k{i}"))
    marked = docs.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    other = dropped.toDF(*[f"__d{i}" for i in range(len(keys))])
    same = F.lit(True)
    for i, n in enumerate(names):
        same = same & marked[n].eqNullSafe(other[f"__d{i}"])
    return marked.join(other, same, "left_anti").select(*[marked[c] for c in docs.columns])
