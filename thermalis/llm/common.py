"""Helpers that several operators share."""

import ctypes
import gc
import hashlib
from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from thermalis.sources.durable import scratch_path, settle

__all__ = ["BATCH_BYTES", "bounded_batches", "documents", "handed_back", "handed_back_by_group", "mix", "pages", "release", "scratch_path", "settle", "streamed_sha256",
           "text_bytes", "without", "word_hashes"]

#: Bytes of a pack of contents that are hashed together.
PACK = 1 << 20
#: Arrow batches between Spark and Python hold at most so many bytes, or one row if it is larger.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Limit Arrow batches by bytes in this session, unless it already limits them more tightly."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    digits = "".join(c for c in now if c.isdigit())
    if int(digits) > size or not now[-1:].lower().strip("0123456789b") == "":
        spark.conf.set(key, str(size))


def hand_back() -> None:
    """Give memory that this Python worker has freed back to the system, so that it is not held while other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def handed_back(run: Callable) -> Callable:
    """A function of mapInArrow whose worker gives memory back once a task's batches are done; workers stay for later stages."""
    @wraps(run)
    def whole(batches):
        yield from run(batches)
        hand_back()

    return whole


def handed_back_by_group(run: Callable) -> Callable:
    """The same for a function of two cogrouped tables, once each group is done."""
    @wraps(run)
    def whole(left, right):
        found = run(left, right)
        hand_back()
        return found

    return whole


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries now; they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b""))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z = z ^ (z >> np.uint64(27))
    z = z * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def rows_of(batches):
    """The rows of record batches as tuples."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def batches_of(rows, schema: pa.Schema, size: int = PACK, most: int = 4096):
    """Record batches of tuples, closed at most rows or, going by the last column, at size bytes."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1])
        if weight >= size or len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def streamed_sha256(rows: DataFrame, keys: list[str], place: str, separator: bytes = b"") -> DataFrame:
    """keys and sha256 (lowercase hex) of the contents of each key in the order of place, joined by the separator.

    rows has keys (long), place (long) and content (binary), none null. A hot key's rows are sorted and packed by many
    tasks; the hash, which goes from front to back by its nature, then streams over the packs in one, holding one pack.
    """
    n, names = len(keys), [*keys, "place", "content"]
    key_fields, kinds = [pa.field(c, pa.int64()) for c in keys], ", ".join(f"{c} long" for c in keys)

    def packs(sorted_rows):
        now, first, held, size = None, None, [], 0
        for *key, at, content in sorted_rows:
            if held and (key != now or size >= PACK):
                yield (*now, first, separator.join(held))
                held, size = [], 0
            if not held:
                now, first = key, at
            held.append(content)
            size += len(content)
        if held:
            yield (*now, first, separator.join(held))

    def digests(sorted_rows):
        now, state = None, None
        for *key, _, content in sorted_rows:
            if key == now:
                state.update(separator)
            else:
                if state:
                    yield (*now, state.hexdigest())
                now, state = key, hashlib.sha256()
            state.update(content)
        if state:
            yield (*now, state.hexdigest())

    pack_schema = pa.schema([*key_fields, pa.field("place", pa.int64()), pa.field("content", pa.binary())])
    hash_schema = pa.schema([*key_fields, pa.field("sha256", pa.string())])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges are found by a first look at the rows, so they are a table.
    placed = settle(rows.select(*keys, F.col(place).cast("long").alias("place"), "content"), "hash-contents")
    packed = (placed.repartitionByRange(parts, *keys, "place").sortWithinPartitions(*keys, "place").select(names)
              .mapInArrow(lambda batches: batches_of(packs(rows_of(batches)), pack_schema), f"{kinds}, place long, content binary"))
    return (packed.repartition(parts, *keys).sortWithinPartitions(*keys, "place").select(names)
            .mapInArrow(lambda batches: batches_of(digests(rows_of(batches)), hash_schema), f"{kinds}, sha256 string"))


def without(docs: DataFrame, gone: DataFrame, id_column: str, label: str) -> DataFrame:
    """The rows of docs whose id is not in gone, a table of ids alone; rows without an id stay. All columns are kept,
    whatever their names."""
    return docs.join(settle(gone.select(id_column).where(F.col(id_column).isNotNull()), label), id_column, "left_anti").select(*docs.columns)
